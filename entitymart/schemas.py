"""Schemas of entities, values, staged rows and catalog tables."""

_CLAIM = "struct<mainsnak:struct<snaktype:string,datavalue:struct<value:variant>>>"

#: A dump line. A value is a variant: claims hold strings, coordinates and objects, which one struct cannot type, and a field is found without parsing again.
ENTITY = (
    "id string, type string, labels map<string,struct<value:string>>, descriptions map<string,struct<value:string>>, "
    f"claims map<string,array<{_CLAIM}>>, sitelinks map<string,struct<title:string>>"
)
REFS = "array<struct<qid:string,role:string>>"

#: Primary keys of the catalog's tables.
KEYS = {
    "artist": ["id"],
    "genre": ["id"],
    "artist_genre": ["artist_id", "genre_id"],
    "album": ["id"],
    "album_artist": ["album_id", "artist_id", "role"],
    "album_genre": ["album_id", "genre_id"],
    "track": ["id"],
    "track_album": ["track_id", "album_id"],
    "track_artist": ["track_id", "artist_id", "role"],
    "artist_instrument": ["artist_id", "instrument_id"],
    "artist_member_of": ["artist_id", "group_id"],
    "sync_state": ["key"],
    "qid_label": ["qid"],
    "instrument": ["id"],
    "record_label": ["id"],
}

#: What updates carry from batch to batch, beside the catalog: the change that each entity's row in a role comes from, and each label that an update brought;
#: changes that failed; and references to entities that are not there yet (kind: the table that waits, or member for a failed change).
STATE = {
    "entity_version": "qid string, role string, modified timestamp, mark long, named boolean",
    "label_version": "qid string, modified timestamp, mark long",
    "retry": "qid string, modified timestamp, mark long, value string, reason string, tries int",
    "waiting": "ref string, kind string, id string, role string",
}
STATE_KEYS = {"entity_version": ["qid", "role"], "label_version": ["qid"], "retry": ["qid", "mark"], "waiting": ["ref", "kind", "id", "role"]}

#: (child, column, parent): every reference that must hold. Instruments are not guarded.
FOREIGN_KEYS = [
    ("artist_genre", "artist_id", "artist"),
    ("artist_genre", "genre_id", "genre"),
    ("album_artist", "album_id", "album"),
    ("album_artist", "artist_id", "artist"),
    ("album_genre", "album_id", "album"),
    ("album_genre", "genre_id", "genre"),
    ("track_album", "track_id", "track"),
    ("track_album", "album_id", "album"),
    ("track_artist", "track_id", "track"),
    ("track_artist", "artist_id", "artist"),
    ("artist_instrument", "artist_id", "artist"),
    ("artist_member_of", "artist_id", "artist"),
    ("artist_member_of", "group_id", "artist"),
]
