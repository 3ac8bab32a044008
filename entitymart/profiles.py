"""Rule profiles: which entities belong in a catalog, in which role, and why. Rules are tried in order; the first that matches decides."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Rule:
    """A claim of ``prop`` whose target is one of ``ids`` gives ``role``."""

    prop: str
    ids: tuple[str, ...]
    role: str


@dataclass(frozen=True)
class Profile:
    rules: tuple[Rule, ...]
    #: Any of these properties being present is enough for the last rule.
    catch_all: tuple[str, ...]
    catch_all_role: str


# Ids of occupations, group classes, album classes, track classes, and catch-all properties of the music catalog.
OCCUPATIONS = (
    "Q639669", "Q36834", "Q177220", "Q488205", "Q486748", "Q548274", "Q158852", "Q15981151", "Q183945", "Q753110",
    "Q1280273", "Q1086813", "Q2252262", "Q2865816", "Q1075651", "Q855091", "Q105543609", "Q793509", "Q2551014",
)
GROUPS = (
    "Q215380", "Q2088357", "Q5741069", "Q42998", "Q1146754", "Q6185547", "Q2151147", "Q1229826", "Q114114601", "Q2539346", "Q108421069", "Q1196129",
)
ALBUM_CLASSES = (
    "Q482994", "Q134556", "Q208569", "Q169930", "Q222910", "Q209939", "Q5610543", "Q963099", "Q723849", "Q1892995", "Q217199", "Q5049564",
)
TRACK_CLASSES = ("Q7366", "Q55850593", "Q24887304", "Q639197")
CATCH_ALL = ("P1303", "P175", "P136", "P358")

MUSIC = Profile(
    rules=(Rule("P106", OCCUPATIONS, "Agent"), Rule("P31", GROUPS, "Agent"), Rule("P31", ALBUM_CLASSES, "Album"), Rule("P31", TRACK_CLASSES, "Track")),
    catch_all=CATCH_ALL,
    catch_all_role="Agent",
)
