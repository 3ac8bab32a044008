"""WARC archives with an index that comes first.

``write_archive`` writes one gzip member per record (HTTP response with its payload, or a revisit without one) and, for each, an
index row: file, offset, length, url, digest. A task writes a file of its own name straight to the shared folder and the index
goes through Spark's committer, so the index names the files of successful attempts only; others are never read. ``read_records`` takes
index rows, sorts them by file and offset, joins neighbours to ranges of up to ``RANGE_BYTES`` over gaps of up to ``GAP_BYTES`` and
reads each range once.

Equal payloads are found by digest on slim rows (id, digest), written once. Of the pages themselves only those travel, to meet the id of the
record they revisit, that a bit field of bounded size does not know to be no revisits.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from base64 import b32encode


from pyarrow.fs import FileSystem
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entitymart.llm.common import arrow_schema, batch_of, maybe_one_of, per_batch, shared_folder, ship, slices, stored

RANGE_BYTES, GAP_BYTES = 8 << 20, 64 << 10
#: Bytes after which a task begins another file.
FILE_BYTES = 128 << 20
#: Bytes of index rows that one reading task is dealt from one file, by offset.
SHARE_BYTES = 64 << 20
#: Payloads of fewer bytes are always stored whole.
MIN_REVISIT_BYTES = 0

INDEX = "file string, offset long, length long, url string, digest string, page_id long"
FOUND = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def base32(digest: Column) -> Column:
    """A SHA-1 in hexadecimal digits as upper-case base32, by built-in functions: 20 bits are 5 hex digits are 4 base32 digits."""
    parts = [F.lpad(F.conv(F.substring(digest, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def with_revisits(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """page_id, url, html, digest, refers_to: of equal payloads of ``min_bytes`` or more, all but the largest page_id refer to it."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumn("digest", F.sha1(F.col("html").cast("binary"))).withColumn("digest", base32(F.col("digest")))
    slim = rows.where((F.octet_length("html") >= min_bytes) & F.col("page_id").isNotNull()).select("page_id", "digest")
    slim = stored(slim, "warc-digests")
    groups = stored(slim.groupBy("digest").agg(F.max("page_id").alias("last"), F.count("*").alias("n")).where("n > 1").drop("n"), "warc-groups")
    mapping = slim.join(groups.hint("merge"), "digest").where("page_id < last").groupBy("page_id", "digest").agg(F.max("last").alias("refers_to"))
    mapping = stored(mapping, "warc-revisits")
    maybe = maybe_one_of(stored(mapping.select("page_id").distinct(), "warc-revisit-ids"), F.col("page_id"))
    stay = rows.where(~maybe).withColumn("refers_to", F.lit(None).cast("long"))
    return stay.unionByName(rows.where(maybe).join(mapping.hint("merge"), ["page_id", "digest"], "left"))


def record(page_id, url, html: str, digest: str, refers_to) -> bytes:
    """The uncompressed record. Payload size and type stand in the HTTP head, which a revisit keeps."""
    payload = html.encode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if refers_to is None else b"")
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "")
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>"]
    if url is not None:
        head.append(f"WARC-Target-URI: {target}")
    head += ["WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha1:{digest}"]
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """A record's fields and payload."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"(?mi)^Content-Length: (\d+)", http)[1])
    number = lambda s: int(s[10:-1]) if s and s[10:-1] else None
    return {
        "page_id": number(fields["WARC-Record-ID"]), "url": fields.get("WARC-Target-URI"), "payload_bytes": size, "record_type": fields["WARC-Type"],
        "payload_digest": fields["WARC-Payload-Digest"].removeprefix("sha1:"), "refers_to": number(fields.get("WARC-Refers-To")), "payload": payload,
    }


def gzip_member(data: bytes) -> bytes:
    c = zlib.compressobj(3, zlib.DEFLATED, 31)
    return c.compress(data) + c.flush()


def write_archive(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Writes the records of ``pages`` (page_id, url, html, digest, refers_to); returns the index, itself a stored table."""
    folder = folder or shared_folder(pages.sparkSession, "warc")
    target = arrow_schema(INDEX)

    def run(batches):
        """A file's index rows leave the task when the file is closed."""
        out, offset, rows = None, 0, []

        def close():
            out.close()
            return batch_of({c: [r[c] for r in rows] for c in target.names}, target)

        for batch in slices(batches):
            for r in batch.to_pylist():
                if out is None:
                    name, offset, rows = f"{folder}/{uuid.uuid4().hex}.warc.gz", 0, []
                    fs, path = FileSystem.from_uri(name)
                    fs.create_dir(path.rpartition("/")[0], recursive=True)
                    out = fs.open_output_stream(path, compression=None, buffer_size=1 << 20)
                member = gzip_member(record(**r))
                out.write(member)
                rows.append({"file": name, "offset": offset, "length": len(member), "url": r["url"], "digest": r["digest"], "page_id": r["page_id"]})
                offset += len(member)
                if offset >= FILE_BYTES:
                    yield close()
                    out = None
        if out is not None:
            yield close()

    ship(pages.sparkSession)
    return stored(pages.select("page_id", "url", "html", "digest", "refers_to").mapInArrow(run, INDEX), "warc-index")


def ranges(rows: list[dict]):
    """Runs of index rows of one file, in order, that one read serves."""
    run: list[dict] = []
    for r in rows:
        if run and (r["file"] != run[0]["file"] or r["offset"] - (run[-1]["offset"] + run[-1]["length"]) > GAP_BYTES or r["offset"] + r["length"] - run[0]["offset"] > RANGE_BYTES):
            yield run
            run = []
        run.append(r)
    if run:
        yield run


def read_records(index: DataFrame) -> DataFrame:
    """The records that ``index`` (any selection of index rows) names."""
    share = (F.col("offset") / SHARE_BYTES).cast("long")
    dealt = index.select("file", "offset", "length").repartition("file", share).sortWithinPartitions("file", "offset")
    target = arrow_schema(FOUND)

    def run(batches):
        for batch in batches:
            for some in ranges(batch.to_pylist()):
                fs, path = FileSystem.from_uri(some[0]["file"])
                first = some[0]["offset"]
                with fs.open_input_file(path) as f:
                    data = f.read_at(some[-1]["offset"] + some[-1]["length"] - first, first)
                found = [parse(zlib.decompress(data[r["offset"] - first : r["offset"] - first + r["length"]], 31)) for r in some]
                yield batch_of({c: [x[c] for x in found] for c in target.names}, target)

    ship(index.sparkSession)
    return dealt.mapInArrow(run, FOUND)


def verified(records: DataFrame) -> DataFrame:
    """Checks each response's payload against its stated size and digest, which are taken anew from the bytes read, and drops the payload. A
    revisit stores none: its digest is that of the record it names, since both were grouped by it."""

    def make(batch):
        rows = batch.to_pylist()
        for r in rows:
            if r["record_type"] == "response":
                size, digest = len(r["payload"]), b32encode(hashlib.sha1(r["payload"]).digest()).decode()
                if (size, digest) != (r["payload_bytes"], r["payload_digest"]):
                    raise ValueError(f"page {r['page_id']}: the payload read is not the one written")
        return {c: [r[c] for r in rows] for c in rows[0]}

    return per_batch(records, make, FOUND).drop("payload")


def round_trip(pages: DataFrame) -> DataFrame:
    """Writes all pages and reads all records back. A null html counts as empty, a null url writes no target, a row with a null page_id
    is always a response; rows that repeat a page_id are all written; an empty table gives an empty result; other columns are not read."""
    return verified(read_records(write_archive(with_revisits(pages))))
