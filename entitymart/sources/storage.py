"""Tables between stages, in the shared folder, and published snapshots."""

from __future__ import annotations

import contextlib
import functools
import json
import tempfile
import uuid
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def shared_folder(spark: SparkSession, what: str) -> str:
    """A new folder, as a full address, under the session's checkpoint folder; a temporary one only where Spark runs in one process
    and that setting is missing."""
    context = spark.sparkContext
    base = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not base:
        if context.master != "local" and not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = f"file://{tempfile.mkdtemp(prefix='spark-')}"
        context.setCheckpointDir(base)
    folder = context._jvm.org.apache.hadoop.fs.Path(base)
    full = folder.getFileSystem(context._jsc.hadoopConfiguration()).makeQualified(folder).toString()
    if full.startswith("file:/") and not full.startswith("file://"):
        full = f"file://{full[5:]}"
    return f"{full.rstrip('/')}/{what}-{uuid.uuid4().hex}"


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def shuffles_let_go(spark: SparkSession) -> Iterator[None]:
    """Writes inside drop their shuffle files as they end, not when the driver next collects garbage: what was written is not computed again."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)


def stored(df: DataFrame, what: str) -> DataFrame:
    """Writes ``df`` once as Parquet in the shared folder and reads it back: cuts the lineage, survives lost executors."""
    path = shared_folder(df.sparkSession, what)
    with shuffles_let_go(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class StoredTables(Mapping):
    """Tables by name, each stored when first asked for, so a flow writes none that nobody reads. ``there``: those that are stored already."""

    def __init__(self, plans: Mapping[str, DataFrame], there: Mapping[str, DataFrame] | None = None):
        self.plans, self.there, self.kept = dict(plans), dict(there or {}), {}

    def __getitem__(self, name: str) -> DataFrame:
        if name in self.there:
            return self.there[name]
        if name not in self.kept:
            self.kept[name] = stored(self.plans[name], name)
        return self.kept[name]

    def __contains__(self, name: object) -> bool:
        return name in self.plans

    def __iter__(self) -> Iterator[str]:
        return iter(self.plans)

    def __len__(self) -> int:
        return len(self.plans)


def spread(df: DataFrame) -> DataFrame:
    """Deals a table that comes in fewer parts than there are cores to all of them: work on its rows costs more than moving such a table."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


@dataclass
class Snapshot:
    """A published version. ``places``: for each table where each of its buckets lies; a bucket without rows has no place."""

    spark: SparkSession
    root: str
    version: int
    note: dict[str, str]
    buckets: int
    schemas: dict[str, str]
    places: dict[str, dict[int, str]]

    @functools.cached_property
    def tables(self) -> dict[str, DataFrame]:
        return {name: self.part(name) for name in self.schemas}

    @property
    def paths(self) -> dict[str, str]:
        """Where the tables of a snapshot of one bucket lie."""
        return {name: at[0] for name, at in self.places.items() if self.buckets == 1 and at}

    def part(self, name: str, buckets: set[int] | None = None) -> DataFrame:
        """A table, or only the buckets asked for."""
        schema = StructType.fromJson(json.loads(self.schemas[name]))
        paths = [path for b, path in sorted(self.places[name].items()) if buckets is None or b in buckets]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)


def bucket(key: Column | str, buckets: int) -> Column:
    """The bucket of a row by its first key column: all rows of one entity, in whatever table, are in the bucket of one number."""
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def folder(spark: SparkSession, path: str):
    """A Hadoop path and its file system."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def names_in(spark: SparkSession, path: str, prefix: str) -> list[str]:
    at, fs = folder(spark, path)
    return [x for s in (fs.listStatus(at) if fs.exists(at) else []) if (x := s.getPath().getName()).startswith(prefix)]


def write_buckets(df: DataFrame, path: str, buckets: int, touched: set[int] | None = None) -> dict[int, str]:
    """Writes ``df`` by bucket and returns where those with rows are."""
    if buckets == 1:
        with shuffles_let_go(df.sparkSession):
            df.write.mode("overwrite").parquet(path)
        return {0: path}
    rows = df.withColumn("bucket", bucket(df.columns[0], buckets))
    if touched is not None:
        rows = rows.where(F.col("bucket").isin(*touched))
    with shuffles_let_go(df.sparkSession):
        rows.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(path)
    return {int(x.removeprefix("bucket=")): f"{path}/{x}" for x in names_in(df.sparkSession, path, "bucket=")}


def _manifest(root: str, version: int) -> str:
    return f"{root}/manifest/version={version}"


def _sealed(spark: SparkSession, root: str) -> list[int]:
    """Versions whose manifest is whole, oldest first; at most as many as are kept, and one that was not finished."""
    found = sorted(int(x.removeprefix("version=")) for x in names_in(spark, f"{root}/manifest", "version="))
    return [v for v in found if (at := folder(spark, f"{_manifest(root, v)}/_SUCCESS"))[1].exists(at[0])]


def publish(
    tables: dict[str, DataFrame], root: str, version: int, note: dict[str, str] | None = None, before: Snapshot | None = None,
    buckets: int = 1, touched: dict[str, set[int]] | None = None, keep: int = 3,
) -> dict[str, dict[int, str]]:
    """Writes the tables of a version side by side, by bucket, then the manifest; readers follow manifests only, so a version appears whole or not at all.

    A table that is still the frame of ``before`` is not written again: the manifest names its old place. Where ``touched`` names a table, its frame holds
    at least these buckets, and only they are written; the others stay where they were, as do tables that ``tables`` lacks. ``note`` (such as the
    sync cursor) travels in the manifest. What only versions older than the last ``keep`` refer to is deleted. Returns where the tables are."""
    spark = next(iter(tables.values())).sparkSession if tables else before.spark
    buckets, touched = before.buckets if before else buckets, touched or {}
    places = {name: at for name, at in before.places.items()} if before else {}
    schemas = dict(before.schemas) if before else {}
    for name, df in tables.items():
        if before and name not in touched and df is before.tables.get(name):
            continue
        schemas[name] = df.schema.json()
        some = touched.get(name)
        kept = {b: path for b, path in places.get(name, {}).items() if some is not None and b not in some}
        if some is None or some:
            places[name] = kept | write_buckets(df, f"{root}/v={version}/{name}", buckets, some)
    rows = [("place", name, b, path) for name, at in places.items() for b, path in at.items()]
    rows += [("schema", name, buckets, schema) for name, schema in schemas.items()] + [("note", k, 0, v) for k, v in (note or {}).items()]
    spark.createDataFrame(rows, "kind string, name string, number int, value string").coalesce(1).write.mode("overwrite").parquet(_manifest(root, version))
    let_go(spark, root, keep)
    return places


def snapshot(spark: SparkSession, root: str, version: int) -> Snapshot:
    rows = spark.read.parquet(_manifest(root, version)).collect()  # a row a bucket
    schemas = {r["name"]: r["value"] for r in rows if r["kind"] == "schema"}
    places: dict[str, dict[int, str]] = {name: {} for name in schemas}
    for r in rows:
        if r["kind"] == "place":
            places[r["name"]][r["number"]] = r["value"]
    note = {r["name"]: r["value"] for r in rows if r["kind"] == "note"}
    return Snapshot(spark, root, version, note, max((r["number"] for r in rows if r["kind"] == "schema"), default=1), schemas, places)


def latest(spark: SparkSession, root: str) -> Snapshot:
    """The newest published version: its own manifest is all that is read."""
    return snapshot(spark, root, _sealed(spark, root)[-1])


def let_go(spark: SparkSession, root: str, keep: int) -> None:
    """Deletes what only older versions than the last ``keep`` refer to, and their manifests."""
    sealed = _sealed(spark, root)
    old, last = sealed[:-keep], sealed[-keep:]
    if not old:
        return
    paths = lambda v: {path for at in snapshot(spark, root, v).places.values() for path in at.values()}
    needed = set().union(*map(paths, last))
    for v in old:
        for path in [*(paths(v) - needed), _manifest(root, v)]:
            at, fs = folder(spark, path)
            fs.delete(at, True)
