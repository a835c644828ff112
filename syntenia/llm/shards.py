"""Sharding by size-tiered compaction.

A store is a folder of immutable Parquet shards and of manifests, one for each
version. ``append`` writes arrivals as small shards and commits a version that adds
them. ``compact`` puts shards into tiers by size (each tier ``FAN`` times the one
below) and merges the shards of a tier once there are ``FAN`` of them, into files of
about the target size: Spark's file reader packs whole small files into one task up
to the target, and each task writes one shard, so nothing is shuffled. What a merge
writes is at least one tier higher, so a row is rewritten as often as the logarithm
of the number of arrivals. ``vacuum`` deletes shards that kept versions don't list,
and what lost writers left.

A version is a table of changes, shards added and dropped; every ``BASE``-th lists
all shards instead, so a commit costs what it changes. It is committed by renaming
the complete table to its final name; the rename fails if the name exists, so of two
writers one wins and the other tries again on the new version. A compaction whose
shards another one has replaced by then is given up. Readers see a version whole or
not at all. Shards keep the schema they came with; a version's schema is all
columns of its shards, and arrivals that give a known column another type are refused.
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from syntenia.llm import common

TARGET_BYTES, FAN, SMALLEST = 64 << 20, 4, 1 << 20
ARRIVAL_ROWS = 2048
BASE = 16
#: Shards of a tier that one merge takes; the next one takes others.
MERGED = 4096
#: Seconds for which vacuum leaves alone what no version lists: a writer may still commit it.
GRACE = 24 * 3600
CHANGES = "kind string, path string, folder string, in_folder long, rows long, bytes long, tier int, since int, schema string"
SHARDS = "path string, folder string, in_folder long, rows long, bytes long, tier int, since int, schema string"


class Conflict(RuntimeError):
    """Another writer committed the version first."""


def merged_schema(schemas: list[str]) -> StructType:
    """All columns of some schemas, as JSON, in order of appearance; raises ValueError if their types differ."""
    out: dict[str, dict] = {}
    for text in schemas:
        for field in json.loads(text)["fields"]:
            known = out.setdefault(field["name"], field)
            if known["type"] != field["type"]:
                raise ValueError(f"column {field['name']} is {known['type']} and {field['type']}")
    return StructType.fromJson({"type": "struct", "fields": [f | {"nullable": True} for f in out.values()]})


class ShardStore:
    def __init__(self, spark: SparkSession, root: str, target_bytes: int = TARGET_BYTES, arrival_rows: int = ARRIVAL_ROWS):
        self.spark, self.root = spark, root.rstrip("/")
        self.target, self.arrival_rows = target_bytes, arrival_rows
        _, self.fs = common.hadoop_path(spark, self.root)
        self.fs.mkdirs(self._path("manifests"))
        self._schemas: dict[int, StructType] = {}  # of versions, which never change
        self._merging: dict[str, tuple[int, int]] = {}  # of a merge's folder: the version it read, the tier it reaches

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")

    def versions(self) -> list[int]:
        """The committed versions that are kept."""
        names = [s.getPath().getName() for s in self.fs.listStatus(self._path("manifests"))]
        return sorted(int(n[1:]) for n in names if n.startswith("v"))

    def version(self) -> int:
        """The latest committed version; 0 if there is none."""
        return max(self.versions(), default=0)

    def manifest(self, version: int | None = None) -> DataFrame:
        """(path, folder, in_folder, rows, bytes, tier, since, schema): the shards of a version."""
        v = self.version() if version is None else version
        if not v:
            return self.spark.createDataFrame([], SHARDS)
        first = max(1, v - v % BASE)
        read = lambda n: self.spark.read.schema(CHANGES).parquet(f"{self.root}/manifests/v{n:08d}")
        changes = read(first)
        for n in range(first + 1, v + 1):
            changes = changes.union(read(n))
        added = changes.where("kind = 'add'").drop("kind")
        return added.join(changes.where("kind = 'drop'").select("path"), "path", "left_anti") if v > first else added

    def commit(self, added: DataFrame, dropped: DataFrame | None, base: int) -> int:
        """Publishes the changes as the version after ``base``, or raises Conflict."""
        jvm, version = self.spark._jvm, base + 1
        changes = added
        if version % BASE == 0:
            old = self.manifest(base)
            changes = (old if dropped is None else old.join(dropped.select("path"), "path", "left_anti")).unionByName(added)
        changes = changes.select(F.lit("add").alias("kind"), *changes.columns)
        if dropped is not None and version % BASE:
            nothing = [F.lit(None).alias(c) for c in ("folder", "in_folder", "rows", "bytes", "tier", "since", "schema")]
            changes = changes.unionByName(dropped.select(F.lit("drop").alias("kind"), "path", *nothing))
        schema = self.spark.createDataFrame([], CHANGES).schema
        changes = changes.select(*[F.col(f.name).cast(f.dataType) for f in schema])
        tmp, final = f"manifests/_{uuid.uuid4().hex}", f"manifests/v{version:08d}"
        changes.write.parquet(f"{self.root}/{tmp}")
        rename = jvm.org.apache.hadoop.fs.Options.Rename
        how = self.spark.sparkContext._gateway.new_array(rename, 1)
        how[0] = getattr(rename, "NONE")
        files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._path("manifests").toUri() if "://" in self.root else self.fs.getUri(), self.spark._jsc.hadoopConfiguration())
        try:
            files.rename(self._path(tmp), self._path(final), how)
        except Exception as e:
            self.fs.delete(self._path(tmp), True)
            if self.fs.exists(self._path(final)):
                raise Conflict(final) from e
            raise
        return version

    def _files(self, folder: str) -> int:
        """Parquet files in a folder."""
        return sum(f.getPath().getName().endswith(".parquet") for f in self.fs.listStatus(self._path(folder)))

    def _described(self, folder: str, since: int, schema: str, least: int) -> DataFrame:
        """Manifest rows of the files in a folder, in tier ``least`` or a higher one."""
        meta = self.spark.read.schema(StructType.fromJson(json.loads(schema))).parquet(f"{self.root}/{folder}")
        held = meta.groupBy(F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_size").alias("bytes")).agg(F.count("*").alias("rows"))
        tier = F.greatest(F.lit(least), F.ceil(F.log(F.col("bytes") / SMALLEST) / F.log(F.lit(float(FAN))))).cast("int")
        return held.select(F.concat(F.lit(f"{folder}/"), "file").alias("path"), F.lit(folder).alias("folder"), F.lit(self._files(folder)).alias("in_folder"), "rows", "bytes", tier.alias("tier"), F.lit(since).alias("since"), F.lit(schema).alias("schema"))

    def schema(self, version: int | None = None) -> StructType:
        """All columns of a version's shards; no columns for an empty store."""
        v = self.version() if version is None else version
        if v not in self._schemas:
            kinds = self.manifest(v).groupBy("schema").agg(F.min("since").alias("since")).orderBy("since", "schema")
            self._schemas[v] = merged_schema([r["schema"] for r in kinds.collect()])
        return self._schemas[v]

    def _commit_retrying(self, folder: str, schema: StructType, dropped: DataFrame | None, tries: int = 5) -> int:
        """Commits a folder's shards in place of those that are dropped."""
        seen, least = self._merging.pop(folder, (-1, 0))
        for _ in range(tries):
            base = self.version()
            both = merged_schema([self.schema(base).json(), schema.json()])
            if dropped is not None and base != seen and not dropped.join(self.manifest(base), "path", "left_anti").isEmpty():
                break  # another compaction has replaced some of these shards
            try:
                version = self.commit(self._described(folder, base + 1, schema.json(), least), dropped, base)
            except Conflict:
                continue
            self._schemas[version] = both
            return version
        common.drop_path(self.spark, f"{self.root}/{folder}")
        raise Conflict(f"{folder} was not committed")

    def append(self, rows: DataFrame) -> int:
        """Adds arrivals as small immutable shards; returns the version.

        No rows commit nothing. Raises ValueError if a column has another type in the store.
        """
        merged_schema([self.schema().json(), rows.schema.json()])
        folder = f"data/{uuid.uuid4().hex}"
        rows.write.option("maxRecordsPerFile", self.arrival_rows).option("compression", "zstd").parquet(f"{self.root}/{folder}")
        if self.spark.read.schema(rows.schema).parquet(f"{self.root}/{folder}").isEmpty():
            common.drop_path(self.spark, f"{self.root}/{folder}")
            return self.version()
        return self._commit_retrying(folder, rows.schema, None)

    def compact(self, least: int = FAN) -> int:
        """Merges the shards of every tier below the target that has ``least`` of them; returns the version.

        With ``least`` 2 all small shards of a tier are merged, as for a store that is complete. If another
        compaction replaces the same shards meanwhile, its version holds and the rest is tried again.
        """
        done: set[int] = set()
        conflicts = 0
        while True:
            seen = self.version()
            small = self.manifest(seen).where(F.col("bytes") * 4 < 3 * self.target)
            tiers = [r["tier"] for r in small.groupBy("tier").count().where(F.col("count") >= max(2, least)).select("tier").orderBy("tier").collect()]
            tiers = [t for t in tiers if t not in done]
            if not tiers:
                return self.version()
            try:
                if not self._merge(small.where(F.col("tier") == tiers[0]), tiers[0], seen):
                    done.add(tiers[0])
            except Conflict:
                conflicts += 1
                if conflicts == 5:
                    raise

    def _merge(self, shards: DataFrame, tier: int, seen: int) -> bool:
        """Writes up to MERGED shards of a tier anew as fewer ones, a tier higher, and commits them; False if they are no fewer."""
        old = shards.select("path", "folder", "in_folder").orderBy("since", "path").limit(MERGED).collect()
        schema = self.schema(seen)
        want = {"spark.sql.files.maxPartitionBytes": str(self.target), "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "1"}
        folder = f"data/{uuid.uuid4().hex}"
        with common.settings(self.spark, want):
            self.spark.read.schema(schema).parquet(*self._places(old)).write.option("compression", "zstd").parquet(f"{self.root}/{folder}")
        if self._files(folder) >= len(old):
            common.drop_path(self.spark, f"{self.root}/{folder}")
            return False
        self._merging[folder] = seen, tier + 1
        self._commit_retrying(folder, schema, self.spark.createDataFrame([(r["path"],) for r in old], "path string"))
        return True

    def _places(self, shards: list) -> list[str]:
        """What the reader has to list for (path, folder, in_folder): folders of which all shards are wanted, else single shards."""
        of: dict[tuple[str, int], list[str]] = {}
        for r in shards:
            of.setdefault((r["folder"], r["in_folder"]), []).append(r["path"])
        return [f"{self.root}/{p}" for (folder, n), paths in of.items() for p in ([folder] if len(paths) == n else paths)]

    def vacuum(self, keep: int = 1, grace: float = GRACE) -> int:
        """Deletes shards and manifests that the last ``keep`` versions don't need; returns the number of shards.

        Folders and unfinished manifests that no version lists are what lost writers left. They go once
        they are older than ``grace`` seconds, so that a writer between write and commit keeps its own.
        """
        versions = self.versions()
        last = max(versions, default=0)
        kept = self.spark.createDataFrame([], "path string, folder string")
        for v in range(max(1, last - keep + 1), last + 1):
            kept = kept.union(self.manifest(v).select("path", "folder"))
        folders = kept.select("folder", F.lit(True).alias("held")).distinct()
        old_versions = [v for v in versions if v <= last - keep]
        gone = 0
        if old_versions:
            read = lambda v: self.spark.read.schema(CHANGES).parquet(f"{self.root}/manifests/v{v:08d}").where("kind = 'add'").select("path", "folder")
            old = read(old_versions[0])
            for v in old_versions[1:]:
                old = old.union(read(v))
            old = old.distinct().join(kept, "path", "left_anti").join(folders, "folder", "left")
            for r in old.where("held").select("path").toLocalIterator():
                gone += self.fs.delete(self._path(r["path"]), False)
            for r in old.where("held is null").groupBy("folder").agg(F.count("*").alias("n")).toLocalIterator():
                gone += r["n"] * self.fs.delete(self._path(r["folder"]), True)
        before = 1000 * (time.time() - grace)
        late = lambda name: [s.getPath().getName() for s in self.fs.listStatus(self._path(name)) if s.getModificationTime() <= before] if self.fs.exists(self._path(name)) else []
        unlisted = self.spark.createDataFrame([(f"data/{n}",) for n in late("data")], "folder string").join(folders, "folder", "left_anti")
        for r in unlisted.toLocalIterator():
            gone += self._files(r["folder"])
            self.fs.delete(self._path(r["folder"]), True)
        first = max(1, (last - keep + 1) - (last - keep + 1) % BASE)
        for name in [f"v{v:08d}" for v in old_versions if v < first] + [n for n in late("manifests") if n.startswith("_")]:
            self.fs.delete(self._path(f"manifests/{name}"), True)
        return gone

    def read(self, version: int | None = None, schema: StructType | None = None) -> DataFrame:
        """All rows of a version, with all its columns; an empty store has neither."""
        v = self.version() if version is None else version
        whole = self.manifest(v).groupBy("folder", "in_folder").agg(F.count("*").alias("n"), F.collect_list("path").alias("paths"))
        rows = whole.select("folder", F.when(F.col("n") < F.col("in_folder"), F.col("paths")).alias("paths")).collect()
        schema, places = schema or self.schema(v), [f"{self.root}/{p}" for r in rows for p in (r["paths"] or [r["folder"]])]
        return self.spark.read.schema(schema).parquet(*places) if places else self.spark.createDataFrame([], schema)


def sharded(docs: DataFrame, root: str | None = None, target_bytes: int = TARGET_BYTES) -> DataFrame:
    """Puts the rows into a store, compacts it and returns where each went.

    (doc_id, source, shard, row_in_shard, shard_rows, shard_bytes, tier, version) for
    every row, repeated ones included. Nulls are stored as they are; an empty table
    commits nothing and gives no rows; all columns of ``docs`` are stored, whatever
    their names.
    """
    spark = docs.sparkSession
    store = ShardStore(spark, root or common.scratch_path(spark, "shards"), target_bytes)
    store.append(docs)
    store.compact()
    store.vacuum()
    schema = "doc_id long, source string, shard string, row_in_shard long, shard_rows long, shard_bytes long, tier int, version int"
    version = store.version()
    if not version:
        return spark.createDataFrame([], schema)
    m = store.manifest(version).select(F.regexp_extract("path", "[^/]+$", 0).alias("shard"), F.col("rows").alias("shard_rows"), F.col("bytes").alias("shard_bytes"), "tier")
    m = common.few(m, 100_000)
    rows = store.read(version).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), F.col("_metadata.file_name").alias("shard"), F.col("_metadata.row_index").alias("row_in_shard"))
    return rows.join(m, "shard").select("doc_id", "source", "shard", "row_in_shard", "shard_rows", "shard_bytes", "tier", F.lit(version).alias("version"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each row of ``documents`` stands in a compacted store; edge cases as in ``sharded``."""
    return sharded(common.table(spark, sf_dir, "documents"))
