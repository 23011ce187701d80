"""Far too many small files: partition-local compaction under snapshot versions.

The records of the small files belong to the store's partitions: the kind and a hash of the key, so
that all copies of a record meet in one partition and none is hot. The number of buckets is settled
when the store is created. Partitions with too many small files are rewritten into few files, the
others are left alone. Every attempt writes to a folder of its own, so it can neither touch what is
published nor what another writer does; only within that folder partitions are overwritten
dynamically, by tasks or jobs that are tried again. A version is published by putting its log file,
written in full beforehand, under the version's number in one step that fails if the number is
taken. A writer that finds versions published since it began goes on under the next number if they
rewrote none of its partitions; else it removes its own folder and fails.
"""

from __future__ import annotations

import json
import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quernel.session import cut

PARTITION = ["kind", "bucket"]
RECORD = T.StructType([T.StructField(n, t) for n, t in (("kind", T.StringType()), ("record_id", T.LongType()), ("fetched_at", T.StringType()), ("modified_at", T.TimestampNTZType()), ("body", T.StringType()))])


#: Rows of metadata up to which they are broadcast, of under 100 bytes each.
_BROADCAST_ROWS = 100_000


class VersionConflict(RuntimeError):
    """Another writer rewrote the same partitions first; read again and start over."""


class VersionedStore:
    """data/attempt=/kind=/bucket=/*.parquet, _versions/<number>.json and _store.json below one folder.

    A version's log has one line for each partition it rewrote: kind, bucket, attempt, version and bytes. The
    folder must be on a file system that renames or links in one step (HDFS, shared POSIX folders).
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = 1) -> None:
        """buckets counts for a new store only; an old one keeps its number."""
        self.spark, self.path = spark, path.rstrip("/")
        self._jvm = spark._jvm
        self._path = self._jvm.org.apache.hadoop.fs.Path
        self._conf = spark._jsc.hadoopConfiguration()
        self._fs = self._path(self.path).getFileSystem(self._conf)
        try:
            self._put("_store.json", json.dumps({"buckets": buckets}))
        except VersionConflict:
            pass
        with_buckets = self._fs.open(self._path(f"{self.path}/_store.json"))
        try:
            self.buckets = int(json.loads(bytes(with_buckets.readAllBytes()).decode())["buckets"])
        finally:
            with_buckets.close()

    def _put(self, name: str, text: str) -> None:
        """A file with all of its text or none; VersionConflict if it is there already."""
        target, draft = f"{self.path}/{name}", self._path(f"{self.path}/_drafts/{uuid.uuid4().hex}")
        if self._fs.exists(self._path(target)):
            raise VersionConflict(f"{target} is already published")
        out = self._fs.create(draft, False)
        out.write(bytearray(text.encode()))
        out.close()
        self._fs.mkdirs(self._path(target).getParent())
        try:
            if self._fs.getUri().getScheme() == "file":  # a rename would replace the other file; a link does not
                os.link(draft.toUri().getPath(), self._path(target).toUri().getPath())
            else:
                none = self._jvm.org.apache.hadoop.fs.Options.Rename.NONE
                options = self.spark.sparkContext._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 1)
                options[0] = none
                self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri(), self._conf).rename(draft, self._path(target), options)
        except Exception as error:
            if not self._fs.exists(self._path(target)):
                raise
            raise VersionConflict(f"{target} is already published") from error
        finally:
            self._fs.delete(draft, False)

    def version(self) -> int:
        """The newest published version, 0 for a new store."""
        folder = self._path(f"{self.path}/_versions")
        if not self._fs.exists(folder):
            return 0
        return max([int(f.getPath().getName().split(".")[0]) for f in self._fs.listStatus(folder) if f.getPath().getName().endswith(".json")], default=0)

    def current(self, version: int | None = None) -> DataFrame:
        """kind, bucket, attempt, v, bytes: where each partition stands as of a version. One row per partition."""
        upto = self.version() if version is None else version
        names = [f"{self.path}/_versions/{v:012d}.json" for v in range(1, upto + 1)]
        schema = "kind string, bucket int, attempt string, v int, bytes bigint"
        logs = self.spark.read.schema(schema).json(names) if names else self.spark.createDataFrame([], schema)
        return logs.groupBy(*PARTITION).agg(F.max_by(F.struct("attempt", "v", "bytes"), "v").alias("_l")).select(*PARTITION, "_l.*")

    def write(self, records: DataFrame, rows_a_file: int) -> str:
        """Put records (with kind and bucket) into a folder of their own, not visible yet; gives back its name."""
        attempt = uuid.uuid4().hex
        writer = records.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", rows_a_file)
        writer.partitionBy(*PARTITION).parquet(f"{self.path}/data/attempt={attempt}")
        return attempt

    def discard(self, attempt: str) -> None:
        """Remove an attempt that was not published."""
        self._fs.delete(self._path(f"{self.path}/data/attempt={attempt}"), True)

    def publish(self, base: int, attempt: str, partitions: list[tuple[str, int, int]]) -> int:
        """Make the attempt's (kind, bucket, bytes) visible to readers; gives back the version.

        base is the version the writer read. If a later one rewrote one of the partitions, the attempt is
        discarded and VersionConflict raised.
        """
        mine, version = {(k, b) for k, b, _ in partitions}, base + 1
        while True:
            text = "".join(json.dumps({"kind": k, "bucket": b, "attempt": attempt, "v": version, "bytes": n}) + "\n" for k, b, n in sorted(partitions))
            try:
                self._put(f"_versions/{version:012d}.json", text)
            except VersionConflict:
                log = self._fs.open(self._path(f"{self.path}/_versions/{version:012d}.json"))
                lines = bytes(log.readAllBytes()).decode().splitlines()
                log.close()
                theirs = {(x["kind"], x["bucket"]) for x in map(json.loads, lines)}
                if mine & theirs:
                    self.discard(attempt)
                    raise
                version += 1
            else:
                return version

    def read(self, version: int | None = None, schema: T.StructType = RECORD) -> DataFrame:
        """The records as of a published version (None: the newest), from the attempts that still hold a partition."""
        current = self.current(version).select(*PARTITION, "attempt")
        # an attempt a version, so metadata
        attempts = sorted(r[0] for r in current.select("attempt").distinct().toLocalIterator())
        if not attempts:
            return self.spark.createDataFrame([], T.StructType([*schema.fields, T.StructField("bucket", T.IntegerType())]))
        typed = T.StructType([*[f for f in schema.fields if f.name not in PARTITION], T.StructField("attempt", T.StringType()), T.StructField("kind", T.StringType()), T.StructField("bucket", T.IntegerType())])
        data = self.spark.read.schema(typed).option("basePath", f"{self.path}/data").parquet(*[f"{self.path}/data/attempt={a}" for a in attempts])
        return data.join(current, [*PARTITION, "attempt"], "left_semi").select(*schema.names, "bucket")

    def vacuum(self) -> list[str]:
        """Remove attempts that no partition of the newest version needs any more; gives back their names.

        Only while no other writer is at work (its unpublished folder would go too) and no old version is read.
        """
        used = {r[0] for r in self.current().select("attempt").distinct().toLocalIterator()}
        folder = self._path(f"{self.path}/data")
        names = [f.getPath().getName().removeprefix("attempt=") for f in self._fs.listStatus(folder)] if self._fs.exists(folder) else []
        gone = sorted(n for n in names if n not in used)
        for name in gone:
            self.discard(name)
        return gone


def bucket_of(buckets: int) -> Column:
    return F.pmod(F.xxhash64("kind", "record_id"), F.lit(buckets)).cast("int")


def one_per_record(records: DataFrame) -> DataFrame:
    """The newest copy of each record: by fetched_at, then modified_at, then body; null times are oldest.

    The maximum combines within each task before the shuffle, so a record with very many copies does no harm.
    """
    newest = records.groupBy("kind", "record_id").agg(F.max(F.struct("fetched_at", "modified_at", "body")).alias("_n"))
    return newest.select("kind", "record_id", "_n.*")


def compact(store: VersionedStore, records: DataFrame, min_files: int = 16, target_bytes: int = 128 << 20) -> DataFrame:
    """Consolidate the records of files (file_id, file_bytes, kind, record_id, body, fetched_at, modified_at) into the store.

    A file is small below half of target_bytes (null counts as small). The partitions with records in more than
    min_files small files are rewritten, together with what the store holds of them, and published; others stay
    as they are. Gives back the records of the store and of the files left alone, each exactly once, the newest
    copy of each. Files hold at most about target_bytes. Rows without a kind or record_id are left out. An empty
    input publishes nothing. If another writer rewrote one of the partitions meanwhile, VersionConflict is raised
    and the store is as that writer left it.
    """
    base = store.version()
    landed = records.dropna(subset=["kind", "record_id"]).withColumn("bucket", bucket_of(store.buckets))
    # read twice, by the survey and by the rewrite, and parsing is the dear step
    landed = cut(landed.select("file_id", "file_bytes", *RECORD.names, "bucket"))
    small = F.coalesce(F.col("file_bytes") < target_bytes // 2, F.lit(True))
    survey = landed.groupBy(*PARTITION, "file_id").agg(F.max(small).alias("_s"), F.sum(F.octet_length("body")).alias("_b"), F.count("*").alias("_n"))
    survey = survey.groupBy(*PARTITION).agg(F.count_if("_s").alias("n_small"), F.sum("_b").alias("bytes"), F.sum("_n").alias("n_rows"))
    # one row per partition: metadata, sized by the number of buckets and kinds
    counts = {(r["kind"], r["bucket"]): r for r in survey.toLocalIterator()}
    crowded = [r for r in counts.values() if r["n_small"] > min_files]
    if not crowded:
        return one_per_record(store.read(base).select(*RECORD.names).unionByName(landed.select(*RECORD.names))) if base else one_per_record(landed)
    held = {(r["kind"], r["bucket"]): r["bytes"] for r in store.current(base).toLocalIterator()}
    sizes = [(r["kind"], r["bucket"], r["bytes"] + held.get((r["kind"], r["bucket"]), 0)) for r in crowded]
    # a partition above the target is cut into slices, so that no task and no file gets too large
    slices = [(k, b, max(1, -(-n // target_bytes))) for k, b, n in sizes]
    chosen = store.spark.createDataFrame(slices, "kind string, bucket int, _slices bigint")
    if len(slices) <= _BROADCAST_ROWS:
        chosen = F.broadcast(chosen)
    fresh = landed.select(*RECORD.names, "bucket")
    both = fresh.unionByName(store.read(base)) if base else fresh
    full = one_per_record(both.join(chosen, PARTITION, "left_semi")).withColumn("bucket", bucket_of(store.buckets)).join(chosen, PARTITION)
    cell = F.pmod(F.xxhash64("record_id", "kind", "bucket"), F.col("_slices"))
    rows_a_file = max(1, sum(r["n_rows"] for r in crowded) * target_bytes // max(1, sum(r["bytes"] for r in crowded)))
    attempt = store.write(full.repartition(*PARTITION, cell).drop("_slices"), rows_a_file)
    version = store.publish(base, attempt, sizes)
    whole = store.read(version).select(*RECORD.names)
    if len(crowded) == len(counts):
        return whole
    # partitions left alone: what the store has of them, and their small files
    here = store.read(version)
    few = one_per_record(fresh.unionByName(here).join(chosen, PARTITION, "left_anti").select(*RECORD.names))
    return here.join(chosen, PARTITION, "left_semi").select(*RECORD.names).unionByName(few)
