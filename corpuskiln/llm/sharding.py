"""A sharded dataset with size-tiered compaction and atomically committed versions.

Arrivals are appended as small immutable Parquet shards. Compaction looks at the sizes of the shards below
the target: neighbouring sizes within a factor of RATIO are a tier, and a tier of at least MIN_RUN shards is
merged into files of about target_bytes, by reading the run's shards together in few tasks: no shuffle.
What a version holds is a manifest, a Parquet table with one row a shard; a version is the file
versions/<number>.json, which names its manifest and comes into being by one rename that fails if the
number is taken (atomic on file systems with an atomic rename, HDFS for one; object stores need one put
over them that refuses to overwrite). Readers see whole versions only. A writer that loses the race takes
the next number; a compaction whose shards another one has merged meanwhile deletes its own and gives up.
expire() deletes the shards that no kept version names.

What comes to the driver is a histogram of sizes, and the names of the files that are read, as in any file
source of Spark.

Defined cases: an empty arrival adds no shard but a version; rows that repeat, nulls in any column, clashing
names like file or bytes, empty and very long texts come back as they are (shards are cut by rows, so long
texts make larger ones); shards of equal size are one tier; an arrival's columns must be those of the
dataset, by name; a dataset without rows reads as an empty table of its schema.
"""

from __future__ import annotations

import json
import math
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from corpuskiln.llm.common import shared_dir, table

TARGET_BYTES, RATIO, MIN_RUN = 128_000_000, 4, 4
#: Rows of an arrival that go into one shard at most.
SHARD_ROWS = 10_000
MANIFEST = "file string, n_rows bigint, bytes bigint"


class Conflict(RuntimeError):
    """Another writer has committed first what this one builds on."""


class ShardStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._jvm, self._conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()

    def _path(self, *parts: str):
        return self._jvm.org.apache.hadoop.fs.Path("/".join((self.root, *parts)))

    def _fs(self):
        return self._path().getFileSystem(self._conf)

    def version(self) -> int:
        """The latest version; 0 for a dataset that isn't there yet."""
        return max(self._numbers(), default=0)

    def _head(self, version: int) -> dict:
        stream = self._fs().open(self._path("versions", f"{version:012d}.json"))
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def manifest(self, version: int | None = None) -> DataFrame:
        """(file, n_rows, bytes) of a version's shards; files are named below the root."""
        version = self.version() if version is None else version
        if not version:
            return self.spark.createDataFrame([], MANIFEST)
        return self.spark.read.schema(MANIFEST).parquet(f"{self.root}/{self._head(version)['manifest']}")

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version."""
        version = self.version() if version is None else version
        schema = StructType.fromJson(self._head(version)["schema"])
        # the list of files is on the driver as in any file source of Spark
        files = [f"{self.root}/{r['file']}" for r in self.manifest(version).select("file").collect()]
        return self.spark.read.schema(schema).parquet(*files) if files else self.spark.createDataFrame([], schema)

    def _numbers(self) -> list[int]:
        where = self._path("versions")
        names = [s.getPath().getName() for s in self._fs().listStatus(where)] if self._fs().exists(where) else []
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def _commit(self, base: int, manifest: DataFrame, schema: StructType, what: str) -> int:
        name = f"manifests/{uuid.uuid4().hex}"
        manifest.coalesce(1).write.parquet(f"{self.root}/{name}")
        draft, final = self._path("versions", f".{uuid.uuid4().hex}"), self._path("versions", f"{base + 1:012d}.json")
        out = self._fs().create(draft, False)
        out.write(bytearray(json.dumps({"manifest": name, "schema": schema.jsonValue(), "operation": what, "base": base}), "utf-8"))
        out.close()
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri() if draft.toUri().getScheme() else self._fs().getUri(), self._conf)
        options = self.spark.sparkContext._gateway.new_array(getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            context.rename(draft, final, options)
        except Exception as e:
            for lost in (draft, self._path(name)):
                self._fs().delete(lost, True)
            if self._fs().exists(final):
                raise Conflict(f"version {base + 1} is there already") from e
            raise
        return base + 1

    def _listed(self, name: str, schema: StructType) -> DataFrame:
        seen = self.spark.read.schema(schema).parquet(f"{self.root}/{name}").select("_metadata.file_name", "_metadata.file_size")
        return seen.groupBy(F.concat(F.lit(f"{name}/"), "file_name").alias("file")).agg(F.count("*").alias("n_rows"), F.max("file_size").alias("bytes"))

    def append(self, rows: DataFrame) -> int:
        """Add an arrival; returns the version that holds it."""
        name = f"data/{uuid.uuid4().hex}"
        rows.write.option("compression", "zstd").option("maxRecordsPerFile", SHARD_ROWS).parquet(f"{self.root}/{name}")
        new = self._listed(name, rows.schema)
        while True:
            base = self.version()
            if base and set(StructType.fromJson(self._head(base)["schema"]).names) != set(rows.columns):
                raise ValueError("the arrival's columns are not those of the dataset")
            try:
                return self._commit(base, self.manifest(base).union(new), rows.schema if not base else StructType.fromJson(self._head(base)["schema"]), "append")
            except Conflict:
                continue

    def tiers(self, shards: DataFrame, min_run: int) -> list[tuple[int, int, int]]:
        """(smallest, largest, bytes in all) of the runs of similar sizes that have enough shards."""
        sizes = shards.groupBy(F.floor(F.log2(F.greatest("bytes", F.lit(1))) * 8).alias("bin"))
        bins = sizes.agg(F.count("*").alias("n"), F.sum("bytes").alias("sum"), F.min("bytes").alias("lo"), F.max("bytes").alias("hi")).orderBy("bin").collect()
        out, at = [], 0
        while at < len(bins):  # at most some hundred bins, by the range of sizes
            end = at
            while end < len(bins) and bins[end]["hi"] <= RATIO * max(bins[at]["lo"], 1):
                end += 1
            end = max(end, at + 1)
            if sum(b["n"] for b in bins[at:end]) >= min_run:
                out.append((bins[at]["lo"], bins[end - 1]["hi"], sum(b["sum"] for b in bins[at:end])))
                at = end
            else:
                at += 1
        return out

    def compact(self, target_bytes: int = TARGET_BYTES, min_run: int = MIN_RUN) -> int:
        """Merge the tiers that have enough shards below the target; returns the version afterwards."""
        base = self.version()
        if not base:
            return 0
        schema = StructType.fromJson(self._head(base)["schema"])
        small = self.manifest(base).where(F.col("bytes") < F.lit(target_bytes // 2))
        made, folders, merged = None, [], None
        for lo, hi, total in self.tiers(small, min_run):  # a handful
            run = small.where(F.col("bytes").between(lo, hi)).select("file")
            files = [f"{self.root}/{r['file']}" for r in run.orderBy("file").collect()]
            folders.append(f"data/{uuid.uuid4().hex}")
            rows = self.spark.read.schema(schema).parquet(*files).coalesce(max(1, math.ceil(total / target_bytes)))
            rows.write.option("compression", "zstd").parquet(f"{self.root}/{folders[-1]}")
            new = self._listed(folders[-1], schema)
            made, merged = (new, run) if made is None else (made.union(new), merged.union(run))
        if made is None:
            return base
        while True:
            shards = self.manifest(base)
            if merged.join(shards, "file", "left_anti").limit(1).count():  # merged by another one meanwhile
                for f in folders:
                    self._fs().delete(self._path(f), True)
                return base
            try:
                return self._commit(base, shards.join(merged, "file", "left_anti").union(made), schema, "compact")
            except Conflict:
                base = self.version()

    def expire(self, keep: int = 1) -> list[str]:
        """Delete the shards and version files of all but the latest versions; returns what went.

        Files of unfinished writers are younger than the versions read here; only what older versions name goes.
        """
        numbers = self._numbers()
        kept, old = numbers[-keep:], numbers[:-keep]
        if not old:
            return []
        here = self._files(kept)
        gone = self._files(old).join(here, "file", "left_anti")
        # a folder that no kept shard lies in goes whole
        folder = F.regexp_replace("file", "/[^/]*$", "")
        whole = gone.select(folder.alias("f")).distinct().join(here.select(folder.alias("f")).distinct(), "f", "left_anti")
        single = gone.withColumn("f", folder).join(whole, "f", "left_anti").select("file")
        targets = [r[0] for r in whole.union(single).collect()]
        out = [t for t in targets if self._fs().delete(self._path(t), True)]
        manifests = {self._head(v)["manifest"] for v in kept}
        for v in old:
            name = self._head(v)["manifest"]
            if name not in manifests:
                self._fs().delete(self._path(name), True)
            self._fs().delete(self._path("versions", f"{v:012d}.json"), False)
        return out

    def _files(self, versions: list[int]) -> DataFrame:
        paths = sorted({f"{self.root}/{self._head(v)['manifest']}" for v in versions})
        return self.spark.read.schema(MANIFEST).parquet(*paths).select("file").distinct()


#: Sizes of the arrivals of op2_sharding in sixteenths: four small ones make one of the next tier's size.
SHARES = (1, 1, 1, 1, 4, 4, 4)


def arrivals(rows: DataFrame, by: str, where: str, shares: tuple[int, ...] = SHARES) -> list[DataFrame]:
    """rows dealt to a landing folder, once, as arrivals of the given shares by a hash of a column."""
    point = F.pmod(F.xxhash64(by), F.lit(sum(shares)))
    number = F.lit(len(shares) - 1)
    for k in range(len(shares) - 1, -1, -1):
        number = F.when(point < sum(shares[: k + 1]), k).otherwise(number)
    rows.withColumn("__arrival", number).write.partitionBy("__arrival").option("compression", "zstd").parquet(where)
    spark, out = rows.sparkSession, []
    for k in range(len(shares)):
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{where}/__arrival={k}")
        there = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)
        out.append(spark.read.schema(rows.schema).parquet(f"{where}/__arrival={k}") if there else spark.createDataFrame([], rows.schema))
    return out


def arrived(docs: DataFrame, by: str = "doc_id") -> ShardStore:
    """A dataset that docs came to in seven arrivals, compacted after each."""
    spark = docs.sparkSession
    base = f"{shared_dir(spark).rstrip('/')}/shards-{uuid.uuid4().hex}"
    store = ShardStore(spark, f"{base}/store")
    for part in arrivals(docs, by, f"{base}/landing"):
        store.append(part)
        store.compact()
    store.expire()
    return store


def op2_sharding(spark, sf_dir: str) -> DataFrame:
    """Documents arrive in seven slices of two sizes, are compacted after each, and are read back from the last version."""
    rows = arrived(table(spark, sf_dir, "documents")).read()
    return rows.select("doc_id", "lang", "source", "n_chars", F.length("text").alias("text_chars"), F.sha2(F.encode("text", "UTF-8"), 256).alias("text_sha256"))


OP2_SQL = "select doc_id, lang, source, n_chars, cast(length(text) as integer) as text_chars, sha256(text) as text_sha256 from documents"
