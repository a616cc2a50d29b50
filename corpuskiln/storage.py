"""The cluster's shared folder, tables in it, and broadcasts of what was counted."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir; one of our own only where the setting is unset and all of Spark runs
    in this process (tests). On a cluster without the setting this is an error."""
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not where:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):  # local-cluster has other processes
            raise RuntimeError("name a folder that all machines share in spark.checkpoint.dir")
        where = "file://" + tempfile.mkdtemp(prefix="spark-corpuskiln-")
        spark.sparkContext.setCheckpointDir(where)
    return where


#: Spark's setting by which an execution deletes its shuffle files when it ends.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write df as a table in the shared folder and read it back: cuts lineage, survives lost executors.

    The shuffle files behind it are deleted as soon as the table stands, not when the driver happens to collect its garbage.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{tag}-{uuid.uuid4().hex}"
    was = spark.conf.get(DROP_SHUFFLES, None)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(DROP_SHUFFLES, was) if was is not None else spark.conf.unset(DROP_SHUFFLES)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete a table that materialize() wrote and that nothing lazy reads any more."""
    spark = df.sparkSession
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
        where = spark._jvm.org.apache.hadoop.fs.Path(folder)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


#: Bytes of a table, as measured, up to which it is broadcast. An executor holds it as a hash table of two to three times
#: that, for as long as a query of many such joins runs (near-duplicates have 35): together they stay near 100 MB.
BROADCAST_BYTES = 1_000_000


def measured(df: DataFrame) -> int:
    """About how many bytes the rows of df take: fixed widths, and the lengths of texts and arrays as they are."""
    width = F.lit(16)
    for name, kind in df.dtypes:
        c = F.col(f"`{name}`")
        if kind in ("string", "binary"):
            width = width + F.coalesce(F.octet_length(c), F.lit(0))
        elif kind.startswith(("array", "map")):
            width = width + 32 * F.greatest(F.size(c), F.lit(0))
        else:
            width = width + 16
    return df.agg(F.sum(width.cast("bigint")).alias("b")).first()["b"] or 0


def if_small(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """df marked for broadcast if its measured bytes are within the bound, else as it is, for a shuffled join."""
    return F.broadcast(df) if measured(df) <= max_bytes else df


def spread(df: DataFrame) -> DataFrame:
    """df dealt out evenly if its files give fewer tasks than there are cores; larger inputs are read as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
