"""Session helpers: table access, shared checkpoint folder, lineage cuts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """One parquet table of a data folder."""
    return spark.read.parquet(f"{base}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, from ``spark.checkpoint.dir``.

    Only a local session without that setting (tests) gets a folder of its own; on a cluster executors would not share it.
    """
    given = spark.conf.get("spark.checkpoint.dir", None)
    if not given:
        current = spark.sparkContext.getCheckpointDir()
        if current:
            return current
        master = spark.sparkContext.master or ""
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        given = tempfile.mkdtemp(prefix="conceptloom-")
        spark.conf.set("spark.checkpoint.dir", given)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(given)
    return given


def cut(df: DataFrame, eager: bool = True) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=eager)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a written table inside the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a stage once to the shared folder and read it back."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


HOT_ROWS = 100_000


def hot_keys(counts: DataFrame, key: str, n: str, hot_rows: int = HOT_ROWS) -> DataFrame | None:
    """Keys with more than ``hot_rows`` rows, from a stored table of counts; None if there are none.

    There are fewer than rows/hot_rows of them: this bound is what allows their broadcast.
    """
    hot = counts.where((F.col(n) > hot_rows) & F.col(key).isNotNull()).select(key)
    return None if hot.isEmpty() else hot


def salted_lookup(rows: DataFrame, index: DataFrame, key: str, hot: DataFrame | None, how: str = "left", salts: int = 64) -> DataFrame:
    """Join rows with an index that has one row per key, whatever the skew of ``key`` in rows.

    ``hot``: the keys to spread, from ``hot_keys``. Rows of a hot key get a salt from their own content and its
    index row one copy per salt; all other keys join as they are. A null key matches nothing and, under a
    left join, is spread by the content of its rows. Without hot keys this is a plain join.
    """
    if hot is None:
        return rows.join(index, key, how)
    others = [F.col(c) for c in rows.columns if c != key]
    content = F.pmod(F.xxhash64(*others), F.lit(salts)) if others else F.lit(0).cast("long")
    flagged = hot.withColumn("_hot", F.lit(True))
    left = rows.join(F.broadcast(flagged), key, "left").withColumn("_salt", F.when(F.col("_hot") | F.col(key).isNull(), content).otherwise(F.lit(0).cast("long"))).drop("_hot")
    right = index.join(F.broadcast(flagged), key, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.when(F.col("_hot"), F.lit(salts - 1)).otherwise(F.lit(0)).cast("long")))
    ).drop("_hot")
    return left.join(right, [key, "_salt"], how).drop("_salt")


def spread(df: DataFrame) -> DataFrame:
    """Rows over all cores if the input has fewer parts than there are cores.

    Only an input of less than one part per core is shuffled, so what moves is small at any cluster size;
    larger inputs stay where they are read.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
