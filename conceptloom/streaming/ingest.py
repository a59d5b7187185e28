"""Incremental work on streams: upserts by micro-batch, late events, limited rates, and the orphan ledger."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.merge import first_per_key, merge_upsert
from ..operators.orphans import Ledger


class Generations:
    """A table kept as one folder per generation; a reader always finds a whole one, a lost writer leaves none behind."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _hadoop(self):
        jvm = self.spark.sparkContext._jvm
        root = jvm.org.apache.hadoop.fs.Path(self.path)
        return root, root.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def last(self) -> int | None:
        """Number of the latest finished generation."""
        root, fs = self._hadoop()
        if not fs.exists(root):
            return None
        jvm = self.spark.sparkContext._jvm
        found = [int(s.getPath().getName()[4:]) for s in fs.listStatus(root) if s.getPath().getName().startswith("gen=") and fs.exists(jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS"))]
        return max(found, default=None)

    def read(self) -> DataFrame | None:
        n = self.last()
        return None if n is None else self.spark.read.parquet(f"{self.path}/gen={n}")

    def write(self, df: DataFrame, number: int) -> None:
        df.write.mode("overwrite").parquet(f"{self.path}/gen={number}")


def upsert_stream(stream: DataFrame, table: Generations, keys: list[str], rules: dict[str, str], order: list, checkpoint: str) -> StreamingQuery:
    """2.14, M1-M12: merge each micro-batch into a table of generations; a batch that is run again changes nothing.

    Within a batch the first row of each key in ``order`` counts.
    """

    def merge(batch: DataFrame, number: int) -> None:
        done = table.last()
        if done is not None and done >= number + 1:
            return
        incoming = first_per_key(batch, keys, order)
        current = table.read()
        table.write(incoming if current is None else merge_upsert(current, incoming.select(current.columns), keys, rules), number + 1)

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(stream: DataFrame, time: str = "ts", key: str = "event_type", width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """2.14: counts by time window and key; events later than ``late`` behind the newest are left out."""
    at = F.col(time).cast("timestamp")
    return stream.withColumn("_at", at).withWatermark("_at", late).groupBy(F.window("_at", width).alias("w"), key).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), key, "n")


def distinct_events(stream: DataFrame, key: str = "event_id", time: str = "ts", late: str = "2 hours") -> DataFrame:
    """Each event once, within the watermark."""
    return stream.withColumn("_at", F.col(time).cast("timestamp")).withWatermark("_at", late).dropDuplicatesWithinWatermark([key]).drop("_at")


def ledger_stream(changes: DataFrame, ledger: Ledger, checkpoint: str) -> StreamingQuery:
    """Problem 6 on a stream: each micro-batch is a period.

    changes: the columns of ``references``, null in rows of parents, and ``parent`` (a struct of ``pk``, ``created_at``, ``deleted_at``,
    ``loaded_at``), null in rows of references; a deletion is a parent row with ``deleted_at``. State is in the ledger's
    folder, so a restarted query goes on with it, and a batch that is run again is passed over.
    """

    def period(batch: DataFrame, number: int) -> None:
        parents = batch.where("parent IS NOT NULL").select("parent.*")
        refs = batch.where("parent IS NULL").select("ref_table", "ref_field", "row_id", "pk", "created_at", "loaded_at")
        ledger.period(refs, parents, str(number), number + 1)

    return changes.writeStream.foreachBatch(period).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
