"""Problem 6: references to records that are missing, deleted or came later.

A ledger is kept incrementally. Each period brings new references and new rows of parents. New references
probe the parent index. Parents that arrive or change resolve or reopen the references that name them, and only
those: references are kept in buckets by key, and only the buckets of changed parents are read again. Open orphans stay
pending by key; after each period their counts are a snapshot. All state is in the ledger's folder, one generation a
period, so a ledger goes on after a restart and a period that is run again changes nothing.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import HOT_ROWS, cut, hot_keys, salted_lookup, scratch_path


def references(df: DataFrame, ref_table: str, id_col: str, fields: dict[str, str]) -> DataFrame:
    """``ref_table``, ``ref_field``, ``row_id``, ``pk`` (parent kind and key), ``created_at``, ``loaded_at`` of non-null references.

    fields: parent kind of each column that refers.
    """
    each = F.array(*(F.struct(F.lit(c).alias("ref_field"), F.concat(F.lit(f"{kind}:"), F.col(c)).alias("pk")) for c, kind in fields.items()))
    wide = df.select(F.lit(ref_table).alias("ref_table"), F.col(id_col).alias("row_id"), "created_at", "loaded_at", F.explode(each).alias("r"))
    return wide.where("r.pk IS NOT NULL").select("ref_table", "r.ref_field", "row_id", "r.pk", "created_at", "loaded_at")


def parents(df: DataFrame, kind: str, key: str) -> DataFrame:
    """``pk``, ``created_at``, ``deleted_at``, ``loaded_at`` of rows that have a key."""
    return df.where(F.col(key).isNotNull()).select(F.concat(F.lit(f"{kind}:"), F.col(key)).alias("pk"), "created_at", "deleted_at", "loaded_at")


def _index(rows: DataFrame) -> DataFrame:
    """One row per key: earliest creation and present state. Of rows loaded at one time, a deleted one counts."""
    now = F.struct(F.col("loaded_at"), F.col("deleted_at"))
    return rows.groupBy("pk").agg(F.min("created_at").alias("first_created"), F.max(now).alias("now"))


def _merge_index(old: DataFrame | None, new: DataFrame) -> DataFrame:
    if old is None:
        return new
    return old.union(new).groupBy("pk").agg(F.min("first_created").alias("first_created"), F.max("now").alias("now"))


def _cause() -> Column:
    """Why a reference joined with its parent's state fails; null if it holds."""
    return (
        F.when(F.col("now").isNull(), "missing")
        .when(F.col("now.deleted_at").isNotNull(), "deleted")
        .when(F.col("first_created") > F.col("created_at"), "late")
    )


_OPEN = ["ref_table", "ref_field", "row_id", "pk", "created_at", "cause"]


class Ledger:
    """State between periods, in a folder that all executors share: the parent index, the references so far by bucket of their
    key, the pending orphans, and snapshots. A generation counts once its pending orphans are written, which comes last."""

    def __init__(self, spark: SparkSession, path: str | None = None, hot_rows: int = HOT_ROWS, buckets: int = 64):
        self.spark, self.path, self.hot_rows, self.buckets = spark, (path or scratch_path(spark, "ledger")).rstrip("/"), hot_rows, buckets

    def _folder(self, name: str):
        jvm = self.spark.sparkContext._jvm
        folder = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return folder, folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def done(self) -> int:
        """Number of the last finished period; 0 if there is none."""
        folder, fs = self._folder("pending")
        if not fs.exists(folder):
            return 0
        names = [s.getPath().getName() for s in fs.listStatus(folder)]
        return max((n for n in (int(x[4:]) for x in names if x.startswith("gen=")) if fs.exists(self._folder(f"pending/gen={n}/_SUCCESS")[0])), default=0)

    def _write(self, df: DataFrame, name: str, number: int, *by: str) -> DataFrame:
        path = f"{self.path}/{name}/gen={number}"
        df.write.mode("overwrite").partitionBy(*by).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def _read(self, name: str, number: int) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{name}/gen={number}")

    @property
    def pending(self) -> DataFrame:
        """Orphans that are open after the last finished period."""
        return self._read("pending", self.done())

    @property
    def snapshots(self) -> list[DataFrame]:
        """Counts after each period."""
        return [self._read("counts", n) for n in range(1, self.done() + 1)]

    def _judged(self, refs: DataFrame, index: DataFrame, how: str) -> DataFrame:
        hot = hot_keys(cut(refs.groupBy("pk").agg(F.count(F.lit(1)).alias("n"))), "pk", "n", self.hot_rows)
        found = salted_lookup(refs, index, "pk", hot, how)
        return found.withColumn("cause", _cause()).where("cause IS NOT NULL").select(_OPEN)

    def period(self, refs: DataFrame, parent_rows: DataFrame, name: str, number: int | None = None) -> None:
        """Take in one period's references (columns of ``references``) and parent rows (columns of ``parents``).

        number: 1 for the first period and so on, the next one by default; a finished period is not taken in again.
        """
        last = self.done()
        number = last + 1 if number is None else number
        if number <= last:
            return
        if number > last + 1:
            raise ValueError(f"period {number} comes before {last + 1} is finished")
        arrived = cut(_index(parent_rows))
        index = self._write(_merge_index(self._read("index", last) if last else None, arrived), "index", number)
        bucket = F.pmod(F.xxhash64("pk"), F.lit(self.buckets)).cast("int")
        columns = ["ref_table", "ref_field", "row_id", "pk", "created_at"]
        refs = self._write(refs.select(columns).distinct().withColumn("bucket", bucket), "refs", number, "bucket").select(columns)
        open_now = [self._judged(refs, index, "left")]
        if last:
            pending = self._read("pending", last)
            changed = cut(index.join(arrived.select("pk"), "pk", "left_semi"))
            touched = [r[0] for r in changed.select(bucket.alias("bucket")).distinct().collect()]
            if touched:
                # Only references that name a changed parent are looked at again; all other orphans stay as they are.
                known = self.spark.read.option("basePath", f"{self.path}/refs").parquet(*(f"{self.path}/refs/gen={n}" for n in range(1, number))) if self._any(last) else None
                if known is not None:
                    open_now.append(self._judged(known.where(F.col("bucket").isin(touched)).select(columns), changed, "inner"))
                pending = pending.join(changed.select("pk"), "pk", "left_anti")
            open_now.append(pending)
        pending = cut(reduce(DataFrame.union, [o.select(_OPEN) for o in open_now]))
        self._write(counts(pending).withColumn("period", F.lit(name)), "counts", number)
        self._write(pending, "pending", number)
        for name in ("index", "pending"):  # generations before the last two are no longer needed
            folder, fs = self._folder(f"{name}/gen={number - 2}")
            fs.delete(folder, True)

    def _any(self, last: int) -> bool:
        """Whether any reference is kept: folders without rows have no buckets."""
        return any(s.getPath().getName().startswith("bucket=") for n in range(1, last + 1) for folder, fs in [self._folder(f"refs/gen={n}")] if fs.exists(folder) for s in fs.listStatus(folder))


def month(column: str):
    """A time's month as yyyy-MM, or 'unknown'."""
    return F.coalesce(F.date_format(column, "yyyy-MM"), F.lit("unknown"))


def counts(pending: DataFrame) -> DataFrame:
    """Orphans by table, field, cause and month."""
    return pending.groupBy("ref_table", "ref_field", "cause", month("created_at").alias("ref_month")).agg(F.countDistinct("row_id", "pk").alias("orphans"))


def replay(refs: DataFrame, parent_rows: DataFrame, periods: int = 3, hot_rows: int = HOT_ROWS) -> Ledger:
    """A ledger fed with all rows in the order of ``loaded_at``, in ``periods`` spans of equal length.

    Rows whose ``loaded_at`` is null come with the last span. Null references are no references; repeated rows
    count once; empty tables give an empty ledger.
    """
    spans = [t.agg(F.min(F.unix_micros(F.col("loaded_at").cast("timestamp"))), F.max(F.unix_micros(F.col("loaded_at").cast("timestamp")))).first() for t in (refs, parent_rows)]
    known = [v for s in spans for v in s if v is not None]
    low, high = (min(known), max(known)) if known else (0, 0)
    ends = [low + (high - low) * (k + 1) // periods for k in range(periods - 1)]
    at = F.coalesce(F.unix_micros(F.col("loaded_at").cast("timestamp")), F.lit(high))
    ledger = Ledger(refs.sparkSession, hot_rows=hot_rows, buckets=8)
    for k in range(periods):
        span = (at > ends[k - 1] if k else F.lit(True)) & (at <= ends[k] if k < periods - 1 else F.lit(True))
        ledger.period(refs.where(span), parent_rows.where(span), f"{k + 1} of {periods}")
    return ledger


def found(ledger: Ledger) -> DataFrame:
    """Distinct ``ref_table``, ``ref_field``, ``row_id``, ``cause``, ``ref_month`` of all pending orphans."""
    return ledger.pending.select("ref_table", "ref_field", "row_id", "cause", month("created_at").alias("ref_month")).distinct()
