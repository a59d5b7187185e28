from conceptloom.operators.merge import merge_upsert
from conceptloom.streaming.ingest import Generations, upsert_stream


def test_upsert_rules_and_idempotence(spark):
    schema = "id string, name string, definition string, aliases array<string>, conf double"
    old = spark.createDataFrame([("a", "A", "", ["x"], 0.5), ("b", "B", "kept", None, None), (None, "N", "n", [], 0.1)], schema)
    new = spark.createDataFrame([("a", "A2", "filled", ["y", "x"], 0.4), ("c", "C", "new", ["z"], 1.0), (None, "N2", "m", ["q"], 0.3)], schema)
    rules = {"name": "keep", "definition": "nonempty_old", "aliases": "append", "conf": "maximum"}
    once = merge_upsert(old, new, ["id"], rules)
    rows = {r["id"]: tuple(r)[1:] for r in once.collect()}
    assert rows == {"a": ("A", "filled", ["x", "y"], 0.5), "b": ("B", "kept", None, None), "c": ("C", "new", ["z"], 1.0), None: ("N", "n", ["q"], 0.3)}
    assert {r["id"]: tuple(r)[1:] for r in merge_upsert(once, new, ["id"], rules).collect()} == rows
    assert merge_upsert(old.limit(0), new.limit(0), ["id"], rules).count() == 0


def test_stream_of_files_is_merged_once(spark, tmp_path):
    schema = "k string, v long"
    spark.createDataFrame([("a", 1), ("b", 5)], schema).write.parquet(f"{tmp_path}/in")
    table = Generations(spark, f"{tmp_path}/table")

    def run():
        stream = spark.readStream.schema(schema).parquet(f"{tmp_path}/in")
        upsert_stream(stream, table, ["k"], {"v": "maximum"}, ["v"], f"{tmp_path}/checkpoint").awaitTermination()

    run()
    spark.createDataFrame([("a", 7)], schema).write.mode("append").parquet(f"{tmp_path}/in")
    run()
    run()
    assert {tuple(r) for r in table.read().collect()} == {("a", 7), ("b", 5)}
