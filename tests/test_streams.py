from conceptloom.operators.aliases import stated_aliases
from conceptloom.streaming.ingest import distinct_events


def test_each_event_once_within_the_watermark(spark, tmp_path):
    schema = "event_id long, ts timestamp"
    rows = spark.createDataFrame([(1, "2024-01-01 00:00:00"), (1, "2024-01-01 00:30:00"), (2, "2024-01-01 01:00:00"), (None, "2024-01-01 01:00:00")], "event_id long, ts string")
    rows.selectExpr("event_id", "CAST(ts AS timestamp) AS ts").coalesce(1).write.parquet(f"{tmp_path}/in")
    query = distinct_events(spark.readStream.schema(schema).parquet(f"{tmp_path}/in")).writeStream.format("memory").queryName("events_once").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start()
    query.awaitTermination()
    assert sorted((r["event_id"] or 0) for r in spark.table("events_once").collect()) == [0, 1, 2]


def test_aliases_that_texts_state(spark):
    texts = spark.createDataFrame([(1, "The Translation Lookaside Buffer (TLB) is fast."), (2, "Swap Daemon, also known as Pager Daemon."), (3, None), (4, "Unknown Thing (UT)")], "id long, text string")
    names = spark.createDataFrame([("Translation Lookaside Buffer", True), ("TLB", False), ("swap daemon", False), ("Pager Daemon", True)], "name string, core boolean")
    got = {tuple(r) for r in stated_aliases(texts, "id", "text", names).collect()}
    assert ("Pager Daemon", "swap daemon", 2) in got and len(got) <= 2
