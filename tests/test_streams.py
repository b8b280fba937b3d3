import pandas as pd
from pyspark.sql import functions as F

from siltworks.plans.health import aimd
from siltworks.sources.sinks import Snapshots
from siltworks.streaming import jobs


def test_deduplicated_and_idempotent(spark, tmp_path):
    rows = spark.range(100).select((F.col("id") % 30).cast("string").alias("sha256"), F.col("id").alias("n"))
    rows.repartition(4).write.parquet(f"{tmp_path}/in")
    table = Snapshots(spark, f"file://{tmp_path}/t")
    for checkpoint in ("c1", "c2"):  # a second run reads all again
        stream = jobs.deduplicated(jobs.source(spark, f"{tmp_path}/in", rows.schema, files_per_batch=2), ["sha256"])
        jobs.flush(stream, jobs.idempotent(table, "sha256", ["n"]), f"{tmp_path}/{checkpoint}", None).awaitTermination()
    assert table.read().count() == 30


def test_annotator_skips_what_is_done(spark, tmp_path):
    rows = spark.range(10).select(F.col("id").cast("string").alias("sha256"))
    rows.write.parquet(f"{tmp_path}/in")
    mark = lambda df: df.select("sha256", (F.col("sha256").cast("int") % 2 == 0).alias("ok"))
    write = jobs.annotator(mark, f"{tmp_path}/log")
    for checkpoint in ("c1", "c2"):
        jobs.flush(jobs.source(spark, f"{tmp_path}/in", rows.schema), write, f"{tmp_path}/{checkpoint}", None).awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/log").count() == 15


def test_queue_rules():
    step, start = jobs.WorkQueue.step, ("pending", 0, 0.0, 0.0)
    now = step(start, "claim", None, 10.0)
    assert now == ("claimed", 0, 0.0, 10.0)
    assert step(now, "result", True, 11.0)[:2] == ("done", 1)
    now = step(now, "result", False, 11.0)
    assert now[:3] == ("pending", 1, 16.0)  # five seconds, then ten
    assert step(now, "claim", None, 15.5)[0] == "pending"  # waits
    now = step(step(now, "claim", None, 16.0), "result", False, 17.0)
    assert now[:3] == ("pending", 2, 27.0)
    now = step(step(now, "claim", None, 27.0), "result", False, 28.0)
    assert now[:2] == ("skipped", 3)
    assert step(("claimed", 1, 0.0, 0.0), "claim", None, 700.0)[0] == "claimed"  # taken back, claimed anew


def test_stateful_streams(spark, tmp_path):
    jobs.use_rocksdb(spark)
    spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")  # else timers keep the query running
    try:
        events = pd.DataFrame({"key": list("aabbbbbb"), "kind": ["claim", "result"] * 4, "ok": [None, True] + [None, False] * 3, "at": [1.0, 2.0, 1.0, 2.0, 10.0, 11.0, 30.0, 31.0]})
        df = spark.createDataFrame(events, "key string, kind string, ok boolean, at double")
        df.coalesce(1).write.parquet(f"{tmp_path}/q")
        out = jobs.stateful(jobs.source(spark, f"{tmp_path}/q", df.schema), "key", jobs.WorkQueue())
        out.writeStream.format("memory").queryName("queue_out").outputMode("update").option("checkpointLocation", f"{tmp_path}/cq").trigger(availableNow=True).start().awaitTermination()
        assert {(r["key"], r["status"], r["attempts"]) for r in spark.table("queue_out").collect()} == {("a", "done", 1), ("b", "skipped", 3)}

        caps = spark.range(200).select((F.col("id") % 3).cast("string").alias("source"), (F.col("id") % 7 != 0).alias("ok"), F.lit(True).alias("congested"), F.col("id").alias("seq"))
        caps.coalesce(1).write.parquet(f"{tmp_path}/a")
        out = jobs.stateful(jobs.source(spark, f"{tmp_path}/a", caps.schema), "source", jobs.SourceCap())
        out.writeStream.format("memory").queryName("cap_out").outputMode("update").option("checkpointLocation", f"{tmp_path}/ca").trigger(availableNow=True).start().awaitTermination()
        want = {tuple(r) for r in aimd(caps, ["source"], ["seq"], F.col("ok")).collect()}
        assert {tuple(r) for r in spark.table("cap_out").collect()} == want
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
        spark.conf.unset("spark.sql.streaming.noDataMicroBatches.enabled")


def test_windowed_counts(spark, sf, tmp_path):
    df = spark.read.parquet(f"{sf}/events.parquet")
    out = jobs.windowed_counts(jobs.source(spark, f"{sf}/events*.parquet", df.schema), "ts", "event_type")
    out.writeStream.format("memory").queryName("windows_out").outputMode("complete").option("checkpointLocation", f"{tmp_path}/w").trigger(availableNow=True).start().awaitTermination()
    assert spark.table("windows_out").agg(F.sum("n")).first()[0] == df.count()


def test_missing_work(spark):
    entities = spark.createDataFrame([("a", "c"), ("b", "c"), ("d", "c")], "name string, cluster string")
    counts = spark.createDataFrame([("a", 9)], "name string, have long")
    queue = spark.createDataFrame([("b", "pending"), ("d", "done")], "instance string, status string")
    assert [(r["name"], r["wave"]) for r in jobs.missing_work(entities, counts, queue, 4, 2).collect()] == [("d", 2)]


def test_waves_refill_and_climb():
    made, left = [], [3]

    def generate(n):
        made.append(n)
        return 0 if n == 4 else 5

    def drained():
        left[0] -= 1
        return left[0] <= 0

    assert jobs.waves(generate, drained, lambda: None) == 4 and made == [1, 2, 3, 4]
    work = iter([2, 0, 0, 5, *[0] * 6, 9])
    assert jobs.refill(lambda: next(work), lambda: None) == 7
    climb = jobs.Climb(8, 4, 2, 16)
    assert [climb.window(x) for x in (1.0, 2.0, 1.5, 3.0, 4.0, 5.0, 1.0)] == [12, 16, 12, 8, 4, 2, 6]
