"""Streams over several files and triggers give what the batch gives."""

from pyspark.sql import functions as F

from leadpanel.operators.permits import classify, explode_types
from leadpanel.streaming import jobs as J


def feed(spark, path):
    rows = [("h1", "p1", "re-roof", "old", 100.0, 1), ("h1", "p2", "other", "Solar PV array and battery", 9000.0, 1),
            ("h2", "p3", "other", None, None, 1), ("h1", "p1", "re-roof", "new", 200.0, 2), ("h1", "p1", "re-roof", "late", 50.0, 0)]
    schema = "strap string, permit_num string, permit_category string, description string, estimated_value double, version int"
    for i, row in enumerate(rows):
        spark.createDataFrame([row], schema).coalesce(1).write.parquet(f"{path}/in/f{i}")
    return spark.read.schema(schema).parquet(f"{path}/in/*"), schema


def test_permit_feed(spark, tmp_path):
    batch, schema = feed(spark, str(tmp_path))
    stream = J.file_stream(spark, f"{tmp_path}/in/*", batch.schema, files_per_trigger=1)
    J.permit_feed(stream, "version", f"{tmp_path}/out", f"{tmp_path}/state")
    got = J.read_upserts(spark, f"{tmp_path}/out", ["strap", "permit_num", "permit_type"], "version")
    keys = sorted((r["strap"], r["permit_num"], r["permit_type"]) for r in got.collect())
    want = sorted({(r["strap"], r["permit_num"], r["permit_type"]) for r in explode_types(classify(batch)).collect()})
    assert keys == want
    # Nothing is left to read: a second run with the same state changes nothing.
    J.permit_feed(J.file_stream(spark, f"{tmp_path}/in/*", batch.schema), "version", f"{tmp_path}/out", f"{tmp_path}/state")
    again = J.read_upserts(spark, f"{tmp_path}/out", ["strap", "permit_num", "permit_type"], "version")
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, got.collect()))


def test_rolling_counts_equal_batch(spark, tmp_path):
    events = spark.range(200).select(
        (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(hours=F.col("id") % 240)).alias("ts"),
        F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("kind"))
    events.repartition(4).write.parquet(f"{tmp_path}/ev")
    stream = J.file_stream(spark, f"{tmp_path}/ev", events.schema)
    counts = J.rolling_counts(stream, "ts", "kind", 7, 1, 30)
    J.run_available(counts.writeStream.outputMode("complete").format("memory").queryName("rolling").option(
        "checkpointLocation", f"{tmp_path}/st"))
    got = spark.table("rolling")
    want = J.rolling_counts(spark.read.parquet(f"{tmp_path}/ev"), "ts", "kind", 7, 1, 30)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_first_event_updates(spark, tmp_path):
    rows = [("u", "2024-01-05", "buy"), ("u", "2024-01-03", "buy"), ("v", "2024-01-01", "view"), ("w", "2024-01-09", "buy")]
    for i, row in enumerate(rows):
        spark.createDataFrame([row], "user string, ts string, kind string").coalesce(1).write.parquet(f"{tmp_path}/in/f{i}")
    schema = spark.read.parquet(f"{tmp_path}/in/f0").schema
    stream = J.file_stream(spark, f"{tmp_path}/in/*", schema, files_per_trigger=1)
    J.write_updates(J.first_event(stream, "user", F.col("kind") == "buy", "ts"), ["user"], f"{tmp_path}/out", f"{tmp_path}/state")
    got = {r["user"]: r["first_at"] for r in J.read_updates(spark, f"{tmp_path}/out", ["user"]).collect()}
    assert got == {"u": "2024-01-03", "w": "2024-01-09"}


def test_compaction_changes_nothing(spark, tmp_path):
    batch, _ = feed(spark, str(tmp_path))
    keys, out = ["strap", "permit_num", "permit_type"], f"{tmp_path}/out"
    stream = lambda: J.file_stream(spark, f"{tmp_path}/in/*", batch.schema, files_per_trigger=1)
    J.permit_feed(stream(), "version", out, f"{tmp_path}/state")
    before = sorted(map(tuple, J.read_upserts(spark, out, keys, "version").collect()), key=repr)
    last = J.compact(spark, out, keys, ["version"])
    assert last == 4
    assert sorted(map(tuple, J.read_upserts(spark, out, keys, "version").collect()), key=repr) == before
    spark.createDataFrame([("h9", "p9", "re-roof", "fresh", 1.0, 1), ("h1", "p1", "re-roof", "again", 1.0, 9)],
                          batch.schema).coalesce(1).write.parquet(f"{tmp_path}/in/f9")
    J.permit_feed(stream(), "version", out, f"{tmp_path}/state")
    after = {r["permit_num"]: r["description"] for r in J.read_upserts(spark, out, keys, "version").collect()}
    assert after["p9"] == "fresh" and after["p1"] == "again" and len(after) == 4
    plan = J.read_upserts(spark, out, keys, "version")._jdf.queryExecution().toString()
    assert "batch_id" in plan and J.compact(spark, out, keys, ["version"]) == 5


def test_rows_later_than_the_watermark_are_left_out(spark, tmp_path):
    """A row that arrives after its window was closed does not come back."""
    schema = "ts timestamp_ntz, kind string"
    for i, day in enumerate(["2024-03-01", "2024-03-20", "2024-01-01", "2024-03-21"]):
        spark.createDataFrame([(day, "a")], "ts string, kind string").select(F.col("ts").cast("timestamp_ntz"), "kind").coalesce(1).write.parquet(
            f"{tmp_path}/in/f{i}")
    stream = J.file_stream(spark, f"{tmp_path}/in/*", schema, files_per_trigger=1)
    counts = J.rolling_counts(stream, "ts", "kind", 1, 1, 3)
    J.write_updates(counts, ["start", "kind"], f"{tmp_path}/out", f"{tmp_path}/state")
    days = sorted(str(r["start"])[:10] for r in J.read_updates(spark, f"{tmp_path}/out", ["start", "kind"]).collect())
    assert days == ["2024-03-01", "2024-03-20", "2024-03-21"]
