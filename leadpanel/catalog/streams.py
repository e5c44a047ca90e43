from pyspark.sql import functions as F

from leadpanel.catalog.registry import oracle, query
from leadpanel.catalog.sql_parts import EXPLODED, FLAGGED, TYPED
from leadpanel.catalog.tables import scratch
from leadpanel.catalog.tidy import tidy
from leadpanel.sources.views import VIEWS
from leadpanel.streaming import jobs as J
from leadpanel.streaming import resume as R

c = F.col


def stream_of(t, table):
    return J.file_stream(t.spark, t.folder, getattr(t, table).schema, pattern=f"{table}.parquet")


def permit_stream(t):
    """The permits view over a stream of orders."""
    text, _ = VIEWS["permits"]
    return t.spark.sql(text, orders=stream_of(t, "orders"))


@query("r1_resume_stream", oracle("homes home_scores", """
SELECT strap, CASE WHEN strap IN (SELECT home_index FROM home_scores) THEN 'failed' ELSE 'new' END AS reason
FROM homes WHERE strap NOT IN (SELECT home_index FROM home_scores WHERE model_score IS NOT NULL)"""))
def r1_stream(t):
    """The results so far and the wanted homes arrive as streams; what is done is not asked for again."""
    customers, nations = stream_of(t, "customer"), t.nation
    scores = t.spark.sql(VIEWS["home_scores"][0], customer=customers)
    homes = t.spark.sql(VIEWS["homes"][0], customer=customers, nation=nations)
    events = homes.select(c("strap").alias("key"), F.lit(None).cast("boolean").alias("ok")).unionByName(
        scores.select(c("home_index").alias("key"), c("model_score").isNotNull().alias("ok")))
    path, checkpoint = scratch(t.spark, "tries"), scratch(t.spark, "tries-state")
    R.resume_available(events, "key", "ok", path, checkpoint)
    return J.read_appends(t.spark, path).select(c("key").alias("strap"), "reason")


@query("r4_permit_feed", oracle("permits", """
SELECT strap, permit_num, permit_type, round(estimated_value, 6) AS estimated_value FROM exploded
QUALIFY row_number() OVER (PARTITION BY strap, permit_num, permit_type ORDER BY issue_date DESC) = 1""",
    flagged=FLAGGED, typed=TYPED, exploded=EXPLODED))
def r4(t):
    path, checkpoint = scratch(t.spark, "feed"), scratch(t.spark, "feed-state")
    J.permit_feed(permit_stream(t), "issue_date", path, checkpoint, t.spark.sparkContext.defaultParallelism)
    table = J.read_upserts(t.spark, path, ["strap", "permit_num", "permit_type"], "issue_date")
    return tidy(table.select("strap", "permit_num", "permit_type", "estimated_value"))


@query("r5_rolling_counts", """
SELECT strftime(CAST(d AS TIMESTAMP), '%Y-%m-%d') AS start_day, event_type, count(*) AS n
FROM (SELECT event_type, unnest(generate_series(CAST(ts AS DATE) - 6, CAST(ts AS DATE), INTERVAL 1 DAY)) AS d FROM events) GROUP BY 1, 2""")
def r5(t):
    counts = J.rolling_counts(stream_of(t, "events"), "ts", "event_type", 7, 1, 1)
    path, checkpoint = scratch(t.spark, "windows"), scratch(t.spark, "windows-state")
    J.write_updates(counts, ["start", "event_type"], path, checkpoint)
    table = J.read_updates(t.spark, path, ["start", "event_type"])
    # Windows are aligned to the epoch in UTC.
    day = F.date_format(F.to_utc_timestamp("start", F.current_timezone()), "yyyy-MM-dd")
    return tidy(table.select(day.alias("start_day"), "event_type", "n"))


@query("r6_first_adoption_state", """
SELECT user_id, epoch_us(min(ts)) AS first_at FROM events WHERE event_type = 'purchase' GROUP BY 1""")
def r6(t):
    first = J.first_event(stream_of(t, "events"), "user_id", c("event_type") == "purchase", "ts")
    path, checkpoint = scratch(t.spark, "first"), scratch(t.spark, "first-state")
    J.write_updates(first, ["user_id"], path, checkpoint)
    table = J.read_updates(t.spark, path, ["user_id"])
    return table.select("user_id", F.unix_micros(F.from_utc_timestamp(c("first_at").cast("timestamp"), F.current_timezone())).alias("first_at"))
