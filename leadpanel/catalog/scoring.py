from pyspark.sql import functions as F

from leadpanel.catalog.registry import oracle, query
from leadpanel.catalog.tidy import tidy
from leadpanel.operators import aggs as A
from leadpanel.operators import metrics as E

c = F.col
G = ["model", "install_year"]
RANKED = """SELECT *, row_number() OVER (PARTITION BY model, install_year ORDER BY score DESC, id) AS pos,
  count(*) OVER (PARTITION BY model, install_year) AS n, sum(y) OVER (PARTITION BY model, install_year) AS p FROM scored"""


def _lift(label, share):
    k = f"greatest(1, CAST(floor(n * {share}) AS BIGINT))"
    hits = f"sum(CASE WHEN pos <= {k} THEN y ELSE 0 END)"
    return f"""round(CASE WHEN max(p) = 0 THEN 0 ELSE ({hits} / max({k})) / (max(p) / max(n)) END, 6) AS lift_{label},
  round(CASE WHEN max(p) = 0 THEN 0 ELSE {hits} / max(p) END, 6) AS capture_{label}"""


@query("e1_lift_and_capture", oracle("scored", "SELECT model, install_year, max(n) AS n, CAST(max(p) AS BIGINT) AS n_pos, " + ", ".join(
    _lift(k, s) for k, s in E.TOP_SHARES.items()) + " FROM ranked GROUP BY 1, 2", ranked=RANKED))
def e1(t):
    return tidy(E.lift_and_capture(t.scored, G))


DECILES = """SELECT r.model, r.install_year, d.d + 1 AS decile, count(*) AS n, sum(y) AS captured, max(p) AS p, max(r.n) AS total
FROM ranked r JOIN (SELECT unnest(range(10)) AS d) d ON r.pos - 1 >= floor(r.n * d.d / 10) AND r.pos - 1 < floor(r.n * (d.d + 1) / 10) WHERE p > 0 GROUP BY 1, 2, 3"""


@query("e2_decile_lift", oracle("scored", """
SELECT model, install_year, decile, round((captured / n) / (p / total), 6) AS lift, round(captured / n, 6) AS adoption_rate, n,
  CAST(captured AS BIGINT) AS captured, round(captured / p, 6) AS capture_pct FROM deciles""", ranked=RANKED, deciles=DECILES))
def e2(t):
    return tidy(E.decile_lift(t.scored, G))


@query("e3_threshold_metrics", oracle("scored", """
SELECT model, install_year, tp, fp, fn, tn, round((tp + tn) / (tp + fp + fn + tn), 6) AS accuracy, round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS precision,
  round(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS recall, round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1
FROM (SELECT model, install_year, count(*) FILTER (score >= 0.5 AND y = 1) AS tp, count(*) FILTER (score >= 0.5 AND y = 0) AS fp,
  count(*) FILTER (score < 0.5 AND y = 1) AS fn, count(*) FILTER (score < 0.5 AND y = 0) AS tn FROM scored GROUP BY 1, 2)"""))
def e3(t):
    return tidy(E.threshold_metrics(t.scored, G))


@query("e4_roc_auc", oracle("scored", """
SELECT a.model, a.install_year, round(sum(CASE WHEN a.score > b.score THEN 1.0e0 WHEN a.score = b.score THEN 0.5e0 ELSE 0 END) / count(*), 6) AS roc_auc
FROM scored a JOIN scored b ON a.model = b.model AND a.install_year = b.install_year WHERE a.y = 1 AND b.y = 0 GROUP BY 1, 2"""))
def e4(t):
    return tidy(E.roc_auc(t.scored, G).where(c("roc_auc").isNotNull()))


@query("e4_roc_points", oracle("scored", """
SELECT round(score, 6) AS threshold, round(neg / nullif(sum(neg) OVER (), 0), 6) AS fpr_step,
  round(sum(neg) OVER w / sum(neg) OVER (), 6) AS fpr, round(sum(pos) OVER w / sum(pos) OVER (), 6) AS tpr
FROM (SELECT score, sum(y) AS pos, sum(1 - y) AS neg FROM scored GROUP BY 1) WINDOW w AS (ORDER BY score DESC)""").replace(
    "round(neg / nullif(sum(neg) OVER (), 0), 6) AS fpr_step,", ""))
def e4p(t):
    return tidy(E.roc_points(t.scored))


@query("e5_average_precision", oracle("scored", """
SELECT model, round(sum(pos / total * cp / (cp + cn)), 6) AS average_precision FROM
 (SELECT *, sum(pos) OVER w AS cp, sum(neg) OVER w AS cn, sum(pos) OVER (PARTITION BY model) AS total
  FROM (SELECT model, score, sum(y) AS pos, sum(1 - y) AS neg FROM scored GROUP BY 1, 2) WINDOW w AS (PARTITION BY model ORDER BY score DESC)) GROUP BY 1"""))
def e5(t):
    return tidy(E.average_precision(t.scored, ["model"]))


@query("e6_brier", oracle("scored", """
SELECT model, round(b, 6) AS brier, round(r, 6) AS zero_baseline, round(r * (1 - r), 6) AS rate_baseline, round(1 - b / nullif(r * (1 - r), 0), 6) AS improvement
FROM (SELECT model, avg(pow(score - y, 2)) AS b, avg(y) AS r FROM scored GROUP BY 1)"""))
def e6(t):
    return tidy(E.brier(t.scored, ["model"]))


@query("w9_percentile_score", """
SELECT c_custkey, CAST(greatest(1, round_even((rank() OVER (ORDER BY b) + (count(*) OVER (PARTITION BY b) - 1) / 2.0e0) / count(*) OVER () * 100, 0)) AS BIGINT) AS model_score
FROM (SELECT c_custkey, floor(c_acctbal / 10) AS b FROM customer)""")
def w9(t):
    rows = t.customer.select("c_custkey", F.floor(c("c_acctbal") / 10).cast("double").alias("b"))
    return E.published_percentile(rows, "b").select("c_custkey", "model_score")


@query("w10_rank_fusion", oracle("scored", """
SELECT id, round(((rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0e0) / count(*) OVER ()
  + (rank() OVER (ORDER BY score_b) + (count(*) OVER (PARTITION BY score_b) - 1) / 2.0e0) / count(*) OVER ()) / 2, 6) AS fused FROM scored"""))
def w10(t):
    return tidy(E.rank_fusion(t.scored, ["score", "score_b"]).select("id", "fused"))


@query("w11_position_decile", """
SELECT o_orderkey, CASE WHEN s <= 0.05 THEN 0.5e0 WHEN s <= 0.1 THEN 1 WHEN s <= 0.2 THEN 2 WHEN s <= 0.3 THEN 3 WHEN s <= 0.4 THEN 4
  WHEN s <= 0.5 THEN 5 WHEN s <= 0.6 THEN 6 WHEN s <= 0.7 THEN 7 WHEN s <= 0.8 THEN 8 WHEN s <= 0.9 THEN 9 ELSE 10 END AS decile
FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) / CAST(count(*) OVER () AS DOUBLE) AS s FROM orders)""")
def w11(t):
    rows = t.orders.select(c("o_orderkey"), c("o_totalprice").alias("score"))
    return E.position_decile(rows, key="o_orderkey").select("o_orderkey", "decile")


@query("w12_quantile_decile", """
SELECT o_orderkey, CAST(len(e) + 1 - len(list_filter(e, lambda x: price > x)) AS BIGINT) AS decile FROM (SELECT o_orderkey, round(o_totalprice, -4) AS price FROM orders),
 (SELECT list_distinct(quantile_cont(round(o_totalprice, -4), [0.1e0, 0.2e0, 0.3e0, 0.4e0, 0.5e0, 0.6e0, 0.7e0, 0.8e0, 0.9e0])) AS e FROM orders)""")
def w12(t):
    rows = t.orders.select("o_orderkey", F.round("o_totalprice", -4).alias("score"))
    return E.quantile_decile(rows).select("o_orderkey", "decile")


@query("m11_mean_ensemble", oracle("scored", "SELECT id, round((score + score_b) / 2, 6) AS blend FROM scored"))
def m11a(t):
    return tidy(E.mean_ensemble(t.scored, ["score", "score_b"], "blend").select("id", "blend"))


@query("m11_weight_search", oracle("scored", """
SELECT w, round(sum(l), 6) AS total_lift FROM (SELECT w, s, (sum(CASE WHEN pos <= greatest(1, floor(n * s)) THEN y ELSE 0 END) / max(greatest(1, floor(n * s)))) / (sum(y) / max(n)) AS l
  FROM (SELECT *, row_number() OVER (PARTITION BY w ORDER BY blend DESC, id) AS pos, count(*) OVER (PARTITION BY w) AS n
    FROM (SELECT id, y, w, round(w / 10.0e0 * score + (1 - w / 10.0e0) * score_b, 9) AS blend FROM scored, (SELECT unnest(range(11)) AS w)))
  , (SELECT unnest([0.02, 0.05, 0.1]) AS s) GROUP BY 1, 2) GROUP BY 1"""))
def m11b(t):
    return tidy(E.lift_by_weights(t.scored, ["score", "score_b"], E.simplex_weights(2)))


ALL_DECILES = """SELECT install_year, decile, captured, n, captured / p AS capture_pct FROM deciles"""


@query("a8_decile_summary", oracle("scored", """
SELECT decile, CAST(sum(captured) AS BIGINT) AS installs, CAST(sum(n) AS BIGINT) AS homes, round(sum(captured) / sum(n), 6) AS rate,
  round(avg(captured / p), 6) AS mean_capture, round(100.0e0 * sum(captured) / (SELECT sum(captured) FROM deciles), 6) AS share_pct FROM deciles GROUP BY 1""",
    ranked=RANKED, deciles=DECILES))
def a8(t):
    return tidy(A.decile_summary(E.decile_lift(t.scored, G)))


@query("a9_decile_pivot", oracle("scored", "SELECT install_year, " + ", ".join(
    f'CAST(coalesce(sum(captured) FILTER (decile = {d}), 0) AS BIGINT) AS "{d}"' for d in range(1, 11)) + " FROM deciles GROUP BY 1",
    ranked=RANKED, deciles=DECILES))
def a9(t):
    return tidy(A.decile_pivot(E.decile_lift(t.scored, G)))


TIERS = {"top 5 %": "5pct", "top 10 %": "10pct", "top 20 %": "20pct"}
LIFTS = "SELECT model, install_year, max(p) / max(n) AS baseline, " + ", ".join(_lift(k, s) for k, s in E.TOP_SHARES.items()) + " FROM ranked GROUP BY 1, 2"


@query("a10_contacts_per_adopter", oracle("scored", """
SELECT tier, round(avg(1 / baseline), 4) AS contacts_random, round(avg(1 / (baseline * nullif(lift, 0))), 4) AS contacts_ranked,
  round(100 * (1 - avg(1 / (baseline * nullif(lift, 0))) / avg(1 / baseline)), 4) AS reduction_pct FROM (""" + " UNION ALL ".join(
    f"SELECT '{name}' AS tier, baseline, lift_{k} AS lift FROM lifts" for name, k in TIERS.items()) + ") WHERE baseline > 0 GROUP BY 1",
    ranked=RANKED, lifts=LIFTS.replace("round(", "(").replace(", 6) AS", ") AS")))
def a10(t):
    lifts = E.lift_and_capture(t.scored, G).withColumn("baseline", c("n_pos") / c("n"))
    tiers = lifts.select("baseline", F.explode(F.array(*[
        F.struct(F.lit(name).alias("tier"), c(f"lift_{k}").alias("lift")) for name, k in TIERS.items()])).alias("s"))
    return tidy(A.contacts_per_adopter(tiers.where(c("baseline") > 0).select("baseline", "s.*")), 4)


@query("a11_metric_summary", oracle("scored", """
SELECT model, round(avg(lift_10pct), 4) AS lift_10pct_mean, round(stddev_samp(lift_10pct), 4) AS lift_10pct_std,
  round(avg(capture_20pct), 4) AS capture_20pct_mean, round(stddev_samp(capture_20pct), 4) AS capture_20pct_std FROM lifts GROUP BY 1""",
    ranked=RANKED, lifts=LIFTS.replace("round(", "(").replace(", 6) AS", ") AS")))
def a11(t):
    return tidy(A.metric_summary(E.lift_and_capture(t.scored, G), ["lift_10pct", "capture_20pct"]), 4)


IMPORTANCE = """SELECT CAST(year(l_shipdate) AS BIGINT) AS year, l_suppkey AS feature, sum(l_quantity) / 1000.0e0 AS importance FROM lineitem GROUP BY 1, 2"""


@query("a12_importance_stability", oracle("", """
SELECT year, year + 1 AS next, round(corr(coalesce(a, 0), coalesce(b, 0)), 6) AS correlation FROM
 (SELECT coalesce(x.year, y.year - 1) AS year, x.importance AS a, y.importance AS b FROM imp x FULL JOIN imp y ON y.year = x.year + 1 AND y.feature = x.feature)
WHERE year >= (SELECT min(year) FROM imp) AND year < (SELECT max(year) FROM imp) GROUP BY 1""", imp=IMPORTANCE))
def a12(t):
    year = F.year("l_shipdate")
    importance = t.lineitem.groupBy(
        year.cast("bigint").alias("year"), c("l_suppkey").alias("feature")).agg((F.sum("l_quantity") / 1000).alias("importance"))
    return tidy(A.importance_stability(importance))
