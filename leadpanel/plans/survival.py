"""Time to adoption: duration tables, curves, hazard models."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from leadpanel.operators.ranking import add_position, add_running_sums, median_scalars
from leadpanel.operators.sampling import split_by_group
from leadpanel.plans import models as M
from leadpanel.session import pin

c = F.col


def durations(panel: DataFrame, flag: str = "adopted") -> DataFrame:
    """Per home: years from entry to the first event (or the last year seen), at least one, and the event mark."""
    per = panel.groupBy("strap").agg(
        F.min("year").alias("entry"), F.max("year").alias("last"),
        F.min(F.when(c(flag) == 1, c("year"))).alias("event_year"))
    return per.select(
        "strap", "event_year", F.greatest(F.lit(1), F.coalesce("event_year", "last") - c("entry")).cast("bigint").alias("duration"),
        c("event_year").isNotNull().cast("int").alias("event"))


def person_periods(panel: DataFrame, times: DataFrame) -> DataFrame:
    """Home-years up to and including the event, with the hazard mark and years at risk."""
    joined = panel.join(times.select("strap", c("event_year").alias("_e")), "strap")
    return joined.where(c("_e").isNull() | (c("year") <= c("_e"))).withColumn(
        "hazard", F.coalesce((c("year") == c("_e")).cast("int"), F.lit(0))).drop("_e")


def split_at_median(times: DataFrame, risk: str) -> DataFrame:
    middle = median_scalars(times, [risk])[risk]
    return times.withColumn("risk_group", F.when(c(risk) >= middle, "high").otherwise("low"))


def kaplan_meier(times: DataFrame, group: str) -> DataFrame:
    """Survival after each duration per group. Durations are few, so the curve is worked out on counts."""
    counts = times.groupBy(group, "duration").agg(F.count(F.lit(1)).alias("n"), F.sum("event").alias("events"))
    risk = add_running_sums(counts, [c("duration").desc()], ["n"], [group]).withColumnRenamed("cum_n", "at_risk")
    # log of a zero survival step is replaced by a mark that zeroes the rest of the curve
    step = risk.withColumns({
        "_log": F.when(c("events") < c("at_risk"), F.log(1 - c("events") / c("at_risk"))).otherwise(0.0),
        "_end": (c("events") >= c("at_risk")).cast("int"),
    })
    curve = add_running_sums(step, [c("duration").asc()], ["_log", "_end"], [group])
    return curve.select(
        group, "duration", "at_risk", "events",
        F.when(c("cum__end") > 0, 0.0).otherwise(F.exp("cum__log")).alias("survival"))


def concordance(times: DataFrame, risk: str) -> DataFrame:
    """Share of comparable pairs ordered right: the higher risk has its event first; equal risks count half.

    A pair is comparable when one home has its event while the other is still at risk. Times are numbered,
    with the events of a time before what is still open then, and a pair is counted at the highest bit in
    which its numbers differ: there the event stands on the side of the zeros. So a row counts once per bit
    of the number of times, risks may take any number of values, and no pair is formed.
    """
    per = times.where(c(risk).isNotNull()).groupBy("duration", "event", risk).agg(F.count(F.lit(1)).alias("n"))
    per = pin(per)
    order = pin(add_position(per.select("duration").distinct(), [c("duration")], position="_at", total="_all"))
    most = order.agg(F.max("_at")).first()[0]
    if most is None:
        return times.agg(F.lit(None).cast("double").alias("c_index"))
    bits = (2 * most + 1).bit_length()
    numbered = per.join(order.select("duration", "_at"), "duration").select(
        risk, "n", "event", (2 * c("_at") + F.when(c("event") == 1, 0).otherwise(1)).alias("_r"))
    side = lambda b: F.shiftright("_r", b).bitwiseAND(F.lit(1))
    at = F.explode(F.array(*[F.struct(
        F.lit(b).alias("bit"), F.shiftright("_r", b + 1).alias("above"), side(b).alias("later")) for b in range(bits)]))
    # Events on the zeros' side meet all that lies on the ones' side below the same higher bits.
    marks = numbered.select(risk, "n", "event", at.alias("_s")).select(risk, "n", "event", "_s.*").groupBy("bit", "above", risk).agg(
        F.sum(F.when((c("later") == 0) & (c("event") == 1), c("n")).otherwise(0)).alias("ev"),
        F.sum(F.when(c("later") == 1, c("n")).otherwise(0)).alias("op"))
    run = add_running_sums(marks, [c(risk).asc()], ["op"], ["bit", "above"])
    pairs = F.sum(c("ev") * c("total_op"))
    return run.agg((F.sum(c("ev") * (c("cum_op") - c("op") + c("op") / 2)) / F.nullif(pairs, F.lit(0))).alias("c_index"))


def _digamma(x: float) -> tuple[float, float]:
    """The first and second derivative of log gamma at a positive number."""
    first = second = 0.0
    while x < 12:
        first, second, x = first - 1 / x, second + 1 / x**2, x + 1
    y = 1 / x**2
    first += math.log(x) - 0.5 / x - y * (1 / 12 - y * (1 / 120 - y * (1 / 252 - y / 240)))
    return first, second + 1 / x + y / 2 + y / x * (1 / 6 - y * (1 / 30 - y * (1 / 42 - y / 30)))


# Up to so many ties the sums are made term by term; beyond, their closed form has no cancellation to fear.
FEW_TIES = 10_000


def _tie_sums(a: float, b: float, events: int) -> tuple[float, float]:
    """Sums of r and r^2 over r = 1 / (a - i / events * b) for i below ``events``."""
    if events <= FEW_TIES:
        r = 1.0 / (a - np.arange(events) / events * b)
        return float(r.sum()), float((r * r).sum())
    scale = events / b
    high, low = _digamma(a * scale + 1), _digamma((a - b) * scale + 1)
    return scale * (high[0] - low[0]), scale**2 * (low[1] - high[1])


def cox_fit(rows: DataFrame, features: list[str], penalty: float = 0.1, steps: int = 25, tolerance: float = 1e-7) -> list[dict]:
    """Penalised proportional hazards by Newton steps with Efron ties.

    Each step is one aggregation: sums of weight, weighted features and their products per
    duration. The driver only sees (durations x features^2) numbers.
    """
    stats = rows.agg(
        F.count(F.lit(1)).alias("n"), *[F.avg(f).alias(f"m_{f}") for f in features],
        *[F.stddev_samp(f).alias(f"s_{f}") for f in features]).first()
    mean = {f: stats[f"m_{f}"] for f in features}
    dev = {f: stats[f"s_{f}"] or 1.0 for f in features}
    scaled = pin(rows.select("duration", "event", *[((c(f) - F.lit(mean[f])) / F.lit(dev[f])).alias(f) for f in features]))
    k, n = len(features), stats["n"]
    beta = np.zeros(k)
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    for _ in range(steps):
        weight = F.exp(sum((F.lit(float(b)) * c(f) for b, f in zip(beta, features)), F.lit(0.0)))
        # Two blocks per duration: everyone, and those with the event then.
        x = [c(f) for f in features]
        terms = [F.lit(1.0), *x, *[x[i] * x[j] for i, j in pairs]]
        sums = scaled.groupBy("duration").agg(
            F.sum("event").alias("d"),
            *[F.sum(weight * t).alias(f"a{i}") for i, t in enumerate(terms)],
            *[F.sum(F.when(c("event") == 1, weight * t)).alias(f"e{i}") for i, t in enumerate(terms)],
            *[F.sum(F.when(c("event") == 1, c(f))).alias(f"x{i}") for i, f in enumerate(features)],
        ).orderBy(F.desc("duration")).collect()
        gradient, hessian = -penalty * n * beta, -penalty * n * np.eye(k)
        all_sums = np.zeros(len(terms))
        for row in sums:
            all_sums += [row[f"a{i}"] for i in range(len(terms))]
            events = int(row["d"] or 0)
            if not events:
                continue
            tied = np.array([row[f"e{i}"] for i in range(len(terms))])
            gradient += [row[f"x{i}"] for i in range(k)]
            # The i-th of d tied events leaves (A - i/d B) / (a - i/d b) = B/b + (A - a B/b) r_i with
            # r_i = 1 / (a - i/d b), so only the sums of r and r^2 depend on the number of ties.
            a0, b0 = all_sums[0], tied[0]
            r1, r2 = _tie_sums(a0, b0, events)
            p, q = tied / b0, all_sums - a0 * tied / b0
            first = events * p + q * r1
            second = np.zeros((k, k))
            for (i, j), v in zip(pairs, first[k + 1:]):
                second[i, j] = second[j, i] = v
            px, qx = p[1:k + 1], q[1:k + 1]
            outer = events * np.outer(px, px) + (np.outer(px, qx) + np.outer(qx, px)) * r1 + np.outer(qx, qx) * r2
            gradient = gradient - first[1:k + 1]
            hessian = hessian - (second - outer)
        step = np.linalg.solve(hessian, gradient)
        beta = beta - step
        if np.max(np.abs(step)) < tolerance:
            break
    errors = np.sqrt(np.diag(np.linalg.inv(-hessian)))
    return [
        {"feature": f, "coef": float(b / dev[f]), "hazard_ratio": float(np.exp(b / dev[f])), "std_error": float(s / dev[f])}
        for f, b, s in zip(features, beta, errors)
    ]


# Share of the homes that is held out.
TEST_SHARE = 0.2


@dataclass(frozen=True)
class CoxReport:
    """A fit on the training homes: the table of its features, and how well it orders both parts."""

    features: DataFrame  # feature, coef, hazard_ratio, std_error, z, p_value
    concordance: DataFrame  # part (train, test), homes, c_index
    risks: DataFrame  # strap, part, duration, event, risk


def cox_report(times: DataFrame, panel: DataFrame, features: Sequence[str], log_features: Sequence[str] = (), penalty: float = 0.1,
               key: str = "strap", seed: int = 42) -> CoxReport:
    """Hazards from each home's last known features; amounts on a logarithmic scale, missing ones at the median.

    Homes are split by a hash of their key, 80 to 20; the fit sees the training homes alone.
    """
    # The last known value of each column, as later years may lack some.
    last = panel.groupBy(key).agg(*[F.max(F.when(c(f).isNotNull(), F.struct("year", c(f).cast("double").alias("v")))).alias(f) for f in features])
    value = lambda f: F.log1p(F.greatest(c(f"{f}.v"), F.lit(0.0))) if f in log_features else c(f"{f}.v")
    rows = pin(times.select(key, "duration", "event").join(last, key, "left").select(key, "duration", "event", *[value(f).alias(f) for f in features]))
    middle = median_scalars(rows, list(features))
    rows = pin(rows.withColumns({f: F.coalesce(c(f), F.lit(middle[f]), F.lit(0.0)) for f in features}))
    train, test = split_by_group(rows, key, TEST_SHARE, seed)
    fitted = cox_fit(train, list(features), penalty)
    found = [(r["feature"], r["coef"], r["hazard_ratio"], r["std_error"], r["coef"] / r["std_error"], math.erfc(abs(r["coef"] / r["std_error"]) / math.sqrt(2)))
             for r in fitted]
    hazard = sum((F.lit(r["coef"]) * c(r["feature"]) for r in fitted), F.lit(0.0))
    both = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    risks = pin(both.select(key, "part", "duration", "event", hazard.alias("risk")))
    ordered = []
    for part in ("train", "test"):
        own = risks.where(c("part") == part)
        ordered.append((part, own.count(), concordance(own, "risk").first()[0]))
    spark = times.sparkSession
    return CoxReport(
        spark.createDataFrame(found, "feature string, coef double, hazard_ratio double, std_error double, z double, p_value double"),
        spark.createDataFrame(ordered, "part string, homes bigint, c_index double"), risks)


def discrete_hazard(periods: DataFrame, features: list[str], seed: int = 42) -> dict[str, DataFrame]:
    """Pooled sparse logistic model on person-periods: hazard ratios, test lift in the last year, risk list."""
    data = M.scale(M.assemble(periods, features))
    train, test = split_by_group(data, "strap", 0.2, seed)
    train = pin(M.class_balanced(train, "hazard"))
    total = train.agg(F.sum("weight")).first()[0]
    fit = LogisticRegression(
        featuresCol="features", labelCol="hazard", weightCol="weight", elasticNetParam=1.0, regParam=1 / (0.1 * total),
        standardization=False, maxIter=200).fit(train)
    spark = periods.sparkSession
    ratios = spark.createDataFrame(
        [(f, float(w), float(np.exp(w))) for f, w in zip(features, fit.coefficients.toArray())],
        "feature string, coef double, hazard_ratio double")
    score = lambda df: fit.transform(df).withColumn("score", vector_to_array("probability")[1])
    last = test.agg(F.max("year")).first()[0]
    lift = M.lift_table(score(test.where(c("year") == last)).select(c("strap").alias("id"), c("hazard").alias("y"), "score"))
    latest = data.join(data.groupBy("strap").agg(F.max("year").alias("year")), ["strap", "year"])
    adopters = periods.where(c("hazard") == 1).select("strap")
    risk = score(latest).join(adopters, "strap", "left_anti").select("strap", "score")
    return {"ratios": ratios, "lift": lift, "risk": risk}
