"""Diagnostics over scored documents and runs: floors of a metric, invented values, leaders, timing, significance."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.text import MISSING
from ledgerloom.operators.analytics import effect_label


def scale_diagnostics(scores: DataFrame) -> DataFrame:
    """By document type, from (doc, doc_type, field, f1): how many fields are always perfect, the floor that they put under a document's
    mean, the worst mean, and how often a document's median is its best worked field (one that is not always perfect)."""
    fields = scores.groupBy("doc_type", "field").agg((F.min("f1") == 1).alias("free"))
    free = fields.groupBy("doc_type").agg(F.count("*").alias("n_fields"), F.count_if("free").alias("n_free"), F.array_join(F.array_sort(F.collect_list(F.when(F.col("free"), F.col("field")))), ", ").alias("free_fields"))
    docs = scores.join(fields, ["doc_type", "field"]).groupBy("doc_type", "doc").agg(F.avg("f1").alias("mean"), F.median("f1").alias("median"), F.max(F.when(~F.col("free"), F.col("f1"))).alias("best"))
    equal = F.when(F.col("best").isNotNull(), (F.abs(F.col("median") - F.col("best")) < 1e-9).cast("double"))
    worst = docs.groupBy("doc_type").agg(F.round(F.min("mean"), 6).alias("worst_mean"), F.round(F.avg(equal), 6).alias("median_is_best"))
    return free.join(worst, "doc_type").select("doc_type", "n_fields", "n_free", F.round(F.col("n_free") / F.col("n_fields"), 6).alias("floor"), "worst_mean", "median_is_best", "free_fields")


def invented(pairs: DataFrame, excluded: tuple[str, ...] = ()) -> DataFrame:
    """Values given where the truth has none, from (doc, field, value, truth): overall, by field and by document (``level`` tells which)."""
    gone = lambda c: F.upper(F.trim(F.coalesce(F.col(c), F.lit("")))).isin("", "NAN", MISSING)
    asked = pairs.filter(gone("truth") & ~F.col("field").isin(*excluded)).withColumn("bad", (~gone("value")).cast("long"))
    out = asked.groupingSets([[], [F.col("field")], [F.col("doc")]], F.col("field"), F.col("doc")).agg(F.sum("bad").alias("invented"), F.count("*").alias("absent"), F.grouping_id().alias("g"))
    level = F.when(F.col("g") == 3, "all").when(F.col("g") == 1, "field").otherwise("doc")
    return out.select(level.alias("level"), "field", "doc", "invented", "absent", F.round(F.col("invented") / F.col("absent"), 6).alias("rate"))


def run_statistics(runs: DataFrame, by: list[str]) -> DataFrame:
    """Counts, accuracy in percent and time of (f1, seconds, error); a run with an error failed and has no accuracy."""
    good = F.col("error").isNull()
    acc = F.when(good, F.col("f1") * 100)
    return runs.groupBy(*by).agg(
        F.count("*").alias("images"), F.count_if(good).alias("succeeded"), F.count_if(~good).alias("failed"), F.round(F.avg(acc), 6).alias("mean"), F.round(F.median(acc), 6).alias("median"),
        F.min(acc).alias("least"), F.max(acc).alias("most"), F.round(F.avg("seconds"), 6).alias("mean_seconds"), F.round(F.sum("seconds"), 4).alias("total_seconds"), F.round(60 / F.avg("seconds"), 6).alias("per_minute"),
    )


def tier_matrix(runs: DataFrame, tiers: tuple[str, ...], excluded: tuple[str, ...] = ()) -> DataFrame:
    """Mean F1 of each model and field by tier, what is lost from the first tier to the last and what share is kept; excluded fields are left out."""
    at = lambda t: F.avg(F.when(F.col("tier") == t, F.col("f1")))
    wide = runs.filter(~F.col("field").isin(*excluded)).groupBy("model", "field").agg(*[at(t).alias(t) for t in tiers])
    first, last = F.col(tiers[0]), F.col(tiers[-1])
    return wide.select("model", "field", *[F.round(t, 6).alias(t) for t in tiers], F.round(first - last, 6).alias("lost"), F.round(F.when(first != 0, last / first), 6).alias("kept"))


def retention(runs: DataFrame, tiers: tuple[str, ...], exclusions: dict[str, tuple[str, ...]]) -> DataFrame:
    """The share of a model's mean F1 that is left in the last tier, under each named set of excluded fields."""
    names = F.array(*[F.struct(F.lit(n).alias("without"), F.array(*map(F.lit, f)).cast("array<string>").alias("f")) for n, f in exclusions.items()])
    each = runs.withColumn("e", F.explode(names)).filter(~F.array_contains("e.f", F.col("field")))
    at = lambda t: F.avg(F.when(F.col("tier") == t, F.col("f1")))
    return each.groupBy("model", F.col("e.without").alias("without")).agg(F.round(at(tiers[-1]) / at(tiers[0]), 6).alias("kept"), F.countDistinct("field").alias("fields"))


def stage_times(records: DataFrame, walls: DataFrame) -> DataFrame:
    """By stage: inference is the sum of the slowest worker, startup what the wall clock has beyond it (never below 0).

    Records (stage, worker, seconds) and walls (stage, wall); a stage without records has no inference."""
    slow = records.groupBy("stage", "worker").agg(F.sum("seconds").alias("s")).groupBy("stage").agg(F.max("s").alias("inference"), F.count("*").alias("workers"))
    out = walls.join(slow, "stage", "left")
    spent = F.coalesce("inference", F.lit(0.0))
    return out.select("stage", F.round("wall", 4).alias("wall"), F.round(spent, 4).alias("inference"), F.round(F.greatest(F.lit(0.0), F.col("wall") - spent), 4).alias("startup"), F.coalesce("workers", F.lit(0).cast("long")).alias("workers"))


def leaders(runs: DataFrame, by: str = "doc_type") -> DataFrame:
    """Of each type the best model, its mean, and how far it is ahead of the second (equal means: the first by name)."""
    means = runs.groupBy(by, "model").agg(F.round(F.avg("f1"), 6).alias("m"))
    order = F.array_sort(F.collect_list(F.struct((-F.col("m")).alias("o"), "model")))
    top = means.groupBy(by).agg(order.alias("x"))
    at = lambda i: F.get(F.col("x"), F.lit(i))
    return top.select(by, at(0)["model"].alias("leader"), (-at(0)["o"]).alias("score"), at(1)["model"].alias("second"), F.round(at(1)["o"] - at(0)["o"], 6).alias("ahead"))


def quartiles(runs: DataFrame, by: list[str], value: str) -> DataFrame:
    """What a box plot shows: quartiles, and the last values within one and a half times their distance."""
    q = runs.groupBy(*by).agg(*[F.percentile(value, p).alias(n) for n, p in (("q1", 0.25), ("q2", 0.5), ("q3", 0.75))])
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    inside = runs.join(F.broadcast(q), by).filter(F.col(value).between(F.col("q1") - reach - 1e-12, F.col("q3") + reach + 1e-12))  # a row a group: their number is the plot's
    return inside.groupBy(*by, "q1", "q2", "q3").agg(F.min(value).alias("low"), F.max(value).alias("high"), F.count("*").alias("inside"))


def two_sided_p(t: Column, df: Column) -> Column:
    """The two-sided p-value of Student's t for a whole number of degrees of freedom: the finite sum over powers of cos(atan(t / sqrt(df)))."""
    theta = F.atan(F.abs(t) / F.sqrt(df))
    sin, cos = F.sin(theta), F.cos(theta)
    odd = df % 2 == 1
    terms = F.floor((df - F.when(odd, 1).otherwise(0)) / 2).cast("int")
    start = F.struct(F.when(odd, cos).otherwise(F.lit(1.0)).alias("x"), F.lit(0.0).alias("sum"))
    ratio = lambda k: F.when(odd, 2.0 * k / (2.0 * k + 1)).otherwise((2.0 * k - 1) / (2.0 * k))
    step = lambda s, k: F.struct((s["x"] * ratio(k) * cos * cos).alias("x"), (s["sum"] + s["x"]).alias("sum"))
    series = F.when(terms > 0, F.aggregate(F.sequence(F.lit(1), terms), start, step, lambda s: s["sum"])).otherwise(0.0)
    inside = F.when(odd, F.lit(2 / math.pi) * (theta + sin * series)).otherwise(sin * series)
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1 - inside))


def stars(p: Column) -> Column:
    return F.when(p < 0.001, "***").when(p < 0.01, "**").when(p < 0.05, "*").when(p.isNotNull(), "ns")


def significance(means: DataFrame, a: str, b: str) -> DataFrame:
    """One row over (field, x, y): paired t with its p-value and stars, Cohen's d of the differences and pooled, winner and advantage.

    Fewer than two fields, or differences that are all equal, have no t and an effect of 0."""
    d = F.round(F.col("x") - F.col("y"), 9)
    s = means.agg(F.count("*").alias("n"), F.avg(d).alias("m"), F.stddev_samp(d).alias("sd"), F.var_samp("x").alias("vx"), F.var_samp("y").alias("vy"), F.avg("x").alias("mx"), F.avg("y").alias("my"))
    s = s.withColumn("t", F.when(F.col("sd") > 0, F.col("m") / (F.col("sd") / F.sqrt("n"))))
    s = s.withColumn("p", two_sided_p(F.col("t"), F.col("n") - 1))
    pooled = F.sqrt((F.col("vx") + F.col("vy")) / 2)  # both have the same fields
    own = F.when(F.col("sd") > 0, F.col("m") / F.col("sd")).otherwise(0.0)
    both = F.when(pooled > 0, (F.col("mx") - F.col("my")) / pooled).otherwise(0.0)
    winner = F.when(F.col("mx") > F.col("my"), a).when(F.col("my") > F.col("mx"), b).otherwise("tie")
    return s.select("n", F.round("t", 6).alias("t"), F.round("p", 6).alias("p"), stars(F.col("p")).alias("stars"), F.round(own, 6).alias("d_paired"), F.round(both, 6).alias("d_pooled"), effect_label(own).alias("effect"), winner.alias("winner"), F.round(F.abs(F.col("mx") - F.col("my")), 6).alias("advantage"))


def date_span(dates: Column, parsed: Column) -> Column:
    """The first and the last date of a list as text, the earlier one first where both can be read; one date alone, or the missing mark."""
    bare = lambda x: F.regexp_replace(F.trim(x), r"(?i)^(mon|tue|wed|thu|fri|sat|sun)[a-z]*\s+", "")
    n = F.size(dates)
    first, last = bare(F.get(dates, F.lit(0))), bare(F.get(dates, n - 1))
    turned = F.coalesce(F.get(parsed, F.lit(0)) > F.get(parsed, n - 1), F.lit(False))
    span = F.when(turned, F.concat(last, F.lit(" - "), first)).otherwise(F.concat(first, F.lit(" - "), last))
    return F.when(F.coalesce(n, F.lit(0)) < 1, MISSING).when(n == 1, F.get(dates, F.lit(0))).otherwise(span)


def amounts_apart(got: Column, want: Column, tolerance: float = 0.01) -> Column:
    """(matched, missing, spurious) of two arrays of amounts: each wanted one takes the first free one within the tolerance."""
    places = lambda a: F.when(F.size(a) > 0, F.sequence(F.lit(0), F.size(a) - 1)).otherwise(F.array().cast("array<int>"))
    near = lambda used, w: F.get(F.filter(places(got), lambda i: ~F.array_contains(used, i) & F.coalesce(F.abs(F.get(got, i) - w) <= tolerance, F.lit(False))), F.lit(0))
    taken = F.aggregate(want, F.array().cast("array<int>"), lambda used, w: F.concat(used, F.array(F.coalesce(near(used, w), F.lit(-1)))))
    out = lambda u: F.struct(
        F.size(F.filter(u, lambda i: i >= 0)).cast("long").alias("matched"), F.filter(want, lambda w, i: F.get(u, i) < 0).alias("missing"), F.filter(got, lambda x, i: ~F.array_contains(u, i)).alias("spurious"),
    )
    return F.get(F.transform(F.array(taken), out), F.lit(0))
