"""Reports over scored runs: summaries, pivots, confusion, paired tests, position decay."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def summary(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """count, mean, median, sample deviation, least and most of a value."""
    return df.groupBy(*by).agg(
        F.count(value).alias("n"), F.round(F.avg(value), 6).alias("mean"), F.round(F.median(value), 6).alias("median"),
        F.round(F.stddev_samp(value), 6).alias("sd"), F.min(value).alias("least"), F.max(value).alias("most"),
    )


def confusion(df: DataFrame, actual: str, predicted: str, labels: list[str]) -> DataFrame:
    """One row an actual label, one column a predicted one, zero where none."""
    return df.groupBy(actual).pivot(predicted, labels).count().na.fill(0)


def class_report(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Precision, recall and F1 of each class."""
    hits = df.groupBy(F.col(actual).alias("label")).agg(F.count("*").alias("support"), F.count_if(F.col(actual) == F.col(predicted)).alias("tp"))
    named = df.groupBy(F.col(predicted).alias("label")).agg(F.count("*").alias("named"))
    out = hits.join(named, "label", "full_outer").na.fill(0, ["support", "tp", "named"])
    p = F.when(F.col("named") > 0, F.col("tp") / F.col("named")).otherwise(0.0)
    r = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(0.0)
    return out.select("label", "support", F.round(p, 6).alias("precision"), F.round(r, 6).alias("recall"), F.round(F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(0.0), 6).alias("f1"))


def best_model(df: DataFrame, models: list[str], value: str = "f1") -> DataFrame:
    """Mean of each field and model side by side, the best model, and the sample deviation over the models."""
    wide = df.groupBy("field").pivot("model", models).agg(F.round(F.avg(value), 6))
    scores = F.array(*[F.struct(F.col(m).alias("v"), F.lit(-i).alias("o"), F.lit(m).alias("m")) for i, m in enumerate(models)])
    mean = sum((F.col(m) for m in models[1:]), F.col(models[0])) / len(models)
    sd = F.sqrt(sum(((F.col(m) - mean) ** 2 for m in models), F.lit(0.0)) / (len(models) - 1))
    return wide.select("field", *models, F.array_max(scores)["m"].alias("best"), F.greatest(*models).alias("best_f1"), F.round(sd, 6).alias("spread"))


def paired_test(df: DataFrame, a: str, b: str, key: str = "doc") -> DataFrame:
    """Paired t statistic, Cohen's d and wins of two models over the documents that both have."""
    pair = df.filter(F.col("model") == a).select(key, F.col("f1").alias("x")).join(df.filter(F.col("model") == b).select(key, F.col("f1").alias("y")), key)
    d = F.col("x") - F.col("y")
    out = pair.agg(F.count("*").alias("n"), F.avg(d).alias("m"), F.stddev_samp(d).alias("s"), F.count_if(d > 0).alias("wins"), F.count_if(d < 0).alias("losses"), F.count_if(d == 0).alias("ties"))
    return out.select("n", F.round("m", 6).alias("mean_difference"), F.round(F.col("m") / (F.col("s") / F.sqrt("n")), 6).alias("t"), F.round(F.col("m") / F.col("s"), 6).alias("cohens_d"), "wins", "losses", "ties")


def effect_label(d: Column) -> Column:
    size = F.abs(d)
    return F.when(size < 0.2, "negligible").when(size < 0.5, "small").when(size < 0.8, "medium").otherwise("large")


def position_rates(predicted: DataFrame, truth: DataFrame, least: int = 5) -> DataFrame:
    """Right, wrong, missing and extra items at each position that has at least ``least`` expected ones, and the right share."""
    both = truth.select("doc", "pos", F.col("item").alias("want")).join(predicted.select("doc", "pos", F.col("item").alias("got")), ["doc", "pos"], "full_outer")
    want, got = F.col("want"), F.col("got")
    out = both.groupBy("pos").agg(F.count("want").alias("n"), F.count_if(want == got).alias("right"), F.count_if(want != got).alias("wrong"), F.count_if(got.isNull()).alias("missing"), F.count_if(want.isNull()).alias("extra"))
    return out.filter(F.col("n") >= least).withColumn("rate", F.round(F.col("right") / F.col("n"), 6))


def not_reversed(predicted: DataFrame, truth: DataFrame) -> DataFrame:
    """The predicted items of documents whose list is not the expected one backwards (lists of one item never are)."""
    size = truth.groupBy("doc").agg(F.count("*").alias("n")).filter("n > 1")
    back = truth.join(size, "doc").select("doc", (F.col("n") + 1 - F.col("pos")).alias("pos"), F.col("item").alias("want"))
    both = back.join(predicted.select("doc", "pos", F.col("item").alias("got")), ["doc", "pos"], "full_outer")
    turned = both.groupBy("doc").agg(F.bool_and(F.coalesce(F.col("want") == F.col("got"), F.lit(False))).alias("turned")).filter("turned")
    return predicted.join(turned, "doc", "left_anti")


def decay(rates: DataFrame) -> DataFrame:
    """Correlation of position and rate, and its trend; needs three positions."""
    out = rates.agg(F.count("*").alias("positions"), F.round(F.corr("pos", "rate"), 6).alias("r"))
    return out.withColumn("trend", F.when(F.col("positions") < 3, None).when(F.col("r") < -0.3, "tail-drop").when(F.col("r") <= 0.3, "flat").otherwise("improves"))


def majority(df: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """The value that at least two rows of a key share, the first seen of several; null without one."""
    counts = df.filter(F.col(value) != "").groupBy(key, value).agg(F.count("*").alias("n"), F.min(order).alias("first"))
    return counts.groupBy(key).agg(F.min_by(F.when(F.col("n") >= 2, F.col(value)), F.when(F.col("n") >= 2, F.col("first"))).alias("majority"))


def latest(df: DataFrame, key: list[str], order: str) -> DataFrame:
    """The last row of each key (an upsert's result)."""
    w = Window.partitionBy(*key).orderBy(F.desc(order))
    return df.withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r")


def slowest_worker(df: DataFrame, stage: str, worker: str, seconds: str) -> DataFrame:
    """Wall time of a stage run by parallel workers: the largest sum of a worker."""
    return df.groupBy(stage, worker).agg(F.sum(seconds).alias("s")).groupBy(stage).agg(F.round(F.max("s"), 4).alias("wall"), F.round(F.sum("s"), 4).alias("work"), F.count("*").alias("workers"))


def long_scores(records: DataFrame, scores: str, *keep: str) -> DataFrame:
    """One row for each field of a map of score structs."""
    return records.select(*keep, F.explode(scores).alias("field", "score")).select(*keep, "field", "score.*")


def binary_metrics(df: DataFrame, predicted: Column, actual: Column) -> DataFrame:
    """Counts of the four outcomes, precision, recall, F1 and the false-positive rate; 0 where there is nothing to divide by."""
    p, a = F.coalesce(predicted, F.lit(False)), F.coalesce(actual, F.lit(False))
    n = df.agg(F.count_if(p & a).alias("tp"), F.count_if(p & ~a).alias("fp"), F.count_if(~p & a).alias("fn"), F.count_if(~p & ~a).alias("tn"))
    share = lambda x, y: F.round(F.when(y > 0, x / y).otherwise(0.0), 6)
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return n.select("tp", "fp", "fn", "tn", share(tp, tp + fp).alias("precision"), share(tp, tp + fn).alias("recall"), share(2 * tp, 2 * tp + fp + fn).alias("f1"), share(fp, fp + tn).alias("fpr"))


def field_means(df: DataFrame, a: str, b: str) -> DataFrame:
    """(field, x, y): the mean F1 of both models on each field that both have."""
    mean = lambda m, name: df.filter(F.col("model") == m).groupBy("field").agg(F.avg("f1").alias(name))
    return mean(a, "x").join(mean(b, "y"), "field")


def by_category(means: DataFrame, category: Column) -> DataFrame:
    """Means and wins of both models in each category of fields."""
    d = F.round(F.col("x") - F.col("y"), 9)
    return means.groupBy(category.alias("category")).agg(F.round(F.avg("x"), 6).alias("mean_x"), F.round(F.avg("y"), 6).alias("mean_y"), F.count_if(d > 0).alias("wins_x"), F.count_if(d < 0).alias("wins_y"), F.count("*").alias("fields"))


def comparison(means: DataFrame, critical: Column) -> DataFrame:
    """One row for two models over fields: spread of each, wins, ties, and the means of critical fields."""
    d = F.round(F.col("x") - F.col("y"), 9)
    each = [f(c).alias(f"{n}_{c}") for c in ("x", "y") for n, f in (("mean", lambda c: F.round(F.avg(c), 6)), ("median", lambda c: F.round(F.median(c), 6)), ("sd", lambda c: F.round(F.stddev_samp(c), 6)), ("least", lambda c: F.round(F.min(c), 6)), ("most", lambda c: F.round(F.max(c), 6)))]
    return means.agg(*each, F.count_if(d > 0).alias("wins"), F.count_if(d < 0).alias("losses"), F.count_if(d == 0).alias("ties"), F.round(F.avg(F.when(critical, F.col("x"))), 6).alias("critical_x"), F.round(F.avg(F.when(critical, F.col("y"))), 6).alias("critical_y"))


def paired_ranks(means: DataFrame) -> DataFrame:
    """Over fields (few, by the schema): the paired t, the signed-rank sums of non-zero differences with mean ranks for
    ties, and the effect size by the population deviation."""
    d = means.select(F.round(F.col("x") - F.col("y"), 9).alias("d"))
    size = F.abs("d")
    ranked = d.filter("d <> 0").withColumn("rank", F.rank().over(Window.orderBy(size)) + (F.count("*").over(Window.partitionBy(size)) - 1) / 2)
    w = ranked.agg(F.round(F.coalesce(F.sum(F.when(F.col("d") > 0, F.col("rank"))), F.lit(0.0)), 6).alias("w_plus"), F.round(F.coalesce(F.sum(F.when(F.col("d") < 0, F.col("rank"))), F.lit(0.0)), 6).alias("w_minus"))
    t = d.agg(F.count("*").alias("n"), F.round(F.avg("d") / (F.stddev_samp("d") / F.sqrt(F.count("*"))), 5).alias("t"), F.round(F.avg("d") / F.stddev_pop("d"), 5).alias("cohens_d"))
    return t.crossJoin(w)  # one row each


def bootstrap_interval(means: DataFrame, draws: int = 10_000, level: float = 0.95, seed: int = 42) -> DataFrame:
    """The interval of the mean difference over ``draws`` samples of the fields with replacement, chosen by hashes."""
    d = means.select("field", (F.col("x") - F.col("y")).alias("d"))
    all_d = d.agg(F.array_sort(F.collect_list(F.struct("field", "d"))).alias("f"))  # a row for each field of the schema
    picks = F.transform(F.sequence(F.lit(1), F.size("f")), lambda i: F.get(F.col("f"), F.pmod(F.xxhash64(F.lit(seed), F.col("draw"), i), F.size("f")).cast("int"))["d"])
    mean = all_d.withColumn("draw", F.explode(F.sequence(F.lit(1), F.lit(draws)))).select((F.aggregate(picks, F.lit(0.0), lambda a, x: a + x) / F.size("f")).alias("m"))
    return mean.agg(F.percentile("m", (1 - level) / 2).alias("low"), F.percentile("m", (1 + level) / 2).alias("high"))


def spread(df: DataFrame, least: float = 0.2, top: int = 5) -> DataFrame:
    """The fields whose means differ most between models, where by more than ``least``."""
    means = df.groupBy("field", "model").agg(F.avg("f1").alias("m")).groupBy("field").agg(F.round(F.max("m") - F.min("m"), 6).alias("spread"))
    return means.filter(F.col("spread") > least).orderBy(F.desc("spread"), "field").limit(top)


def reconciled(asked: DataFrame, emitted: DataFrame, truth: DataFrame) -> DataFrame:
    """Each field of any of the three sides (a column ``field`` each), which have it, and what follows."""
    flag = lambda df, name: df.select("field").distinct().withColumn(name, F.lit(True))
    out = flag(asked, "asked").join(flag(emitted, "emitted"), "field", "full_outer").join(flag(truth, "truth"), "field", "full_outer").na.fill(False, ["asked", "emitted", "truth"])
    a, e, t = F.col("asked"), F.col("emitted"), F.col("truth")
    reason = F.when(a & e & t, "scored").when(a & e, "not in truth").when(a & t, "never emitted").when(e & t, "not asked").when(a, "asked only").when(e, "emitted only").otherwise("truth only")
    return out.withColumn("reason", reason)
