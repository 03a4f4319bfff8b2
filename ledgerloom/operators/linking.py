"""Receipts linked to bank rows: band join, best match, one-to-one assignment, evaluation.

The band join turns the amount tolerance into an equality on a bucket of the tolerance's width: the
receipt visits its bucket and both neighbours, so Spark plans a hash or sort-merge join on (case,
bucket) instead of comparing all rows of a case.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.dates import date_score
from ledgerloom.functions.text import containment, description_matches


def candidates(receipts: DataFrame, rows: DataFrame, tolerance: float = 0.01, window: int = 5) -> DataFrame:
    """Receipts with every bank row of their case within ``tolerance`` of the total, and the two scores."""
    width = max(tolerance, 1e-9) * 1.0001
    left = receipts.filter("total IS NOT NULL").withColumn("bucket", F.explode(F.array(*[F.floor(F.col("total") / width) + k for k in (-1, 0, 1)])))
    right = rows.withColumn("bucket", F.floor(F.col("amount") / width))
    met = left.join(right, ["case_id", "bucket"]).filter(F.abs(F.col("total") - F.col("amount")) <= tolerance).drop("bucket")
    return met.withColumns({"date_score": date_score(F.col("receipt_date"), F.col("txn_date"), window), "desc_score": containment(F.col("supplier"), F.col("description"))})


def confidence(date: Column, description: Column, threshold: float = 0.5) -> Column:
    """HIGH with date and description, MEDIUM with one, LOW with the amount alone, NONE without a row."""
    by_date, by_text = date > 0, description >= threshold
    return F.when(date.isNull(), "NONE").when(by_date & by_text, "HIGH").when(by_date | by_text, "MEDIUM").otherwise("LOW")


def best_match(receipts: DataFrame, rows: DataFrame, tolerance: float = 0.01, window: int = 5) -> DataFrame:
    """Each receipt with its best row: highest score, then the smaller position; null columns without one."""
    order = Window.partitionBy("case_id", "rid").orderBy((F.col("date_score") + F.col("desc_score")).desc(), "pos")
    best = candidates(receipts, rows, tolerance, window).withColumn("r", F.row_number().over(order)).filter("r = 1")
    best = best.select("case_id", "rid", "pos", "date_score", "desc_score")
    return receipts.join(best, ["case_id", "rid"], "left").withColumn("confidence", confidence(F.col("date_score"), F.col("desc_score")))


def _chosen(pairs: Column) -> Column:
    """The links of a case from its candidate pairs, as a fold over its receipts."""
    ordered = F.array_sort(F.transform(pairs, lambda p: F.struct(p["rid"].alias("rid"), (-(p["date_score"] + p["desc_score"])).alias("s"), p["pos"].alias("pos"), p["rank"].alias("rank"), p["date_score"].alias("date_score"), p["desc_score"].alias("desc_score"))))
    link = lambda p: F.struct(*[p[c].alias(c) for c in ("rid", "pos", "date_score", "desc_score")])

    def choose(every: Column) -> Column:
        first = F.filter(every, lambda p, i: F.coalesce(F.get(every, i - 1)["rid"] != p["rid"], F.lit(True)))
        turns = F.array_sort(F.transform(first, lambda p: F.struct(p["rank"], p["s"], p["rid"])))
        free = lambda links, t: F.filter(every, lambda p: (p["rid"] == t["rid"]) & ~F.exists(links, lambda q: q["pos"] == p["pos"]))
        none = F.array().cast("array<struct<rid:bigint,pos:bigint,date_score:double,desc_score:double>>")
        return F.aggregate(turns, none, lambda links, t: F.concat(links, F.transform(F.slice(free(links, t), 1, 1), link)))

    return F.get(F.transform(F.array(ordered), choose), F.lit(0))


def assign(receipts: DataFrame, rows: DataFrame, tolerance: float = 0.01, window: int = 5) -> DataFrame:
    """One-to-one links (case_id, rid, pos, date_score, desc_score, confidence).

    Within a case, receipts choose in the order of their best confidence and score; a row that is taken
    is gone, and a receipt whose rows are all taken stays without one.  The choice is a fold over a
    case's candidate pairs; they are few, as only equal amounts meet.
    """
    pairs = candidates(receipts, rows, tolerance, window).select("case_id", "rid", "pos", "date_score", "desc_score")
    pairs = pairs.withColumn("rank", F.expr("CASE WHEN date_score > 0 AND desc_score >= 0.5 THEN 0 WHEN date_score > 0 OR desc_score >= 0.5 THEN 1 ELSE 2 END"))

    listed = pairs.groupBy("case_id").agg(F.collect_list(F.struct("rid", "pos", "date_score", "desc_score", "rank")).alias("pairs"))
    links = listed.select("case_id", F.explode(_chosen(F.col("pairs"))).alias("l")).select("case_id", "l.*")
    out = receipts.select("case_id", "rid").join(links, ["case_id", "rid"], "left")
    return out.withColumn("confidence", confidence(F.col("date_score"), F.col("desc_score")))


def evaluate(links: DataFrame, truth: DataFrame) -> DataFrame:
    """Links (case_id, rid, pos) against expected ones (pos null: none expected), with one label a receipt."""
    t = truth.select("case_id", "rid", F.col("pos").alias("expected"), F.lit(True).alias("in_truth"))
    out = links.select("case_id", "rid", F.col("pos").alias("actual"), F.lit(True).alias("in_links")).join(t, ["case_id", "rid"], "full_outer")
    label = (
        F.when(F.col("in_truth").isNull(), "no_ground_truth").when(F.col("in_links").isNull(), "missing_link")
        .when(F.col("expected").isNull() & F.col("actual").isNull(), "true_negative").when(F.col("expected").isNull(), "false_positive")
        .when(F.col("actual").isNull(), "false_negative").when(F.col("expected") == F.col("actual"), "correct").otherwise("wrong_row")
    )
    return out.select("case_id", "rid", "expected", "actual", label.alias("outcome"))


def amount_gate(receipt: Column, bank: Column, tolerance: float = 0.01) -> Column:
    """Absolute gate: passes without a total, fails if the bank amount cannot be read; magnitudes count."""
    return F.when(receipt.isNull(), True).otherwise(F.coalesce(F.abs(F.abs(receipt) - F.abs(bank)) <= tolerance, F.lit(False)))


def relative_gate(receipt: Column, bank: Column, share: float = 0.01) -> Column:
    """Relative gate; a total of zero is not gated."""
    return F.when(receipt.isNull() | (receipt == 0), True).otherwise(F.coalesce(F.abs(receipt - bank) <= F.abs(receipt) * share, F.lit(False)))


LEVELS = ("NONE", "LOW", "MEDIUM", "HIGH")


def gated(links: DataFrame, rows: DataFrame, least: str = "LOW") -> DataFrame:
    """Links (case_id, rid, pos, confidence) as output records.  A link below ``least`` is not matched and its confidence is
    NONE, but the row it had found stays on the record; what is not matched is queued where the case has rows."""
    level = lambda c: F.array_position(F.array(*map(F.lit, LEVELS)), c)
    cases = rows.select("case_id").distinct().withColumn("has_rows", F.lit(True))
    sure = F.col("pos").isNotNull() & (level(F.col("confidence")) >= LEVELS.index(least) + 1)
    out = links.join(cases, "case_id", "left").withColumns({"matched": sure, "confidence": F.when(sure, F.col("confidence")).otherwise("NONE")})
    reason = F.when(F.col("has_rows").isNull(), "no statement in this case").when(F.col("matched"), "matched").when(F.col("pos").isNull(), "no row of this amount").otherwise("below the least confidence")
    return out.select("case_id", "rid", "pos", "matched", "confidence", (~F.col("matched") & F.col("has_rows").isNotNull()).alias("queued"), reason.alias("reasoning"))


def link_metrics(outcomes: DataFrame) -> DataFrame:
    """Counts, accuracy, precision and recall of ``evaluate``'s outcomes that have both sides."""
    o = F.col("outcome")
    n = lambda *names: F.count_if(o.isin(*names))
    found = outcomes.filter(~o.isin("no_ground_truth", "missing_link")).agg(
        F.count("*").alias("n"), n("correct").alias("tp"), n("true_negative").alias("tn"), n("false_positive", "wrong_row").alias("fp"), n("false_negative", "wrong_row").alias("fn"), n("correct", "wrong_row").alias("located"),
    )
    share = lambda a, b: F.round(F.when(b > 0, a / b).otherwise(0.0), 6)
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return found.select("n", "tp", "tn", "fp", "fn", share(tp + F.col("tn"), F.col("n")).alias("accuracy"), share(tp, tp + fp).alias("precision"), share(tp, tp + fn).alias("recall"), share(tp, F.col("located")).alias("row_accuracy"))


def pair_by_amount(links: Column, truth: Column, tolerance: float) -> Column:
    """Pairs (l, g) of places in two arrays of structs with a ``total``; null on the side that has none left.

    In the order of the truth each entry takes the first free link within the tolerance; what is left on both sides
    pairs up by place, and the rest of the longer side stays alone.
    """
    places = lambda a: F.when(F.size(a) > 0, F.sequence(F.lit(0), F.size(a) - 1)).otherwise(F.array().cast("array<int>"))
    none = F.array().cast("array<int>")

    def take(taken: Column, g: Column) -> Column:
        near = lambda i: ~F.array_contains(taken, i) & (F.abs(F.get(links, i)["total"] - F.get(truth, g)["total"]) <= tolerance)
        first = F.get(F.filter(places(links), lambda i: F.coalesce(near(i), F.lit(False))), F.lit(0))
        return F.concat(taken, F.array(F.coalesce(first, F.lit(-1))))

    def pairs(taken: Column) -> Column:
        paired = F.filter(F.transform(taken, lambda l, g: F.struct(l.alias("l"), g.alias("g"))), lambda p: p["l"] >= 0)
        rest = F.arrays_zip(F.filter(places(links), lambda i: ~F.array_contains(taken, i)).alias("l"), F.filter(places(truth), lambda g: F.get(taken, g) < 0).alias("g"))
        return F.concat(paired, F.transform(rest, lambda p: F.struct(p["l"].alias("l"), p["g"].alias("g"))))

    return F.get(F.transform(F.array(F.aggregate(places(truth), none, take)), pairs), F.lit(0))


RECORD = ("total", "amount", "date", "description")


def evaluate_receipts(links: DataFrame, truth: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """One record for each receipt of an image: what was expected and found, whether that and the row's parts are right, or an ``error``.

    Links (image, k, total, matched, confidence, amount, date, description) and truth (image, k, total, expected, amount, date,
    description), in the order of ``k``.  An image's receipts are one array a side; images are apart.
    """
    def listed(rows: DataFrame, more: tuple[str, ...], name: str) -> DataFrame:
        return rows.groupBy("image").agg(F.array_sort(F.collect_list(F.struct("k", *RECORD, *more))).alias(name))

    both = listed(links, ("matched", "confidence"), "links").join(listed(truth, ("expected",), "truth"), "image", "full_outer")
    alone = lambda a, l, g: F.transform(a, lambda x, i: F.struct(l(i).cast("int").alias("l"), g(i).cast("int").alias("g")))
    null = lambda i: F.lit(None)
    pairs = F.when(F.col("truth").isNull(), alone("links", lambda i: i, null)).when(F.col("links").isNull(), alone("truth", null, lambda i: i)).otherwise(pair_by_amount(F.col("links"), F.col("truth"), tolerance))
    rows = both.withColumn("pairs", pairs).select("image", "links", "truth", F.posexplode("pairs").alias("n", "p"))
    rows = rows.select("image", "n", F.col("truth").isNull().alias("no_truth"), F.col("links").isNull().alias("no_links"), F.get("links", F.col("p.l")).alias("l"), F.get("truth", F.col("p.g")).alias("g"))
    link, want = F.col("l"), F.col("g")
    found, expected = F.coalesce(link["matched"], F.lit(False)), want["expected"] == "FOUND"
    error = (
        F.when(F.col("no_truth"), "no_ground_truth").when(F.col("no_links"), "missing_link_output")
        .when(link.isNull(), "unmatched_ground_truth").when(want.isNull(), "unmatched_link_output")
    )
    trimmed = lambda s: F.trim(F.coalesce(s["description"], F.lit("")))
    same = {
        "amount": F.abs(link["amount"] - want["amount"]) <= tolerance, "date": (F.trim(link["date"]) == F.trim(want["date"])) & (F.trim(want["date"]) != ""),
        "description": (trimmed(link) != "") & (trimmed(want) != "") & description_matches(trimmed(want), trimmed(link)),
    }
    right = lambda test: F.when(want.isNull(), None).otherwise(F.coalesce(expected & found & link.isNotNull() & test, F.lit(False)))
    return rows.select(
        "image", F.when(F.col("no_truth"), 0).otherwise(F.col("n")).cast("long").alias("receipt"), F.coalesce(want["expected"], F.lit("UNKNOWN")).alias("expected"), F.when(link.isNotNull(), found).alias("actual"),
        F.when(want.isNull(), None).when(link.isNull(), False).otherwise(expected == found).alias("correct"), F.coalesce(link["confidence"], F.lit("NONE")).alias("confidence"),
        *[right(test).alias(f"{name}_correct") for name, test in same.items()], error.alias("error"),
    )


def receipt_metrics(records: DataFrame) -> DataFrame:
    """Counts, accuracy, precision and recall over the receipts that could be judged, and the shares of right parts of found rows."""
    scored = records.filter(F.col("correct").isNotNull())
    want, got = F.col("expected") == "FOUND", F.coalesce(F.col("actual"), F.lit(False))
    parts = ("amount", "date", "description")
    sums = scored.agg(
        F.count("*").alias("receipts"), F.count_if("correct").alias("correct"), F.count_if(want & got).alias("tp"), F.count_if((F.col("expected") == "NOT_FOUND") & got).alias("fp"), F.count_if(want & ~got).alias("fn"),
        *[F.count_if(want & got & F.col(f"{p}_correct")).alias(p) for p in parts],
    )
    share = lambda a, n: F.round(F.when(F.col(n) > 0 if isinstance(n, str) else n > 0, F.col(a) / (F.col(n) if isinstance(n, str) else n)).otherwise(0.0), 6)
    tp = F.col("tp")
    return sums.select("receipts", "correct", "tp", "fp", "fn", share("correct", "receipts").alias("accuracy"), share("tp", tp + F.col("fp")).alias("precision"), share("tp", tp + F.col("fn")).alias("recall"), *[share(p, "tp").alias(f"{p}_accuracy") for p in parts])


def confidence_throughput(records: DataFrame, seconds: float) -> DataFrame:
    """How many judged receipts have each confidence, and how many receipts a minute the run judged (null without a time)."""
    scored = records.filter(F.col("correct").isNotNull())
    total = scored.agg(F.count("*").alias("receipts")).withColumn("per_minute", F.round(F.col("receipts") / seconds * 60, 6) if seconds > 0 else F.lit(None).cast("double"))
    return scored.groupBy("confidence").agg(F.count("*").alias("n")).crossJoin(total)  # one row
