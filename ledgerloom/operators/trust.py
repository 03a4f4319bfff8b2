"""Four-document trust cases: assembly and compliance."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.money import all_agree, canonical_abn, pct_diff

KINDS = ("trust_return", "distribution_stmt", "income_schedule", "beneficiary_itr")


def best_documents(docs: DataFrame) -> DataFrame:
    """Of each case and kind the document with the highest confidence; known kinds only."""
    order = Window.partitionBy("case_id", "kind").orderBy(F.desc("confidence"), "abn", "income")
    return docs.filter(F.col("kind").isin(*KINDS)).withColumn("r", F.row_number().over(order)).filter("r = 1").drop("r")


def assemble(docs: DataFrame) -> DataFrame:
    """One row a case: each kind's fields as a struct column, and whether all four are there."""
    fields = F.first(F.struct("income", "franking", "cgt", "abn"), ignorenulls=True)
    wide = best_documents(docs).groupBy("case_id").pivot("kind", list(KINDS)).agg(fields)
    return wide.withColumn("complete", F.expr(" AND ".join(f"{k} IS NOT NULL" for k in KINDS)))


def compliance(quads: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """Canonical values, the first discrepancy that applies, and the status of each case."""
    c = lambda kind, field: F.col(f"{kind}.{field}")
    ds, itr, sched, ret = "distribution_stmt", "beneficiary_itr", "income_schedule", "trust_return"
    differs = lambda a, b: pct_diff(a, b) > tolerance
    kind = (
        F.when((c(itr, "income") < c(ds, "income")) & differs(c(itr, "income"), c(ds, "income")), "under_reported_income")
        .when((c(itr, "franking") > c(ds, "franking")) & differs(c(itr, "franking"), c(ds, "franking")), "over_claimed_franking")
        .when((c(ds, "cgt") > 0) & (c(sched, "cgt") == 0), "missing_cgt")
        .when(differs(c(ret, "income"), c(ds, "income")), "trust_return_mismatch")
        .otherwise("none")
    )
    agree = lambda field: all_agree(F.array(*[c(k, field) for k in KINDS]), tolerance)
    return quads.select(
        "case_id", "complete", canonical_abn(c(ds, "abn"), c(ret, "abn"), c(sched, "abn")).alias("trust_abn"), c(ds, "income").alias("income"), kind.alias("discrepancy"),
        F.when(kind == "none", "compliant").otherwise("non_compliant").alias("status"), agree("income").alias("income_agrees"), agree("franking").alias("franking_agrees"), agree("cgt").alias("cgt_agrees"),
    )


def evaluate_cases(extracted: DataFrame, truth: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """Per case of ``truth`` whether each linking value is right: identifiers without blanks, amounts by their relative
    difference; a case without an extraction has errors in all of them."""
    from ledgerloom.functions.money import normal_id

    values = ("income", "franking", "cgt")
    got = extracted.select("case_id", F.col("abn").alias("got_abn"), *[F.col(v).alias(f"got_{v}") for v in values], F.lit(True).alias("seen"))
    both = truth.select("case_id", "abn", *values).join(got, "case_id", "left")
    yes = lambda c: F.coalesce(c, F.lit(False))
    right = [yes(pct_diff(F.col(f"got_{v}"), F.col(v)) <= tolerance).alias(f"{v}_right") for v in values]
    return both.select("case_id", F.col("seen").isNull().alias("errored"), yes(F.col("seen") & (normal_id(F.col("got_abn")) == normal_id(F.col("abn")))).alias("abn_right"), *right)


def case_summary(cases: DataFrame, seconds: float) -> DataFrame:
    """One row over ``evaluate_cases``: how many cases and errors, the share of right values of each field over all cases, the share of cases
    that are wholly right, and cases a minute (null without a time)."""
    values = [c for c in cases.columns if c.endswith("_right")]
    whole = F.lit(True)
    for v in values:
        whole = whole & F.col(v)
    out = cases.agg(F.count("*").alias("cases"), F.count_if("errored").alias("errors"), *[F.round(F.avg(F.col(v).cast("double")), 6).alias(v.replace("_right", "_accuracy")) for v in values], F.round(F.avg(whole.cast("double")), 6).alias("all_right"))
    return out.withColumn("per_minute", F.round(F.col("cases") / seconds * 60, 6) if seconds > 0 else F.lit(None).cast("double"))
