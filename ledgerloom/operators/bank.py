"""Bank registers: balance chains, debit and credit correction, filters, totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.arrays import bound

# Descriptions of lines that are no transactions.
NOT_A_TRANSACTION = r"(?i)OPENING BALANCE|CLOSING BALANCE|BROUGHT FORWARD|CARRIED FORWARD"


def previous_balance(key: str = "case_id", order: str = "pos", balance: str = "balance") -> Column:
    """The last readable balance before a row; unreadable ones do not break the chain."""
    before = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return F.last(balance, ignorenulls=True).over(before)


def with_delta(register: DataFrame) -> DataFrame:
    """Adds prev_balance and delta."""
    return register.withColumn("prev_balance", previous_balance()).withColumn("delta", F.round(F.col("balance") - F.col("prev_balance"), 2))


def is_transaction(description: Column) -> Column:
    return ~F.coalesce(description.rlike(NOT_A_TRANSACTION), F.lit(False))


def correct(register: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """Debit and credit by the balance's change: kept, swapped, or taken from the change (``action``).

    A row without a readable balance, or without one before it, and a change below the tolerance keep
    what they have.
    """
    rows = with_delta(register.filter(is_transaction(F.col("description"))))
    size, debit, credit = F.abs("delta"), F.col("debit"), F.col("credit")
    own = F.when(F.col("delta") < 0, debit).otherwise(credit)
    other = F.when(F.col("delta") < 0, credit).otherwise(debit)
    fits = lambda c: (c > 0) & (F.round(F.abs(c - size), 6) < tolerance)
    action = F.when(F.col("delta").isNull() | (size < tolerance), "kept").when(fits(own), "confirmed").when(fits(other), "swapped").otherwise("derived")
    value = F.when(F.col("action") == "confirmed", own).when(F.col("action") == "swapped", other).otherwise(size)
    kept = F.col("action") == "kept"
    return rows.withColumn("action", action).withColumns({
        "new_debit": F.when(kept, debit).when(F.col("delta") < 0, value).otherwise(0.0),
        "new_credit": F.when(kept, credit).when(F.col("delta") > 0, value).otherwise(0.0),
    })


def chronology(register: DataFrame) -> DataFrame:
    """Whether a register runs forward in time: its first date strictly before its last."""
    ends = register.groupBy("case_id").agg(F.min_by("txn_date", "pos").alias("first_date"), F.max_by("txn_date", "pos").alias("last_date"), F.count("*").alias("n_rows"))
    return ends.withColumn("chronological", (F.col("n_rows") > 1) & (F.col("first_date") < F.col("last_date")))


def totals(register: DataFrame) -> DataFrame:
    """Totals and whether opening plus credits less debits gives the closing balance."""
    out = register.groupBy("case_id").agg(
        F.round(F.sum("debit"), 2).alias("total_debit"), F.round(F.sum("credit"), 2).alias("total_credit"), F.count("*").alias("n_rows"),
        F.min_by("true_balance", "pos").alias("first_balance"), F.max_by("true_balance", "pos").alias("last_balance"),
    )
    return out.withColumn("moved", F.round(F.col("last_balance") - F.col("first_balance"), 2))


def keyword_type(description: Column, debit_words: tuple[str, ...], credit_words: tuple[str, ...]) -> Column:
    """DEBIT or CREDIT by which list has more words within the description; null on a tie."""
    count = lambda up, words: sum((up.contains(w).cast("int") for w in words), F.lit(0))
    more = bound(F.upper(description), lambda up: count(up, debit_words) - count(up, credit_words))
    return bound(more, lambda n: F.when(n > 0, "DEBIT").when(n < 0, "CREDIT"))
