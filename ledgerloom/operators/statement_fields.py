"""Transaction rows to a statement's fields, by the way the rows were read: ``balance``, ``debit_credit`` or ``amount``.

With balances the rows are put in the order of their dates (unless the first is before the last), each is held against the change of
the balance, and its amount moves to the side that the change says or is taken from the change.  Debits then remain: rows with a debit that
can be read, or with a negative amount.  Only rows with a date, a description and an amount make the lists, so all lists have one length.
Rows are the arrays of ``statements.statement_rows``; null and empty arrays give missing marks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.arrays import bound, each
from ledgerloom.functions.dates import REGISTER_LADDER, ladder
from ledgerloom.functions.money import debit_text, is_negative_text
from ledgerloom.functions.text import MISSING
from ledgerloom.operators.bank import is_transaction
from ledgerloom.operators.diagnostics import date_span
from ledgerloom.operators.statements import ROWS, VALUES, strip

STRATEGIES = ("balance", "debit_credit", "amount")
_CHANGES = ("debit", "credit")


def _number(c: Column, brackets: bool = False) -> Column:
    bare = strip(F.regexp_replace(F.coalesce(c, F.lit("")), r"[$,]|CR|DR", ""))
    if brackets:
        bare = bound(bare, lambda x: F.when(x.startswith("(") & x.endswith(")"), F.concat(F.lit("-"), F.substring(x, F.lit(2), F.length(x) - 2))).otherwise(x))
    return bare.try_cast("double")


def _with(row: Column, **new: Column) -> Column:
    return F.struct(*[new.get(v, row[v]).cast("string").alias(v) for v in ("date", *VALUES)])


def dated(rows: Column) -> Column:
    """(d, i, r): each row's date, read once for all that asks for it, its place and the row itself."""
    return F.transform(F.coalesce(rows, F.array().cast(ROWS)), lambda r, i: F.struct(ladder(F.coalesce(r["date"], F.lit("")), REGISTER_LADDER).alias("d"), i.alias("i"), r.alias("r")))


def in_date_order(k: Column) -> Column:
    """The rows of ``dated`` by date where they do not already run forward; what cannot be read comes last."""
    forward = F.coalesce((F.size(k) > 1) & (F.get(k, F.lit(0))["d"] < F.get(k, F.size(k) - 1)["d"]), F.lit(False))
    by_date = F.sort_array(F.transform(k, lambda x: F.struct(x["d"].isNull().alias("n"), x["d"].alias("d"), x["i"].alias("i"), x["r"].alias("r"))))
    return F.when(forward, k["r"]).otherwise(by_date["r"])


def _span(k: Column) -> Column:
    return bound(F.filter(k, lambda x: x["r"]["date"] != ""), lambda x: date_span(x["r"]["date"], x["d"]))


def by_balance(rows: Column, tolerance: float = 0.01) -> Column:
    """The transactions with debit and credit as the balance's change says; a fold that carries the last readable balance."""
    start = F.struct(F.lit(None).cast("double").alias("at"), F.array().cast(ROWS).alias("rows"))

    def settled(r: Column, delta: Column) -> Column:
        size = F.abs(delta)
        fits = lambda c: F.coalesce(bound(_number(r[c]), lambda x: (x > 0) & (F.round(F.abs(x - size), 6) < tolerance)), F.lit(False))
        text = F.concat(F.lit("$"), size.cast("decimal(18,2)").cast("string"))
        side = lambda own, other: _with(r, **{own: F.when(fits(own), r[own]).when(fits(other), r[other]).otherwise(text), other: F.lit(MISSING)})
        return F.when(F.coalesce(size < tolerance, F.lit(True)), r).when(delta < 0, side("debit", "credit")).otherwise(side("credit", "debit"))

    def step(s: Column, r: Column) -> Column:
        one = lambda now: F.array(bound(F.round(now - s["at"], 6), lambda delta: settled(r, delta)))
        taken = lambda now: F.struct(F.coalesce(now, s["at"]).alias("at"), F.concat(s["rows"], one(now)).alias("rows"))
        return F.when(is_transaction(r["description"]), bound(_number(r["balance"], brackets=True), taken)).otherwise(s)

    return F.aggregate(rows, start, step, lambda s: s["rows"])


def payments(rows: Column, strategy: str) -> Column:
    """The rows that are payments, their amount in ``debit``."""
    filled = lambda c: F.coalesce(c != "", F.lit(False))
    if strategy == "amount":
        own = F.filter(rows, lambda r: filled(r["amount"]) & is_transaction(r["description"]) & is_negative_text(r["amount"]))
        own = F.transform(own, lambda r: _with(r, debit=debit_text(r["amount"])))
    else:
        own = F.filter(rows, lambda r: filled(r["debit"]) & (F.upper(r["debit"]) != MISSING) & F.coalesce(_number(r["debit"]) != 0, F.lit(False)) & is_transaction(r["description"]))
    return F.filter(own, lambda r: filled(r["date"]) & filled(r["description"]))


def _fields(k: Column, span: Column, strategy: str) -> Column:
    listed = lambda own, c: bound(F.array_join(F.transform(own, c), " | "), lambda x: F.when(x == "", MISSING).otherwise(F.coalesce(x, F.lit(MISSING))))
    known = (lambda r: F.lit(MISSING)) if strategy == "debit_credit" else (lambda r: F.coalesce(F.nullif(r["balance"], F.lit("")), F.lit(MISSING)))
    names = ("DOCUMENT_TYPE", "STATEMENT_DATE_RANGE", "TRANSACTION_DATES", "LINE_ITEM_DESCRIPTIONS", "TRANSACTION_AMOUNTS_PAID", "ACCOUNT_BALANCE")
    values = lambda own: F.array(
        F.lit("BANK_STATEMENT"), span, listed(own, lambda r: r["date"]), listed(own, lambda r: r["description"]), listed(own, lambda r: r["debit"]), listed(own, known)
    )
    rows = by_balance(in_date_order(k)) if strategy == "balance" else k["r"]
    return F.map_from_arrays(F.array(*map(F.lit, names)), bound(payments(rows, strategy), values))


def _read_once(statements: DataFrame, rows: str) -> DataFrame:
    return statements.withColumn("_dated", dated(F.col(rows))).withColumn("_span", _span(F.col("_dated")))


def schema_fields(statements: DataFrame, rows: str, strategy: str) -> DataFrame:
    """Adds ``fields``: the five fields of a statement and its balances, from the rows in column ``rows`` as one strategy reads them."""
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy {strategy!r} is none of {', '.join(STRATEGIES)}")
    return _read_once(statements, rows).withColumn("fields", _fields(F.col("_dated"), F.col("_span"), strategy)).drop("_dated", "_span")


def fields_by_strategy(statements: DataFrame, rows: str) -> DataFrame:
    """``schema_fields`` by every strategy in one pass: a row for each, its name in ``way``; the rows themselves go."""
    ways = F.array(*[F.struct(F.lit(s).alias("way"), _fields(F.col("_dated"), F.col("_span"), s).alias("fields")) for s in STRATEGIES])
    kept = [c for c in statements.columns if c != rows]
    return each(_read_once(statements, rows).select(*kept, ways.alias("_ways")), "_ways", "_place", "_way").select(*kept, "_way.way", "_way.fields")
