"""Statement maths: parallel lists of a statement to rows, amounts from the change of the balance, and lists again.

A statement is a map of fields to text.  Its lists are read with fallbacks for texts without pipes, put in rows by
their place, sorted by date (equal dates as they stand), compared with the balance before, reclassified by the words of
their descriptions, and written back in the old order, one item for each dated row.  All of it is column expressions
over the arrays of one document: nothing is exploded, shuffled or regrouped.

Dates and balances that cannot be read leave their list, as do empty items, so later ones move up; amounts keep
their places, unreadable ones count as none.  Rows beyond the dates go, missing balances count as 0.  Without dates or
balances ``success`` is false and nothing changes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.arrays import bound
from ledgerloom.functions.dates import STATEMENT_LADDER, ladder
from ledgerloom.functions.text import MISSING
from ledgerloom.operators.bank import keyword_type

# Words that tell money out from money in.
DEBIT_WORDS = (
    "withdrawal", "atm", "cash out", "payment", "purchase", "eftpos", "direct debit", "fee", "charge", "debit", "transfer to",
    "repayment", "mortgage", "home loan", "bill", "subscription", "insurance",
)
CREDIT_WORDS = (
    "salary", "wage", "payroll", "deposit", "credit", "transfer from", "received", "refund", "return", "dividend", "interest",
    "payment from", "income", "centrelink", "jobseeker", "pension",
)
# What is looked for in lists without pipes, in order.
DATE_RUNS = (r"[A-Za-z]{3}\s+\d{1,2}\s+[A-Za-z]{3}\s+\d{4}", r"\d{1,2}/\d{1,2}/\d{4}", r"\d{1,2}[/\-]\d{1,2}[/\-]\d{2,4}")
MONEY_RUNS = (r"\$[\d,]+\.?\d*(?:\s+CR)?", r"\$[\d,]+\.?\d*")
DATES, BALANCES, DESCRIPTIONS, PAID, RECEIVED = "TRANSACTION_DATES", "ACCOUNT_BALANCE", "LINE_ITEM_DESCRIPTIONS", "TRANSACTION_AMOUNTS_PAID", "TRANSACTION_AMOUNTS_RECEIVED"


def _given(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def _piped(c: Column) -> Column:
    return F.transform(F.split(c, r"\|"), lambda x: F.trim(x))


def _runs(c: Column, patterns: tuple[str, ...], last: Column | None = None) -> Column:
    """What the first pattern finds that finds anything."""
    found = [F.regexp_extract_all(c, F.lit(p), F.lit(0)) for p in patterns] + ([] if last is None else [last])
    some = F.filter(F.array(*found), lambda x: F.size(x) > 0)
    return F.coalesce(F.get(some, F.lit(0)), F.array().cast("array<string>"))


def _number(x: Column) -> Column:
    return F.regexp_replace(x, r"[^\d.-]", "").try_cast("double")


def statement_dates(c: Column) -> Column:
    """(date, text) of each date that can be read."""
    own = bound(_given(c), lambda t: F.when(t.contains("|"), F.filter(_piped(t), lambda x: x != "")).otherwise(_runs(t, DATE_RUNS)))
    read = F.transform(own, lambda x: F.struct(ladder(x, STATEMENT_LADDER).alias("date"), x.alias("text")))
    return F.filter(read, lambda x: x["date"].isNotNull())


def statement_balances(c: Column) -> Column:
    """The balances that can be read."""
    blanks = lambda t: F.filter(F.split(t, r"\s+"), lambda x: x.contains("$") | x.rlike(r"^\d"))
    own = bound(_given(c), lambda t: F.when(t.contains("|"), F.filter(_piped(t), lambda x: x != "")).otherwise(_runs(t, MONEY_RUNS, blanks(t))))
    return F.filter(F.transform(own, _number), lambda x: x.isNotNull())


def statement_amounts(c: Column) -> Column:
    """Amounts at their places; missing and unreadable ones are 0."""
    own = bound(_given(c), lambda t: F.when(t.isin("", MISSING), F.array().cast("array<string>")).when(t.contains("|"), _piped(t)).otherwise(_runs(t, MONEY_RUNS)))
    return F.transform(own, lambda x: F.coalesce(_number(x), F.lit(0.0)))


def statement_descriptions(c: Column) -> Column:
    return bound(_given(c), lambda t: F.when(t.isin("", MISSING), F.array().cast("array<string>")).otherwise(F.filter(_piped(t), lambda x: x != "")))


def reclassify(paid: Column, received: Column, description: Column) -> Column:
    """(paid, received, moved): an amount in the one column goes to the other if the description's words say so."""
    # the words are looked for only where an amount could move
    one = (F.coalesce(received > 0, F.lit(False)) & F.coalesce(paid == 0, F.lit(False))) | (F.coalesce(paid > 0, F.lit(False)) & F.coalesce(received == 0, F.lit(False)))
    kind = F.when(one, keyword_type(F.lower(description), tuple(w.upper() for w in DEBIT_WORDS), tuple(w.upper() for w in CREDIT_WORDS)))
    moves = lambda k: F.struct(
        F.coalesce((k == "DEBIT") & (received > 0) & (paid == 0), F.lit(False)).alias("out"), F.coalesce((k == "CREDIT") & (paid > 0) & (received == 0), F.lit(False)).alias("in")
    )
    return bound(bound(kind, moves), lambda m: _moved(m["out"], m["in"], paid, received))


def _moved(out: Column, in_: Column, paid: Column, received: Column) -> Column:
    return F.struct(F.when(out, received).when(in_, F.lit(0.0)).otherwise(paid).alias("paid"), F.when(in_, paid).when(out, F.lit(0.0)).otherwise(received).alias("received"), (out | in_).alias("moved"))


def _judged(x: Column) -> Column:
    """A row with its final amounts, its kind, and how the amount as given compares with the balance's change."""
    change, own = x["change"], x["own"]
    by_change = lambda want, given: F.when(given > 0, given).when(change.isNotNull() & want, F.abs(change))
    paid, received = by_change(change < 0, own["paid"]), by_change(change > 0, own["received"])
    vlm = F.when(x["paid"] != 0, x["paid"]).when(x["received"] != 0, x["received"])
    right = F.when(vlm.isNull(), None).when(x["paid"] != 0, F.coalesce(change < 0, F.lit(False))).otherwise(F.coalesce(change > 0, F.lit(False)))
    accuracy = F.when(change != 0, 1.0 - F.abs(vlm - F.abs(change)) / F.abs(change))
    return F.struct(
        x["i"].alias("i"), x["date"].alias("date"), x["text"].alias("text"), x["description"].alias("description"), x["balance"].alias("balance"), change.alias("change"),
        paid.alias("paid"), received.alias("received"), F.when(paid > 0, "DEBIT").when(received > 0, "CREDIT").otherwise("UNKNOWN").alias("kind"), own["moved"].alias("moved"),
        right.alias("right"), accuracy.alias("accuracy"), F.when(vlm.isNull(), 0.80).when(right, 0.95).otherwise(0.85).alias("confidence"),
    )


def analyse(statements: DataFrame, fields: str = "fields") -> DataFrame:
    """Adds ``success`` and ``rows``, the dated rows in the order of their dates, to statements with a map ``fields``."""
    of = lambda f: F.try_element_at(fields, F.lit(f))
    df = statements.withColumns({
        "_d": statement_dates(of(DATES)), "_b": statement_balances(of(BALANCES)), "_t": statement_descriptions(of(DESCRIPTIONS)),
        "_p": statement_amounts(of(PAID)), "_r": statement_amounts(of(RECEIVED)),
    })
    at = lambda c, i, none: F.coalesce(F.get(c, i), F.lit(none))
    row = lambda d, i: F.struct(
        d["date"].alias("date"), i.alias("i"), d["text"].alias("text"), at("_b", i, 0.0).alias("balance"), at("_t", i, "Transaction").alias("description"),
        F.abs(at("_p", i, 0.0)).alias("paid"), F.abs(at("_r", i, 0.0)).alias("received"),
    )
    success = (F.size("_d") > 0) & (F.size("_b") > 0)
    df = df.withColumns({"success": success, "_signed": F.exists("_p", lambda x: x < 0), "_s": F.when(success, F.array_sort(F.transform("_d", row)))})
    change = lambda x, k: F.when(k > 0, F.round(x["balance"] - F.get("_s", k - 1)["balance"], 6))
    known = F.transform("_s", lambda x, k: F.struct(*[x[c].alias(c) for c in ("date", "i", "text", "balance", "description", "paid", "received")], change(x, k).alias("change"), reclassify(x["paid"], x["received"], x["description"]).alias("own")))
    return df.withColumn("_k", known).withColumn("rows", F.transform("_k", _judged)).drop("_d", "_b", "_t", "_p", "_r", "_s", "_k")


def enhance(statements: DataFrame, fields: str = "fields") -> DataFrame:
    """The statements with the paid and received lists of ``fields`` written anew, and ``analysis``
    (success, total_debits, total_credits, transactions)."""
    df = analyse(statements, fields)
    dollars = lambda x: F.concat(F.lit("$"), x.cast("decimal(18,2)").cast("string"))
    in_order = F.array_sort("rows", lambda a, b: a["i"] - b["i"])
    paid = F.transform(in_order, lambda x: F.when(x["kind"] == "DEBIT", F.concat(F.when(F.col("_signed"), F.lit("-")).otherwise(F.lit("")), dollars(x["paid"]))).otherwise(MISSING))
    received = F.transform(in_order, lambda x: F.when(x["kind"] == "CREDIT", dollars(x["received"])).otherwise(MISSING))
    total = lambda c: F.round(F.aggregate("rows", F.lit(0.0), lambda acc, x: acc + F.coalesce(x[c], F.lit(0.0))), 2)
    new = F.create_map(F.lit(PAID), F.array_join(paid, " | "), F.lit(RECEIVED), F.array_join(received, " | "))
    kept = F.map_filter(fields, lambda k, v: ~k.isin(PAID, RECEIVED))
    analysis = F.struct(F.col("success"), F.when(F.col("success"), total("paid")).alias("total_debits"), F.when(F.col("success"), total("received")).alias("total_credits"), F.size(F.coalesce("rows", F.array())).cast("long").alias("transactions"))
    return df.withColumns({fields: F.when(F.col("success"), F.map_concat(kept, new)).otherwise(F.col(fields)), "analysis": analysis}).drop("_signed")


def by_change_alone(statements: DataFrame, fields: str = "fields") -> DataFrame:
    """The plain way: adds ``paid``, ``received`` (arrays of text in the old order), ``total_debits``, ``total_credits`` and ``success``.

    As many rows as both dates and balances have; the earliest row takes the first amount as given (paid before received), every other
    one the change of the balance.  Descriptions are not looked at."""
    of = lambda f: F.try_element_at(fields, F.lit(f))
    df = statements.withColumns({"_d": statement_dates(of(DATES)), "_b": statement_balances(of(BALANCES)), "_p": F.get(statement_amounts(of(PAID)), F.lit(0)), "_r": F.get(statement_amounts(of(RECEIVED)), F.lit(0))})
    n = F.least(F.size("_d"), F.size("_b"))
    rows = F.array_sort(F.transform(F.slice("_d", F.lit(1), n), lambda d, i: F.struct(d["date"].alias("date"), i.alias("i"), F.get("_b", i).alias("balance"))))
    df = df.withColumn("_s", rows)

    def amount(x: Column, k: Column) -> Column:
        change = F.round(x["balance"] - F.get("_s", k - 1)["balance"], 6)
        first = F.when(F.col("_p") > 0, -F.col("_p")).when(F.col("_r") > 0, F.col("_r")).otherwise(0.0)
        return F.struct(x["i"].alias("i"), F.when(k == 0, first).otherwise(change).alias("x"))

    df = df.withColumn("_k", F.array_sort(F.transform("_s", amount)))
    text = lambda test, x: F.when(test, F.concat(F.lit("$"), F.abs(x).cast("decimal(18,2)").cast("string"))).otherwise(MISSING)
    total = lambda test: F.round(F.aggregate("_k", F.lit(0.0), lambda acc, x: acc + F.when(test(x["x"]), F.abs(x["x"])).otherwise(0.0)), 2)
    return df.withColumns({
        "paid": F.transform("_k", lambda x: text(x["x"] < 0, x["x"])), "received": F.transform("_k", lambda x: text(x["x"] > 0, x["x"])), "total_debits": total(lambda x: x < 0), "total_credits": total(lambda x: x > 0),
        "success": F.size("_k") > 0,
    }).drop("_d", "_b", "_p", "_r", "_s", "_k")
