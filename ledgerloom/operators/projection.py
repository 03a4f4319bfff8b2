"""Records cut to the schema of their type, models aligned on a schema, seeded wrong copies of records, prompts and manifests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.arrays import bound
from ledgerloom.functions.text import MISSING

# What a prompt says of a statement whose columns are not known.
NO_COLUMNS = "The bank statement contains a table with columns for Date, Description,\n  and Amount (Debit/Credit or a single Amount column)."


def formatted(field: str, value: Column, monetary: tuple[str, ...], booleans: tuple[str, ...]) -> Column:
    """A value as a model would write it: pipes with blanks, ``$`` before each amount that is there, booleans in lower case."""
    items = F.transform(F.split(F.trim(value), r"\|"), lambda x: F.trim(x))
    if field in monetary:
        items = F.transform(items, lambda x: F.when((F.upper(x) == MISSING) | x.startswith("$"), x).otherwise(F.concat(F.lit("$"), x)))
    elif field in booleans:
        items = F.transform(items, lambda x: F.lower(x))
    return F.when(F.coalesce(F.trim(value), F.lit("")) == "", MISSING).otherwise(F.array_join(items, " | "))


def project(records: DataFrame, schema: dict[str, tuple[str, ...]], aliases: dict[str, str], monetary: tuple[str, ...] = (), booleans: tuple[str, ...] = ()) -> DataFrame:
    """Adds ``projected``: of (doc_type, fields) the fields of the type's schema, renamed ones under their name, absent ones as missing.
    Null for a type that the schema does not have."""
    old = {new: name for name, new in aliases.items()}
    out = None
    for kind, fields in schema.items():
        pairs = []
        for f in fields:
            own = F.try_element_at("fields", F.lit(f))
            value = F.coalesce(F.try_element_at("fields", F.lit(old[f])), own) if f in old else own
            pairs += [F.lit(f), formatted(f, value, monetary, booleans)]
        made = F.create_map(*pairs)
        is_kind = F.lower("doc_type") == kind.lower()
        out = F.when(is_kind, made) if out is None else out.when(is_kind, made)
    return records.withColumn("projected", out)


def unknown_types(projected: DataFrame) -> DataFrame:
    """How many records of each type were left out."""
    return projected.filter("projected IS NULL").groupBy("doc_type").agg(F.count("*").alias("skipped"))


def align_models(schema: DataFrame, a: DataFrame, b: DataFrame) -> DataFrame:
    """(field, category, critical, x, y, difference, exclusive) for each field of the schema; null where a model has no score, and
    ``exclusive`` where only one has."""
    side = lambda df, name: df.select("field", F.col("score").alias(name))
    out = schema.join(side(a, "x"), "field", "left").join(side(b, "y"), "field", "left")
    return out.withColumn("difference", F.round(F.col("x") - F.col("y"), 6)).withColumn("exclusive", F.col("x").isNull() != F.col("y").isNull())


def scored_only(predicted: DataFrame, truth: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(the predictions that the truth knows, one row with how many were kept and skipped)."""
    known = truth.select(key).distinct().withColumn("_known", F.lit(True))
    flagged = predicted.join(known, key, "left")
    return flagged.filter("_known").drop("_known"), flagged.agg(F.count("_known").alias("kept"), F.count_if(F.col("_known").isNull()).alias("skipped"))


def draw(seed: int, *key: Column) -> Column:
    """A number from 0 up to 1 that depends on the seed and the key alone."""
    return _drawn(F.concat_ws("|", F.lit(str(seed)), *key))


def _drawn(text: Column) -> Column:
    return F.conv(F.substring(F.md5(text), 1, 7), 16, 10).cast("long") / float(1 << 28)


def wrong_value(value: Column, u: Column, v: Column) -> Column:
    """A plausible wrong reading: often none at all, else another day, an amount off by a factor, or the end cut off."""
    day = F.regexp_extract(value, r"^(\d{2})/", 1).try_cast("int")
    shifted = F.concat(F.lpad((day % 28 + 1).cast("string"), 2, "0"), F.substring(value, F.lit(3), F.length(value)))
    amount = F.replace(value, F.lit(","), F.lit("")).try_cast("decimal(18,2)")
    factor = bound(v, lambda x: F.when(x < 1 / 3, F.lit("0.1").cast("decimal(4,1)")).when(x < 2 / 3, F.lit("1.1").cast("decimal(4,1)")).otherwise(F.lit("10.0").cast("decimal(4,1)")))
    scaled = amount * factor
    return (
        F.when(value == MISSING, value).when(u < 0.35, MISSING).when(value.rlike(r"^\d{2}/\d{2}/\d{4}$"), shifted).when(value.rlike(r"^-?[\d,]+\.\d{2}$"), F.round(scaled, 2).cast("decimal(18,2)").cast("string"))
        .when(value.contains(" "), F.regexp_replace(value, r"\s+\S+$", "")).when(F.length(value) > 3, F.substring(value, F.lit(1), F.length(value) - 1)).otherwise("UNKNOWN")
    )


def perturbed(records: DataFrame, field_error: float, item_error: float, seed: int) -> DataFrame:
    """Adds ``wrong`` to (doc, field, value): a value is misread with ``field_error``, an item of a pipe list with ``item_error``, and of
    those about one in seven is lost, so that later ones move up.  The same seed gives the same copy, on any cluster."""
    value, start = F.col("value"), F.col("_start")
    keyed = records.withColumn("_start", F.concat_ws("|", F.lit(str(seed)), F.col("doc").cast("string"), F.col("field"), F.lit("")))
    u = lambda what, i: _drawn(F.concat(start, i.cast("string"), F.lit(f"|{what}")))
    read = lambda x, i: F.when(u("hit", i) >= item_error, x).when(u("drop", i) < 0.15, None).otherwise(wrong_value(x, u("kind", i), u("much", i)))
    items = F.array_join(F.transform(F.split(value, r"\|"), read), "|")  # without those that are null
    zero = F.lit(0)
    one = F.when(u("hit", zero) < field_error, wrong_value(value, u("kind", zero), u("much", zero))).otherwise(value)
    # not by nullif, which would work the whole list out a second time
    listed = bound(items, lambda x: F.when(x == "", MISSING).otherwise(x))
    return keyed.withColumn("wrong", F.when(value == MISSING, value).when(value.contains("|"), listed).otherwise(one)).drop("_start")


def column_context(headers: Column, roles: dict[str, Column]) -> Column:
    """What a prompt says of a statement's columns; ``NO_COLUMNS`` where the headers are null."""
    named = F.array_join(F.transform(headers, lambda h: F.concat(F.lit("'"), h, F.lit("'"))), ", ")
    table = F.when(F.size(headers) > 0, F.concat(F.lit("The bank statement contains a table with columns (left to right): "), named, F.lit("."))).otherwise("The bank statement contains a table of transactions.")
    sides = F.when(
        roles["debit"].isNotNull() & roles["credit"].isNotNull(),
        F.concat(F.lit("Withdrawals/debits appear in the '"), roles["debit"], F.lit("' column; deposits/credits appear in the '"), roles["credit"], F.lit("' column.")),
    ).when(roles["amount"].isNotNull(), F.concat(F.lit("Amounts appear in the '"), roles["amount"], F.lit("' column (negative values are debits, positive are credits).")))
    balance = F.when(roles["balance"].isNotNull(), F.concat(F.lit("Running balance is in the '"), roles["balance"], F.lit("' column.")))
    said = F.nullif(F.concat_ws(" ", sides, balance), F.lit(""))
    return F.when(headers.isNull(), NO_COLUMNS).otherwise(F.concat_ws("\n  ", table, said))


def link_prompt(prefix: str, query: str, context: Column, store: Column, date: Column, total: Column) -> Column:
    """The prompt of one receipt: what statements share first, so that it can be cached, then the receipt."""
    shop = F.trim(F.coalesce(store, F.lit("")))
    values = {
        "receipt_store": F.when((shop == "") | (F.upper(shop) == MISSING), MISSING).otherwise(shop), "receipt_date": F.coalesce(F.date_format(date, "dd/MM/yyyy"), F.lit(MISSING)),
        "receipt_total": F.coalesce(total.cast("decimal(18,2)").cast("string"), F.lit(MISSING)),
    }
    asked = F.lit(query)
    for name, value in values.items():
        asked = F.replace(asked, F.lit("{" + name + "}"), value)
    return F.concat(F.replace(F.lit(prefix), F.lit("{bank_column_context}"), context), asked)


def manifest(truth: DataFrame) -> DataFrame:
    """The documents of each case from (distribution_stmt: file, entry: map), sorted by case."""
    from ledgerloom.functions.text import case_id

    of = lambda k: F.try_element_at("entry", F.lit(k))
    return truth.select(case_id(F.col("distribution_stmt")).alias("case_id"), of("trust_return").alias("trust_return"), "distribution_stmt", of("trust_income_schedule").alias("income_schedule"), of("beneficiary_itr").alias("beneficiary_itr")).orderBy("case_id", "distribution_stmt")
