"""Business checks of a document's fields as flag columns; no value is changed.

A flag is null where the check does not apply: fields that are missing, lists of other lengths, amounts that cannot be read.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.functions.arrays import bound
from ledgerloom.functions.money import parse_digits
from ledgerloom.functions.text import MISSING

TAX_PARTS = 11  # a tenth on top is an eleventh of the whole
CENTS = 0.02
COUNTED = ("LINE_ITEM_DESCRIPTIONS", "TRANSACTION_DATES", "TRANSACTION_AMOUNTS_PAID")


def business_flags(fields: Column) -> dict[str, Column]:
    """``items_off`` (places whose total is not price times quantity, within a hundredth), ``tax_off``, ``tax_unclear`` and
    ``counts_differ`` (a statement's lists have different lengths)."""
    of = lambda f: F.coalesce(F.try_element_at(fields, F.lit(f)), F.lit(MISSING))
    has = lambda *names: F.exists(F.array(*map(of, names)), lambda x: x != MISSING)
    every = lambda *names: F.forall(F.array(*map(of, names)), lambda x: x != MISSING)
    parts = lambda f: F.transform(F.split(of(f), r"\|"), lambda x: F.trim(x))
    amounts = lambda f: F.transform(parts(f), parse_digits)
    price, total, quantity = amounts("LINE_ITEM_PRICES"), amounts("LINE_ITEM_TOTAL_PRICES"), F.transform(parts("LINE_ITEM_QUANTITIES"), lambda x: x.try_cast("double"))

    def items_off(x: Column) -> Column:
        price, total, quantity = x["p"], x["t"], x["q"]
        fits = (F.size(price) == F.size(total)) & (F.size(price) == F.size(quantity)) & F.forall(quantity, lambda q: q.isNotNull())
        rows = F.transform(quantity, lambda q, i: F.struct(F.get(price, i).alias("p"), F.get(total, i).alias("t"), q.alias("q"), (i + 1).alias("i")))
        off = F.filter(rows, lambda r: (r["p"] != 0) & (r["t"] != 0) & (r["q"] != 0) & (F.abs(r["t"] - r["p"] * r["q"]) > r["p"] * r["q"] * 0.01))
        return F.when(fits, F.transform(off, lambda r: r["i"]))

    lists = every("LINE_ITEM_PRICES", "LINE_ITEM_TOTAL_PRICES", "LINE_ITEM_QUANTITIES")
    tax, before, whole = (parse_digits(of(f)) for f in ("GST_AMOUNT", "SUBTOTAL_AMOUNT", "TOTAL_AMOUNT"))
    taxed = has("GST_AMOUNT", "IS_GST_INCLUDED", "LINE_ITEM_GST_AMOUNTS") & every("GST_AMOUNT", "SUBTOTAL_AMOUNT", "TOTAL_AMOUNT") & tax.isNotNull() & before.isNotNull() & whole.isNotNull()
    included = F.lower(of("IS_GST_INCLUDED"))
    kind = F.upper(F.coalesce(F.try_element_at(fields, F.lit("DOCUMENT_TYPE")), F.lit("")))
    n = lambda f: F.size(F.filter(parts(f), lambda x: x != ""))
    counts = F.array_distinct(F.filter(F.array(*[F.when(of(f) != MISSING, n(f)) for f in COUNTED]), lambda x: x.isNotNull()))
    return {
        "items_off": F.when(lists, bound(F.struct(price.alias("p"), total.alias("t"), quantity.alias("q")), items_off)),
        "tax_off": F.when(taxed & (included == "true"), F.abs(tax - whole / TAX_PARTS) > CENTS).when(taxed & (included == "false"), F.abs(whole - before - tax) > CENTS),
        "tax_unclear": F.when(taxed, ~included.isin("true", "false")),
        "counts_differ": F.when(kind.contains("BANK") | kind.contains("STATEMENT"), F.size(counts) > 1),
    }
