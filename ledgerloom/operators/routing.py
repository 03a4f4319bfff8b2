"""Column headers of registers, their roles, and what follows from them: router edges, strategies, document types."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Keywords of each role, in the order in which they are tried.
ROLES = {
    "date": ("date", "day", "transaction date", "trans date"),
    "description": ("description", "details", "transaction details", "trans details", "particulars", "narrative", "transaction", "trans"),
    "debit": ("debit", "debits", "withdrawal", "withdrawals", "paid", "paid out", "spent", "dr"),
    "credit": ("credit", "credits", "deposit", "deposits", "received", "cr"),
    "balance": ("balance", "bal", "running balance"),
    "amount": ("amount", "amt", "value", "total"),
}


def header_list(raw: Column) -> Column:
    """Headers of a response, one a line or several on a long line with commas or pipes; bullets, markdown and labels go."""
    lines = F.filter(F.transform(F.split(raw, "\n"), lambda x: F.trim(x)), lambda x: x != "")
    bare = F.transform(lines, lambda x: F.regexp_replace(F.trim(F.regexp_replace(x, r"^[0-9.\-•* ]+", "")), r"\*\*|__", ""))
    count = lambda x, sign: F.length(x) - F.length(F.replace(x, F.lit(sign), F.lit("")))

    def read(x: Column) -> Column:
        parts = F.when(count(x, "|") >= 2, F.split(x, r"\|")).otherwise(F.split(x, ","))
        several = F.filter(F.transform(parts, lambda p: F.trim(p)), lambda p: F.length(p) > 1)
        none = F.array().cast("array<string>")
        return (
            F.when(x.endswith(":"), none).when((F.length(x) > 20) & ((count(x, ",") >= 2) | (count(x, "|") >= 2)), several)
            .when((F.length(x) > 40) | (F.length(x) <= 2), none).otherwise(F.array(x))
        )

    return F.flatten(F.transform(bare, read))


def header_of(headers: Column, keywords: tuple[str, ...]) -> Column:
    """The header of a role: equal to a keyword, else a short one that holds a keyword; earlier keywords count first."""
    first = lambda test: F.get(F.filter(headers, test), F.lit(0))
    same = lambda k: lambda h: F.lower(h) == k
    holds = lambda k: lambda h: (F.length(h) <= 20) & F.lower(h).contains(k)
    equal = [first(same(k)) for k in keywords]
    within = [first(holds(k)) for k in keywords if len(k) > 2]
    return F.coalesce(*equal, *within)


def column_roles(headers: Column, roles: dict[str, tuple[str, ...]] = ROLES) -> dict[str, Column]:
    """A column for each role.  A header that is both debit and credit is cut before the second of the two words."""
    out = {role: header_of(headers, words) for role, words in roles.items()}
    if "debit" in out and "credit" in out:
        h = out["debit"]
        d, c = F.instr(F.lower(h), "debit"), F.instr(F.lower(h), "credit")
        cut = F.greatest(d, c)
        left, right = F.trim(F.regexp_replace(F.substring(h, F.lit(1), cut - 1), r"[ /]+$", "")), F.trim(F.substring(h, cut, F.length(h)))
        merged = (h == out["credit"]) & (d > 0) & (c > 0) & (left != "") & (right != "")
        swap = ~F.lower(left).contains("debit")
        out["debit"], out["credit"] = (
            F.when(merged, F.when(swap, right).otherwise(left)).otherwise(out["debit"]),
            F.when(merged, F.when(swap, left).otherwise(right)).otherwise(out["credit"]),
        )
    return out


def register_edge(balance: Column, debit: Column, credit: Column, amount: Column) -> Column:
    """The router's edge by the columns that were found."""
    return F.when(balance.isNotNull() & debit.isNotNull(), "has_balance_debit").when(amount.isNotNull(), "has_amount").when(debit.isNotNull() | credit.isNotNull(), "has_debit_or_credit").otherwise("default")


def router_edge(doc_type: Column, edges: tuple[str, ...], by_columns: Column) -> Column:
    """The edge of the document type, if the graph has one, else that of the columns, else the default."""
    named = F.concat(F.lit("is_"), F.lower(doc_type))
    return F.when(named.isin(*edges), named).when(by_columns.isin(*edges), by_columns).otherwise("default")


def strategy(balance: Column, debit: Column, credit: Column, amount: Column) -> Column:
    """How a register is read, by its columns: one of four ways."""
    sides, one = debit.isNotNull() | credit.isNotNull(), amount.isNotNull()
    return (
        F.when(balance.isNotNull() & sides, "BALANCE_DESCRIPTION").when(one, "AMOUNT_DESCRIPTION").when(sides, "DEBIT_CREDIT_DESCRIPTION").otherwise("TABLE_EXTRACTION")
    )


# Why a register is read as it is.
REASONS = {
    "forced": "Manual override", "balance_sides": "Balance + Debit/Credit columns detected", "balance_amount": "Balance + Amount column detected (signed values)", "amount": "Amount column detected (no balance)",
    "sides": "Debit/Credit columns detected (no balance)", "none": "Schema fallback (column detection failed)",
}


def reasoned_strategy(balance: Column, debit: Column, credit: Column, amount: Column, forced: Column | None = None) -> Column:
    """(strategy, reason): a forced strategy, or that of the columns; debit and credit columns go before a signed one where there is a balance."""
    sides, one, whole = debit.isNotNull() | credit.isNotNull(), amount.isNotNull(), balance.isNotNull()
    made = lambda name, why: F.struct((F.lit(name) if isinstance(name, str) else name).alias("strategy"), F.lit(REASONS[why]).alias("reason"))
    by_columns = (
        F.when(whole & sides, made("BALANCE_DESCRIPTION", "balance_sides")).when(whole & one, made("AMOUNT_DESCRIPTION", "balance_amount")).when(one, made("AMOUNT_DESCRIPTION", "amount"))
        .when(sides, made("DEBIT_CREDIT_DESCRIPTION", "sides")).otherwise(made("TABLE_EXTRACTION", "none"))
    )
    return by_columns if forced is None else F.when(forced.isNotNull(), made(forced, "forced")).otherwise(by_columns)


def probed_type(fields: Column, roles_found: Column, type_of: Column) -> Column:
    """BANK_STATEMENT where three roles or more and fewer than six fields were found; a payment date makes a receipt."""
    found = F.size(F.map_filter(fields, lambda k, v: (v != "NOT_FOUND") & ~k.startswith("_") & (k == F.upper(k))))
    paid = F.coalesce(F.try_element_at(fields, F.lit("PAYMENT_DATE")), F.lit("NOT_FOUND")) != "NOT_FOUND"
    return F.when((roles_found >= 3) & (found < 6), "BANK_STATEMENT").when(paid, "RECEIPT").otherwise(F.coalesce(type_of, F.lit("RECEIPT")))


def timing(stage_seconds: Column, stage_images: Column, elapsed: Column, summed: Column, images: Column) -> tuple[Column, Column]:
    """(seconds, where they come from): the stages' own if they cover the same images, the run's, the sum, or none."""
    own = (stage_seconds > 0) & (stage_images == images)
    seconds = F.when(own, stage_seconds).when(elapsed > 0, elapsed).when(summed > 0, summed)
    source = F.when(own, "stage timing").when(elapsed > 0, "entrypoint elapsed").when(summed > 0, "per-image sum").otherwise("not recorded")
    return seconds, source


def batch_strategy(memory_gb: Column, high: float = 24.0, medium: float = 12.0) -> Column:
    """aggressive, balanced or conservative by memory; null without a figure."""
    return F.when(memory_gb >= high, "aggressive").when(memory_gb >= medium, "balanced").when(memory_gb.isNotNull(), "conservative")


def extraction_order(types: tuple[str, ...], doc_type: Column, area: Column | None = None, largest_first: bool = False) -> list[Column]:
    """What to sort by: the configured order of types, unknown ones last, then perhaps the area of the image; add the input's order for ties."""
    place = F.array_position(F.array(*[F.lit(t.lower()) for t in types]), F.lower(F.coalesce(doc_type, F.lit(""))))
    first = F.when(place > 0, place).otherwise(len(types) + 1).asc()
    return [first] if area is None else [first, area.desc_nulls_last() if largest_first else area.asc_nulls_last()]
