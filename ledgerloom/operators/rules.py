"""Rule engines as CASE chains: evidence classification, trust types, routing, labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The evidence rules in order of priority, and the type without one.
EVIDENCE_RULES = (
    {"type": "BANK_STATEMENT", "any_roles": ("debit", "credit", "balance")},
    {"type": "LOGBOOK", "any_roles": ("distance", "odometer", "purpose")},
    {"type": "TRAVEL", "travel": True},
    {"type": "RECEIPT", "paid": True},
    {"type": "INVOICE", "any_roles": ("gst", "unit_price", "quantity")},
)
DEFAULT_TYPE = "INVOICE"


def _condition(rule: dict, roles: Column, paid: Column, travel: Column) -> Column:
    out = F.lit(True)
    if "any_roles" in rule:
        out = out & F.arrays_overlap(roles, F.array(*map(F.lit, rule["any_roles"])))
    if "all_roles" in rule:
        out = out & (F.size(F.array_except(F.array(*map(F.lit, rule["all_roles"])), roles)) == 0)
    if "paid" in rule:
        out = out & (paid == F.lit(rule["paid"]))
    if "travel" in rule:
        out = out & (travel == F.lit(rule["travel"]))
    return out


def check_rules(rules: tuple[dict, ...], known_roles: set[str]) -> None:
    """Raise on unknown keys or roles, and on rules without a type."""
    for i, rule in enumerate(rules):
        if unknown := set(rule) - {"type", "any_roles", "all_roles", "paid", "travel"}:
            raise ValueError(f"rule {i}: unknown keys {sorted(unknown)}")
        if not rule.get("type"):
            raise ValueError(f"rule {i}: no type")
        if strange := {r for k in ("any_roles", "all_roles") for r in rule.get(k, ())} - known_roles:
            raise ValueError(f"rule {i}: unknown roles {sorted(strange)}")


def first_type(roles: Column, paid: Column, travel: Column, rules: tuple[dict, ...] = EVIDENCE_RULES, default: str = DEFAULT_TYPE) -> Column:
    """The type of the first rule that holds."""
    out = F.when(_condition(rules[0], roles, paid, travel), rules[0]["type"])
    for rule in rules[1:]:
        out = out.when(_condition(rule, roles, paid, travel), rule["type"])
    return out.otherwise(default)


def all_types(roles: Column, paid: Column, travel: Column, rules: tuple[dict, ...] = EVIDENCE_RULES) -> Column:
    """The types of all rules that hold, in rule order."""
    return F.filter(F.array(*[F.when(_condition(r, roles, paid, travel), r["type"]) for r in rules]), lambda t: t.isNotNull())


def complexity(rows: Column) -> Column:
    return F.when(rows <= 5, "LOW").when(rows <= 20, "MEDIUM").otherwise("HIGH")


def readiness(percent: Column) -> Column:
    return F.when(percent >= 95, "READY").when(percent >= 80, "PILOT").otherwise("NEEDS_WORK")


def trust_type(header: Column, item13: Column, table: Column, addressed: Column, abn: Column) -> Column:
    """(type, confidence) of a trust document from its evidence; rules, their order and confidences are fixed values."""
    h = F.lower(F.coalesce(header, F.lit("")))
    made = lambda kind, conf: F.struct(F.lit(kind).alias("type"), F.lit(conf).alias("confidence"))
    return (
        F.when(item13, made("BENEFICIARY_ITR", 0.95))
        .when(h.contains("schedule"), made("INCOME_SCHEDULE", 0.85))
        .when(h.contains("trust") & h.contains("return"), made("TRUST_RETURN", 0.85))
        .when(h.contains("distribution"), made("DISTRIBUTION_STMT", 0.85))
        .when(addressed & table, made("DISTRIBUTION_STMT", 0.9))
        .when(abn & (h.contains("trust") | h.contains("return")), made("TRUST_RETURN", 0.85))
        .otherwise(made("", 0.0))
    )


def by_substring(text: Column, mapping: tuple[tuple[str, str], ...], default: str) -> Column:
    """The value of the first key that the lower-cased text contains."""
    low, out = F.lower(text), None
    for key, value in mapping:
        out = F.when(low.contains(key), value) if out is None else out.when(low.contains(key), value)
    return F.lit(default) if out is None else out.otherwise(default)


def document_type(text: Column, mapping: tuple[tuple[str, str], ...], keywords: tuple[tuple[str, tuple[str, ...]], ...], fallback: str) -> Column:
    """(type, source): the first mapped text that an answer holds, else the first type with a keyword in it, else the fallback."""
    low = F.lower(F.trim(F.coalesce(text, F.lit(""))))
    out = F.struct(F.lit(fallback).alias("type"), F.lit("fallback").alias("source"))
    rules = [(k, t, "mapping") for k, t in mapping] + [(w, t, "keyword") for t, words in keywords for w in words]
    for part, kind, source in reversed(rules):
        out = F.when(low.contains(part.lower()), F.struct(F.lit(kind).alias("type"), F.lit(source).alias("source"))).otherwise(out)
    return out
