"""Records with a list of nodes (key, raw_response): the state that they make, final fields, and trust cases checked from it.

Of nodes with one key the last counts.  Null lists, null responses and responses without any field give an empty state, never
an error.  Merged fields keep upper-case keys that do not begin with an underscore; later nodes win.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.money import all_agree, canonical_abn, normal_id, parse_bracketed, pct_diff
from ledgerloom.functions.text import MISSING
from ledgerloom.operators.parsers import key_values

# The nodes of a trust case, and the fields that a checked case or a linked one ends with.
TRUST_NODES = {"ret": "extract_trust_return", "ds": "extract_distribution_stmt", "sched": "extract_income_schedule", "itr": "extract_beneficiary_itr"}
CHECKED = ("TRUST_ABN", "BENEFICIARY_TFN", "SHARE_OF_NET_INCOME", "FRANKING_CREDIT", "CAPITAL_GAIN_COMPONENT", "COMPLIANCE_STATUS", "DISCREPANCY_TYPE", "DISCREPANCY_DETAILS")
LINKED = {
    "RECEIPT_DATE": ("receipts", "DATE"), "RECEIPT_DESCRIPTION": ("matches", "RECEIPT_STORE"), "RECEIPT_TOTAL": ("matches", "RECEIPT_TOTAL"),
    "BANK_TRANSACTION_DATE": ("matches", "TRANSACTION_DATE"), "BANK_TRANSACTION_DESCRIPTION": ("matches", "TRANSACTION_DESCRIPTION"), "BANK_TRANSACTION_DEBIT": ("matches", "TRANSACTION_AMOUNT"),
}
_MAP = "map<string,string>"


def node_state(nodes: Column, keys: tuple[str, ...]) -> Column:
    """A map of each known node's key to the fields of its last response."""
    known = F.filter(F.coalesce(nodes, F.array().cast("array<struct<key:string,raw_response:string>>")), lambda n: n["key"].isin(*keys))
    last = F.filter(known, lambda n, i: ~F.exists(F.slice(known, i + 2, F.size(known)), lambda m: m["key"] == n["key"]))
    return F.map_from_entries(F.transform(last, lambda n: F.struct(n["key"].alias("key"), key_values(F.coalesce(n["raw_response"], F.lit(""))).alias("value"))))


def _merged(base: Column, more: Column) -> Column:
    """Both maps; on a key that both have ``more`` wins."""
    return F.map_concat(F.map_filter(base, lambda k, v: ~F.map_contains_key(more, k)), more)


def final_fields(doc_type: Column, extra: Column, nodes: Column) -> Column:
    """The flat fields of a record from its nodes (key, parsed, blocks).

    A checked trust case gives the checked fields alone; a linked one the pipe lists of its receipts and of its matches (checked
    ones first); any other the fields of all nodes.
    """
    parsed = lambda n: F.map_filter(F.coalesce(n["parsed"], F.create_map().cast(_MAP)), lambda k, v: (k == F.upper(k)) & k.rlike("[A-Z]") & ~k.startswith("_") & v.isNotNull())
    of = lambda key: F.try_element_at(F.filter(nodes, lambda n: n["key"] == key), F.lit(-1))
    base = _merged(F.create_map(F.lit("DOCUMENT_TYPE"), doc_type).cast(_MAP), F.coalesce(extra, F.create_map().cast(_MAP)))
    checked, validated, matched, receipts = (of(k) for k in ("validate_compliance", "validate_amounts", "match_to_statement", "extract_receipts"))
    none = F.array().cast(f"array<{_MAP}>")
    lists = {"matches": F.coalesce(F.when(validated.isNotNull(), F.coalesce(validated["blocks"], none)).otherwise(matched["blocks"]), none), "receipts": F.coalesce(receipts["blocks"], none)}
    joined = F.create_map(*[x for f, (side, key) in LINKED.items() for x in (F.lit(f), F.array_join(F.transform(lists[side], lambda m: F.coalesce(F.try_element_at(m, F.lit(key)), F.lit(MISSING))), " | "))])
    every = F.aggregate(F.coalesce(nodes, F.array()), base, lambda acc, n: _merged(acc, parsed(n)))
    only = F.map_filter(F.coalesce(checked["parsed"], F.create_map().cast(_MAP)), lambda k, v: k.isin(*CHECKED))
    return F.when(checked.isNotNull(), _merged(base, only)).when(validated.isNotNull() | matched.isNotNull(), _merged(base, joined)).otherwise(every)


def check_trust(records: DataFrame, nodes: str = "nodes", tolerance: float = 0.01) -> DataFrame:
    """Adds the eight checked fields and whether each linking value agrees over the documents that have it."""
    df = records.withColumn("_state", node_state(F.col(nodes), tuple(TRUST_NODES.values())))
    raw = lambda doc, field: F.try_element_at(F.try_element_at("_state", F.lit(TRUST_NODES[doc])), F.lit(field))
    own = {"income": "SHARE_OF_NET_INCOME", "franking": "FRANKING_CREDIT", "cgt": "CAPITAL_GAIN_COMPONENT"}
    theirs = {"income": "TOTAL_TRUST_INCOME", "franking": "TRUST_FRANKING_CREDIT"}
    df = df.withColumns({f"_{k}_{d}": parse_bracketed(raw(d, theirs[k] if d == "itr" else f)) for k, f in own.items() for d in TRUST_NODES if not (d == "itr" and k == "cgt")})
    df = df.withColumns({f"_{k}_{d}": normal_id(raw(d, f)) for k, f in (("abn", "TRUST_ABN"), ("tfn", "BENEFICIARY_TFN")) for d in TRUST_NODES if not (k == "abn" and d == "itr")})
    v = lambda k, d: F.col(f"_{k}_{d}")
    money = lambda c: F.concat(F.lit("$"), c.cast("decimal(18,2)").cast("string"))
    said = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else money(p) for p in parts])
    apart = lambda a, b: pct_diff(a, b) > tolerance
    found = (
        ((v("income", "itr") < v("income", "ds")) & apart(v("income", "itr"), v("income", "ds")), "under_reported_income", said("ITR reports ", v("income", "itr"), " trust income but Distribution Statement shows ", v("income", "ds"))),
        ((v("franking", "itr") > v("franking", "ds")) & apart(v("franking", "itr"), v("franking", "ds")), "over_claimed_franking", said("ITR claims ", v("franking", "itr"), " franking credit but Distribution Statement shows ", v("franking", "ds"))),
        ((v("cgt", "ds") > 0) & (v("cgt", "sched") == 0), "missing_cgt", said("Distribution Statement shows ", v("cgt", "ds"), " capital gain but Income Schedule reports $0.00")),
        (apart(v("income", "ret"), v("income", "ds")), "trust_return_mismatch", said("Trust Return shows ", v("income", "ret"), " share but Distribution Statement shows ", v("income", "ds"))),
    )
    kind, details = F.lit("none"), F.lit("none")
    for test, name, text in reversed(found):
        kind, details = F.when(test, name).otherwise(kind), F.when(test, text).otherwise(details)
    plain = lambda c: F.coalesce(c.cast("decimal(18,2)").cast("string"), F.lit(MISSING))
    docs = lambda k: [v(k, d) for d in TRUST_NODES if f"_{k}_{d}" in df.columns]
    one = lambda k: F.size(F.array_distinct(F.filter(F.array(*docs(k)), lambda x: x != ""))) <= 1
    agree = lambda k: all_agree(F.array(*docs(k)), tolerance)
    tfn = F.coalesce(*[F.nullif(v("tfn", d), F.lit("")) for d in ("ds", "ret", "sched", "itr")], F.lit(""))
    out = df.withColumns({
        "TRUST_ABN": canonical_abn(v("abn", "ds"), v("abn", "ret"), v("abn", "sched")), "BENEFICIARY_TFN": tfn, "SHARE_OF_NET_INCOME": plain(v("income", "ds")), "FRANKING_CREDIT": plain(v("franking", "ds")),
        "CAPITAL_GAIN_COMPONENT": plain(v("cgt", "ds")), "DISCREPANCY_TYPE": kind, "DISCREPANCY_DETAILS": details,
        "abn_agrees": one("abn"), "tfn_agrees": one("tfn"), "income_agrees": agree("income"), "franking_agrees": agree("franking"), "cgt_agrees": agree("cgt"),
    })
    out = out.withColumn("COMPLIANCE_STATUS", F.when(F.col("DISCREPANCY_TYPE") == "none", "compliant").otherwise("non_compliant"))
    return out.drop(*[c for c in out.columns if c.startswith("_")])


def clean_trust(records: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """Records (image_name, document_type, nodes, processing_time, error) as (…, extracted_data): the checked fields of a case, an
    empty map for records that already have an error."""
    done = check_trust(records, "nodes", tolerance)
    fields = F.create_map(*[x for f in CHECKED for x in (F.lit(f), F.col(f))])
    failed = F.col("error").isNotNull() & (F.col("error") != "")
    kept = [F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("image_name", "document_type")]
    return done.select(*kept, F.when(failed, F.create_map().cast(_MAP)).otherwise(fields).alias("extracted_data"), F.coalesce("processing_time", F.lit(0.0)).alias("processing_time"), F.when(failed, F.col("error")).alias("error"))
