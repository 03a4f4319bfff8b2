"""Queries of node records, trust checks, classifier answers and business flags, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.functions.similarity import matching_ratio, nearly_equal
from ledgerloom.operators import answers, nodes, quality, trust
from ledgerloom.plans import queries_scores
from ledgerloom.plans.cases import flag_maps
from ledgerloom.plans.views import duck, view
from ledgerloom.streaming.header_cache import cached_batch

QUERIES: dict = {}
ORACLE: dict[str, str] = {}
# headers of the fixture and the roles that they tell
ROLES = {
    "date": ("date", "day"), "description": ("narrative", "details"), "debit": ("debit", "withdrawals", "dr"), "credit": ("credit", "deposits", "cr"), "balance": ("balance", "bal"),
    "odometer": ("odometer",), "purpose": ("purpose",), "gst": ("gst",), "unit_price": ("unit price",), "quantity": ("qty", "quantity"),
}


def query(sql: str | None):
    """Register a query under its function's name, with DuckDB SQL over the record views where there is any."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = duck(sql)
        return f

    return add


# --- trust cases from nodes --------------------------------------------------------------------
_PCT = lambda a, b: f"(CASE WHEN greatest(abs({a}), abs({b})) = 0 THEN 0 ELSE abs({a} - {b}) / greatest(abs({a}), abs({b}))::DOUBLE END)"
_D = {"ret": "trust_return", "ds": "distribution_stmt", "sched": "income_schedule", "itr": "beneficiary_itr"}
_WIDE = "w AS (SELECT c_custkey AS case_id, " + ", ".join(f"max({f}) FILTER (kind = '{k}') AS {f}_{d}" for d, k in _D.items() for f in ("abn", "tfn", "income", "franking", "cgt")) + " FROM customer LEFT JOIN trust_nodes ON case_id = c_custkey GROUP BY c_custkey)"
_AMT = lambda c: f"coalesce({c} || '.00', 'NOT_FOUND')"
_BARE = lambda c: f"nullif(replace(coalesce({c}, ''), ' ', ''), '')"
_KIND = f"""CASE WHEN income_itr < income_ds AND {_PCT('income_itr', 'income_ds')} > 0.01 THEN 1 WHEN franking_itr > franking_ds AND {_PCT('franking_itr', 'franking_ds')} > 0.01 THEN 2 WHEN cgt_ds > 0 AND cgt_sched = 0 THEN 3 WHEN {_PCT('income_ret', 'income_ds')} > 0.01 THEN 4 ELSE 0 END"""
_AGREE = lambda f, ds: f"(SELECT count(*) FILTER (x IS NOT NULL) < 2 OR coalesce(bool_and(CASE WHEN x IS NULL THEN true ELSE {_PCT('first_', 'x')} <= 0.01 END), true) FROM (SELECT unnest([{', '.join(f'{f}_{d}' for d in ds)}]) AS x, coalesce({', '.join(f'{f}_{d}' for d in ds)}) AS first_))"
_SAME = lambda f, ds: f"len(list_distinct(list_filter([{', '.join(_BARE(f'{f}_{d}') for d in ds)}], lambda x: x IS NOT NULL))) <= 1"
_CHECKED = f"""{_WIDE}, k AS (SELECT *, {_KIND} AS k FROM w),
    c AS (SELECT case_id, CASE WHEN abn_ds IS NULL THEN '' ELSE '51824753556' END AS "TRUST_ABN", coalesce({_BARE('tfn_ds')}, {_BARE('tfn_ret')}, {_BARE('tfn_sched')}, {_BARE('tfn_itr')}, '') AS "BENEFICIARY_TFN", {_AMT('income_ds')} AS "SHARE_OF_NET_INCOME", {_AMT('franking_ds')} AS "FRANKING_CREDIT", {_AMT('cgt_ds')} AS "CAPITAL_GAIN_COMPONENT",
      CASE WHEN k = 0 THEN 'compliant' ELSE 'non_compliant' END AS "COMPLIANCE_STATUS", ['none', 'under_reported_income', 'over_claimed_franking', 'missing_cgt', 'trust_return_mismatch'][k + 1] AS "DISCREPANCY_TYPE",
      CASE k WHEN 1 THEN 'ITR reports $' || income_itr || '.00 trust income but Distribution Statement shows $' || income_ds || '.00' WHEN 2 THEN 'ITR claims $' || franking_itr || '.00 franking credit but Distribution Statement shows $' || franking_ds || '.00'
        WHEN 3 THEN 'Distribution Statement shows $' || cgt_ds || '.00 capital gain but Income Schedule reports $0.00' WHEN 4 THEN 'Trust Return shows $' || income_ret || '.00 share but Distribution Statement shows $' || income_ds || '.00' ELSE 'none' END AS "DISCREPANCY_DETAILS",
      {_SAME('abn', ('ret', 'ds', 'sched'))} AS abn_agrees, {_SAME('tfn', _D)} AS tfn_agrees, {_AGREE('income', _D)} AS income_agrees, {_AGREE('franking', _D)} AS franking_agrees, {_AGREE('cgt', ('ret', 'ds', 'sched'))} AS cgt_agrees FROM k)"""


def _records(spark, sf_dir):
    """Each case with its nodes as a model wrote them: earlier tries of a node, nodes of other names, and cases without any."""
    t, itr = view(spark, sf_dir, "trust_nodes"), F.col("kind") == "beneficiary_itr"
    line = lambda name, v: F.when(v.isNotNull(), F.concat(F.lit("\n"), name, F.lit(": $"), v.cast("string"), F.lit(".00"))).otherwise("\n")
    pick = lambda a, b: F.when(itr, F.lit(a)).otherwise(F.lit(b))
    raw = F.concat(
        F.lit("Fields:\ntrust_abn: "), "abn", F.lit("\nBENEFICIARY_TFN: "), "tfn", line(pick("TOTAL_TRUST_INCOME", "SHARE_OF_NET_INCOME"), F.col("income")),
        line(pick("TRUST_FRANKING_CREDIT", "FRANKING_CREDIT"), F.col("franking")), line(F.lit("CAPITAL_GAIN_COMPONENT"), F.col("cgt")),
    )
    node = lambda key, text: F.struct(F.concat(F.lit("extract_"), key).alias("key"), text.alias("raw_response"))
    tries = F.array(node(F.col("kind"), F.lit("SHARE_OF_NET_INCOME: 1\nTRUST_ABN: 2")), node(F.lit("other"), F.lit("TRUST_ABN: 3")), node(F.col("kind"), raw))
    have = t.groupBy("case_id").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("kind", tries.alias("x")))), lambda p: p["x"])).alias("nodes"))
    return spark.read.parquet(f"{sf_dir}/customer.parquet").select(F.col("c_custkey").alias("case_id")).join(have, "case_id", "left")


@query(f"WITH {_CHECKED} SELECT * FROM c")
def tru2_par15_trust_checks(spark, sf_dir):
    return nodes.check_trust(_records(spark, sf_dir)).drop("nodes")


_NAMES = "['TRUST_ABN', 'BENEFICIARY_TFN', 'SHARE_OF_NET_INCOME', 'FRANKING_CREDIT', 'CAPITAL_GAIN_COMPONENT', 'COMPLIANCE_STATUS', 'DISCREPANCY_TYPE', 'DISCREPANCY_DETAILS']"
_VALUES = '["TRUST_ABN", "BENEFICIARY_TFN", "SHARE_OF_NET_INCOME", "FRANKING_CREDIT", "CAPITAL_GAIN_COMPONENT", "COMPLIANCE_STATUS", "DISCREPANCY_TYPE", "DISCREPANCY_DETAILS"]'


@query(f"WITH {_CHECKED} SELECT 'case' || case_id AS image_name, CASE WHEN case_id % 10 = 7 THEN 'unreadable' END AS error, x.f AS field, x.v AS value FROM c, (SELECT unnest(list_transform(range(1, 9), lambda i: {{'f': {_NAMES}[i], 'v': {_VALUES}[i]}})) AS x) WHERE case_id % 10 <> 7 UNION ALL SELECT 'case' || case_id, 'unreadable', NULL, NULL FROM c WHERE case_id % 10 = 7".replace("FROM c, (SELECT unnest(", "FROM c, LATERAL (SELECT unnest("))
def tru3_clean_trust(spark, sf_dir):
    case = F.col("case_id")
    error = F.when(case % 10 == 7, "unreadable").when(case % 10 == 8, "")
    records = _records(spark, sf_dir).select(F.concat(F.lit("case"), case).alias("image_name"), F.lit("trust").alias("document_type"), "nodes", F.lit(1.5).alias("processing_time"), error.alias("error"))
    return nodes.clean_trust(records).select("image_name", "error", F.explode_outer("extracted_data").alias("field", "value"))


@query("""WITH o AS (SELECT o_orderkey AS doc, o_orderkey % 4 AS v, o_orderpriority AS p, o_orderstatus AS s FROM orders)
    SELECT doc, u.k AS field, u.v AS value FROM o, LATERAL (SELECT unnest(CASE v WHEN 0 THEN [{'k': 'DOCUMENT_TYPE', 'v': 'INVOICE'}, {'k': 'SOURCE', 'v': 'probe'}, {'k': 'SUPPLIER_NAME', 'v': 'later ' || p}, {'k': 'TOTAL_2', 'v': s}]
      WHEN 1 THEN [{'k': 'DOCUMENT_TYPE', 'v': 'REPLACED'}, {'k': 'SOURCE', 'v': 'probe'}]
      WHEN 2 THEN [{'k': 'DOCUMENT_TYPE', 'v': 'INVOICE'}, {'k': 'SOURCE', 'v': 'probe'}, {'k': 'RECEIPT_DATE', 'v': 'NOT_FOUND | ' || p}, {'k': 'RECEIPT_DESCRIPTION', 'v': s}, {'k': 'RECEIPT_TOTAL', 'v': 'NOT_FOUND'}, {'k': 'BANK_TRANSACTION_DATE', 'v': 'NOT_FOUND'}, {'k': 'BANK_TRANSACTION_DESCRIPTION', 'v': 'NOT_FOUND'}, {'k': 'BANK_TRANSACTION_DEBIT', 'v': '5'}]
      ELSE [{'k': 'DOCUMENT_TYPE', 'v': 'INVOICE'}, {'k': 'SOURCE', 'v': 'probe'}, {'k': 'TRUST_ABN', 'v': p}, {'k': 'COMPLIANCE_STATUS', 'v': s}] END) AS u)""")
def rul24_final_fields(spark, sf_dir):
    p, s, v = F.col("o_orderpriority"), F.col("o_orderstatus"), F.col("o_orderkey") % 4
    m = lambda **kv: F.create_map(*[x for k, c in kv.items() for x in (F.lit(k), c)]).cast("map<string,string>")
    none, lists = F.lit(None).cast("map<string,string>"), "array<map<string,string>>"
    node = lambda key, parsed=none, blocks=F.lit(None): F.struct(F.lit(key).alias("key"), parsed.alias("parsed"), blocks.cast(lists).alias("blocks"))
    generic = F.array(node("a", m(SUPPLIER_NAME=p, _RAW=p, lower=p, TOTAL_2=F.lit("x"))), node("b"), node("c", m(SUPPLIER_NAME=F.concat(F.lit("later "), p), TOTAL_2=s)))
    replaced = F.array(node("a", m(DOCUMENT_TYPE=F.lit("REPLACED"))), node("b", m(NULL_VALUE=F.lit(None).cast("string"))))
    linked = F.array(
        node("match_to_statement", blocks=F.array(m(RECEIPT_STORE=F.lit("unchecked")))), node("extract_receipts", blocks=F.array(m(STORE=p), m(DATE=p))),
        node("validate_amounts", blocks=F.array(m(RECEIPT_STORE=p))), node("validate_amounts", blocks=F.array(m(RECEIPT_STORE=s, TRANSACTION_AMOUNT=F.lit("5")))),
    )
    checked = F.array(node("a", m(SUPPLIER_NAME=p)), node("validate_compliance", m(TRUST_ABN=p, COMPLIANCE_STATUS=s, OTHER=p)))
    parts = F.when(v == 0, generic).when(v == 1, replaced).when(v == 2, linked).otherwise(checked)
    fields = nodes.final_fields(F.lit("INVOICE"), m(SOURCE=F.lit("probe")), parts)
    return spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.col("o_orderkey").alias("doc"), F.explode(fields).alias("field", "value"))


@query(f"""SELECT count(*) AS cases, count(*) FILTER (errored) AS errors, round(avg(abn_right::INT), 6) AS abn_accuracy, round(avg(income_right::INT), 6) AS income_accuracy, round(avg(franking_right::INT), 6) AS franking_accuracy, round(avg(cgt_right::INT), 6) AS cgt_accuracy,
    round(avg((abn_right AND income_right AND franking_right AND cgt_right)::INT), 6) AS all_right, round(count(*) / 45.0::DOUBLE * 60, 6) AS per_minute FROM {queries_scores._TRUST}""")
def agg10_trust_summary(spark, sf_dir):
    d = view(spark, sf_dir, "trust_docs")
    return trust.case_summary(trust.evaluate_cases(d.filter("kind = 'income_schedule'"), d.filter("kind = 'distribution_stmt'")), 45.0)


# --- answers ---------------------------------------------------------------------------------
@query("""SELECT doc, CASE WHEN v IN (6, 7, 9) THEN NULL ELSE [5, 0, 4, 0, 0, 0, NULL, NULL, 4, NULL, 3][v + 1] END::BIGINT AS headers, CASE WHEN v NOT IN (6, 7, 9) THEN v IN (1, 4) END AS paid, CASE WHEN v NOT IN (6, 7, 9) THEN v IN (3, 4) END AS travel, CASE WHEN v NOT IN (6, 7, 9) THEN coalesce([12, 3, 0, 0, 0, 0, 0, 0, 21, 0, 5][v + 1], 0) END::BIGINT AS rows,
    ['BANK_STATEMENT', 'RECEIPT', 'BANK_STATEMENT', 'TRAVEL', 'TRAVEL', 'INVOICE', NULL, NULL, 'INVOICE', NULL, 'LOGBOOK'][v + 1] AS kind, ['MEDIUM', 'LOW', 'LOW', 'LOW', 'LOW', 'LOW', NULL, NULL, 'HIGH', NULL, 'LOW'][v + 1] AS tier, CASE WHEN v NOT IN (6, 7, 9) THEN 'evidence' END AS source FROM (SELECT doc, doc % 11 AS v FROM answer_texts)""")
def par11_classification_answers(spark, sf_dir):
    a = answers.classification(view(spark, sf_dir, "answer_texts"), "raw", ROLES).drop("raw")
    return a.withColumns({"headers": F.when(F.col("headers").isNotNull(), F.size("headers").cast("long")), "rows": F.col("rows").cast("long")})


@query("""SELECT doc, ['TRUST_RETURN', 'INCOME_SCHEDULE', 'DISTRIBUTION_STMT', 'BENEFICIARY_ITR', 'BENEFICIARY_ITR', 'UNKNOWN_TRUST_DOC', 'TRUST_RETURN', 'DISTRIBUTION_STMT', 'TRUST_RETURN'][v + 1] AS kind, [0.85, 0.85, 0.9, 0.95, 0.5, 0.3, 0.85, 0.85, 0.5][v + 1]::DOUBLE AS confidence,
    ['evidence', 'evidence', 'evidence', 'evidence', 'keyword', 'none', 'evidence', 'evidence', 'keyword'][v + 1] AS source, ['Trust Income Tax Return', 'Income Schedule 2024', 'Notice', NULL, NULL, NULL, 'The Smith Trust', 'Beneficiary Distribution', NULL][v + 1] AS header, [3, 2, 3, 1, 0, 0, 2, 2, 1][v + 1]::BIGINT AS n FROM (SELECT doc, doc % 9 AS v FROM trust_answers)""")
def par12_rul10_trust_answers(spark, sf_dir):
    a, e = answers.trust_answer(F.col("raw")), answers.trust_evidence(F.col("raw"))
    return view(spark, sf_dir, "trust_answers").select("doc", *[a[k].alias(k) for k in ("kind", "confidence", "source")], F.try_element_at(e, F.lit("HEADER")).alias("header"), F.size(e).cast("long").alias("n"))


# --- business checks ---------------------------------------------------------------------------
_NUM = lambda x: f"TRY_CAST(regexp_replace({x}, '[^0-9.-]', '', 'g') AS DOUBLE)"
_SPLIT = lambda f: f"list_transform(string_split({f}, '|'), lambda x: trim(x))"
_FIELDS = ("LINE_ITEM_PRICES", "LINE_ITEM_TOTAL_PRICES", "LINE_ITEM_QUANTITIES", "GST_AMOUNT", "SUBTOTAL_AMOUNT", "TOTAL_AMOUNT", "IS_GST_INCLUDED", "DOCUMENT_TYPE", "LINE_ITEM_DESCRIPTIONS", "TRANSACTION_DATES", "TRANSACTION_AMOUNTS_PAID")


@query(f"""WITH f AS (SELECT doc, {', '.join(f"coalesce(max(value) FILTER (field = '{f}'), 'NOT_FOUND') AS {f}" for f in _FIELDS)} FROM flag_fields GROUP BY doc),
    g AS (SELECT *, list_transform({_SPLIT('LINE_ITEM_PRICES')}, lambda x: {_NUM('x')}) AS p, list_transform({_SPLIT('LINE_ITEM_TOTAL_PRICES')}, lambda x: {_NUM('x')}) AS t, list_transform({_SPLIT('LINE_ITEM_QUANTITIES')}, lambda x: TRY_CAST(x AS DOUBLE)) AS q, {_NUM('GST_AMOUNT')} AS tax, {_NUM('SUBTOTAL_AMOUNT')} AS sub, {_NUM('TOTAL_AMOUNT')} AS tot, lower(IS_GST_INCLUDED) AS inc FROM f),
    h AS (SELECT *, LINE_ITEM_PRICES <> 'NOT_FOUND' AND LINE_ITEM_TOTAL_PRICES <> 'NOT_FOUND' AND LINE_ITEM_QUANTITIES <> 'NOT_FOUND' AND len(p) = len(t) AND len(p) = len(q) AS fits, tax IS NOT NULL AND sub IS NOT NULL AND tot IS NOT NULL AS taxed, contains(upper(DOCUMENT_TYPE), 'BANK') OR contains(upper(DOCUMENT_TYPE), 'STATEMENT') AS bank FROM g)
    SELECT doc, CASE WHEN fits THEN array_to_string(list_filter(range(1, len(p) + 1), lambda i: coalesce(p[i] <> 0 AND t[i] <> 0 AND q[i] <> 0 AND abs(t[i] - p[i] * q[i]) > p[i] * q[i] * 0.01, false)), ',') END AS items_off,
      CASE WHEN taxed AND inc = 'true' THEN abs(tax - tot / 11) > 0.02 WHEN taxed AND inc = 'false' THEN abs(tot - sub - tax) > 0.02 END AS tax_off, CASE WHEN taxed THEN inc NOT IN ('true', 'false') END AS tax_unclear,
      CASE WHEN bank THEN len(list_distinct(list_filter([CASE WHEN LINE_ITEM_DESCRIPTIONS <> 'NOT_FOUND' THEN len(list_filter({_SPLIT('LINE_ITEM_DESCRIPTIONS')}, lambda x: x <> '')) END, CASE WHEN TRANSACTION_DATES <> 'NOT_FOUND' THEN len(list_filter({_SPLIT('TRANSACTION_DATES')}, lambda x: x <> '')) END,
        CASE WHEN TRANSACTION_AMOUNTS_PAID <> 'NOT_FOUND' THEN len(list_filter({_SPLIT('TRANSACTION_AMOUNTS_PAID')}, lambda x: x <> '')) END], lambda x: x IS NOT NULL))) > 1 END AS counts_differ FROM h""")
def str20_business_flags(spark, sf_dir):
    docs = flag_maps(spark, sf_dir)
    flags = quality.business_flags(F.col("fields"))
    flags["items_off"] = F.when(flags["items_off"].isNotNull(), F.array_join(F.transform(flags["items_off"], lambda i: i.cast("string")), ","))
    return docs.select("doc", *[c.alias(k) for k, c in flags.items()])


# --- likeness and caches -----------------------------------------------------------------------
@query(None)  # recursive over blocks: tested against the standard library
def str9_matching_ratio(spark, sf_dir):
    t = view(spark, sf_dir, "item_pairs")
    return t.select("doc", "pos", F.round(matching_ratio(F.col("got"), F.col("want")), 6).alias("ratio"), nearly_equal(F.col("got"), F.col("want")).alias("alike"))


@query("""WITH d AS (SELECT c_custkey AS position, 'in/' || CASE WHEN c_custkey % 7 = 0 THEN 'page' ELSE 'bank' || c_nationkey END || '_' || c_custkey || '.png' AS image_path, CASE WHEN c_custkey % 7 <> 0 THEN 'bank' || c_nationkey END AS institution, CASE WHEN c_custkey % 5 <> 0 THEN c_mktsegment END AS mapping FROM customer),
    f AS (SELECT institution, min(position) AS p, arg_min(mapping, position) AS m FROM d WHERE mapping IS NOT NULL AND institution IS NOT NULL GROUP BY institution)
    SELECT position, image_path, d.institution, CASE WHEN coalesce(position > p, false) THEN m ELSE mapping END AS mapping, coalesce(position > p, false) AS cached FROM d LEFT JOIN f ON f.institution = d.institution""")
def jn17_stm4_header_cache(spark, sf_dir):
    c = spark.read.parquet(f"{sf_dir}/customer.parquet")
    key = F.col("c_custkey")
    name = F.concat(F.lit("in/"), F.when(key % 7 == 0, "page").otherwise(F.concat(F.lit("bank"), "c_nationkey")), F.lit("_"), key, F.lit(".png"))
    return cached_batch(c.select(key.alias("position"), name.alias("image_path"), F.when(key % 5 != 0, F.col("c_mktsegment")).alias("mapping")), r"^(bank\d+)_")
