"""Queries of schema projection, aligned models, seeded copies, prompts, manifests and handled responses, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.functions import text
from ledgerloom.operators import projection, responses, rules
from ledgerloom.plans.views import duck, view

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str):
    """Register a query under its function's name, with DuckDB SQL over the record views."""

    def add(f):
        QUERIES[f.__name__] = f
        ORACLE[f.__name__] = duck(sql)
        return f

    return add


_SCHEMA = {"invoice": ("SUPPLIER", "TOTAL_AMOUNT", "IS_GST_INCLUDED", "INVOICE_DATE"), "receipt": ("TOTAL_AMOUNT", "PAYER_NAME")}
_KIND = "CASE doc % 3 WHEN 0 THEN 'Invoice' WHEN 1 THEN 'receipt' ELSE 'memo' END"
_DOLLARS = "array_to_string(list_transform(string_split(t, '|'), lambda x: CASE WHEN upper(trim(x)) = 'NOT_FOUND' OR starts_with(trim(x), '$') THEN trim(x) ELSE '$' || trim(x) END), ' | ')"


@query(f"""WITH d AS (SELECT doc, {_KIND} AS kind, max(value) FILTER (field = 'SUPPLIER_NAME') AS s, max(CASE WHEN doc % 2 = 0 THEN value || '|NOT_FOUND| $3' ELSE value END) FILTER (field = 'TOTAL_AMOUNT') AS t, max(value) FILTER (field = 'PAYER_NAME') AS p, max(upper(value)) FILTER (field = 'IS_GST_INCLUDED') AS g FROM gt_fields GROUP BY doc)
    SELECT doc, 'SUPPLIER' AS field, s AS value FROM d WHERE kind = 'Invoice' UNION ALL SELECT doc, 'TOTAL_AMOUNT', {_DOLLARS} FROM d WHERE kind <> 'memo' UNION ALL SELECT doc, 'IS_GST_INCLUDED', lower(g) FROM d WHERE kind = 'Invoice'
    UNION ALL SELECT doc, 'INVOICE_DATE', 'NOT_FOUND' FROM d WHERE kind = 'Invoice' UNION ALL SELECT doc, 'PAYER_NAME', CASE WHEN doc % 7 = 0 THEN 'NOT_FOUND' ELSE p END FROM d WHERE kind = 'receipt'""")
def prj2_projected_records(spark, sf_dir):
    return _projected(spark, sf_dir).filter("projected IS NOT NULL").select("doc", F.explode("projected").alias("field", "value"))


def _projected(spark, sf_dir):
    k, f = F.col("doc"), F.col("field")
    value = F.when((f == "TOTAL_AMOUNT") & (k % 2 == 0), F.concat("value", F.lit("|NOT_FOUND| $3"))).when(f == "IS_GST_INCLUDED", F.upper("value")).when((f == "PAYER_NAME") & (k % 7 == 0), " ").otherwise(F.col("value"))
    docs = view(spark, sf_dir, "gt_fields").withColumn("value", value).groupBy("doc").agg(F.map_from_entries(F.collect_list(F.struct("field", "value"))).alias("fields"))
    kind = F.when(k % 3 == 0, "Invoice").when(k % 3 == 1, "receipt").otherwise("memo")
    return projection.project(docs.withColumn("doc_type", kind), _SCHEMA, {"SUPPLIER_NAME": "SUPPLIER"}, ("TOTAL_AMOUNT",), ("IS_GST_INCLUDED",))


@query(f"SELECT {_KIND} AS doc_type, count(*) AS skipped FROM (SELECT DISTINCT doc FROM gt_fields) WHERE doc % 3 = 2 GROUP BY 1")
def prj1_unknown_types(spark, sf_dir):
    return projection.unknown_types(_projected(spark, sf_dir))


@query("""WITH m AS (SELECT field, model, round(avg(f1), 6) AS s FROM runs GROUP BY ALL), s AS (SELECT unnest(['field_0', 'field_1', 'field_2', 'other']) AS field, unnest(['id', 'text', 'text', 'id']) AS category, unnest([true, false, false, true]) AS critical)
    SELECT s.*, a.s AS x, b.s AS y, round(a.s - b.s, 6) AS difference, (a.s IS NULL) <> (b.s IS NULL) AS exclusive FROM s LEFT JOIN m a ON a.field = s.field AND a.model = 'alpha' LEFT JOIN m b ON b.field = s.field AND b.model = 'beta' AND b.field <> 'field_1'""")
def jn18_aligned_models(spark, sf_dir):
    schema = spark.createDataFrame([("field_0", "id", True), ("field_1", "text", False), ("field_2", "text", False), ("other", "id", True)], "field string, category string, critical boolean")
    means = view(spark, sf_dir, "runs").groupBy("model", "field").agg(F.round(F.avg("f1"), 6).alias("score"))
    return projection.align_models(schema, means.filter("model = 'alpha'"), means.filter("model = 'beta' AND field <> 'field_1'"))


@query("SELECT count(*) FILTER (o_custkey % 2 = 0 AND o_custkey IN (SELECT c_custkey FROM customer)) AS kept, count(*) FILTER (NOT (o_custkey % 2 = 0 AND o_custkey IN (SELECT c_custkey FROM customer))) AS skipped FROM orders")
def jn20_scored_and_skipped(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", F.col("o_custkey").alias("stem"))
    truth = spark.read.parquet(f"{sf_dir}/customer.parquet").filter("c_custkey % 2 = 0").select(F.col("c_custkey").alias("stem"))
    return projection.scored_only(orders, truth, "stem")[1]


_U = lambda what, i: f"('0x' || substr(md5('7|' || doc || '|' || field || '|' || {i} || '|{what}'), 1, 7))::BIGINT / 268435456.0::DOUBLE"
_WRONG = lambda x, i: f"""CASE WHEN {x} = 'NOT_FOUND' THEN {x} WHEN {_U('kind', i)} < 0.35 THEN 'NOT_FOUND' WHEN regexp_matches({x}, '^\\d{{2}}/\\d{{2}}/\\d{{4}}$') THEN lpad((TRY_CAST(substr({x}, 1, 2) AS INT) % 28 + 1)::VARCHAR, 2, '0') || substr({x}, 3)
    WHEN regexp_matches({x}, '^-?[\\d,]+\\.\\d{{2}}$') THEN round(TRY_CAST(replace({x}, ',', '') AS DECIMAL(18,2)) * CASE WHEN {_U('much', i)} < 1 / 3.0::DOUBLE THEN 0.1::DECIMAL(4,1) WHEN {_U('much', i)} < 2 / 3.0::DOUBLE THEN 1.1::DECIMAL(4,1) ELSE 10.0::DECIMAL(4,1) END, 2)::DECIMAL(18,2)::VARCHAR
    WHEN contains({x}, ' ') THEN regexp_replace({x}, '\\s+\\S+$', '') WHEN length({x}) > 3 THEN substr({x}, 1, length({x}) - 1) ELSE 'UNKNOWN' END"""  # noqa: E731


@query(f"""WITH v AS (SELECT doc, field, value FROM gt_fields UNION ALL SELECT doc, field, replace(want, ' | ', '|') FROM register_lists)
    SELECT doc, field, CASE WHEN value = 'NOT_FOUND' THEN value WHEN contains(value, '|') THEN coalesce(nullif(array_to_string(list_filter(list_transform(range(0, len(string_split(value, '|'))), lambda i: CASE WHEN {_U('hit', 'i')} >= 0.4 THEN string_split(value, '|')[i + 1] WHEN {_U('drop', 'i')} < 0.15 THEN NULL ELSE {_WRONG("string_split(value, '|')[i + 1]", 'i')} END), lambda x: x IS NOT NULL), '|'), ''), 'NOT_FOUND')
      WHEN {_U('hit', '0')} < 0.3 THEN {_WRONG('value', '0')} ELSE value END AS wrong FROM v""")
def syn1_seeded_copies(spark, sf_dir):
    lists = view(spark, sf_dir, "register_lists").select("doc", "field", F.replace("want", F.lit(" | "), F.lit("|")).alias("value"))
    return projection.perturbed(view(spark, sf_dir, "gt_fields").unionByName(lists), 0.3, 0.4, seed=7).drop("value")


@query("""SELECT case_id, rid, 'Statement. ' || CASE case_id % 4 WHEN 0 THEN 'The bank statement contains a table with columns (left to right): ''Date'', ''Debit'', ''Credit'', ''Balance''.' || chr(10) || '  Withdrawals/debits appear in the ''Debit'' column; deposits/credits appear in the ''Credit'' column. Running balance is in the ''Balance'' column.'
      WHEN 1 THEN 'The bank statement contains a table with columns (left to right): ''Date'', ''Amount''.' || chr(10) || '  Amounts appear in the ''Amount'' column (negative values are debits, positive are credits).' WHEN 2 THEN 'The bank statement contains a table of transactions.'
      ELSE 'The bank statement contains a table with columns for Date, Description,' || chr(10) || '  and Amount (Debit/Credit or a single Amount column).' END || chr(10) || 'Receipt: ' || supplier || ', ' || coalesce(strftime(receipt_date, '%d/%m/%Y'), 'NOT_FOUND') || ', ' || coalesce(total::DECIMAL(18,2)::VARCHAR, 'NOT_FOUND') AS prompt FROM receipts""")
def lnk3_prompts(spark, sf_dir):
    k = F.col("case_id") % 4
    named = lambda *h: F.array(*map(F.lit, h)).cast("array<string>")
    headers = F.when(k == 0, named("Date", "Debit", "Credit", "Balance")).when(k == 1, named("Date", "Amount")).when(k == 2, F.array().cast("array<string>"))
    roles = {"debit": F.when(k == 0, "Debit"), "credit": F.when(k == 0, "Credit"), "balance": F.when(k == 0, "Balance"), "amount": F.when(k == 1, "Amount")}
    prompt = projection.link_prompt("Statement. {bank_column_context}\n", "Receipt: {receipt_store}, {receipt_date}, {receipt_total}", projection.column_context(headers, roles), F.col("supplier"), F.col("receipt_date"), F.col("total"))
    return view(spark, sf_dir, "receipts").select("case_id", "rid", prompt.alias("prompt"))


@query("SELECT CASE WHEN c_custkey % 9 = 0 THEN '_ungrouped' ELSE 'CASE' || c_custkey END AS case_id, 'r' || c_custkey AS trust_return, CASE WHEN c_custkey % 9 = 0 THEN 'dist' ELSE 'case' || c_custkey || '_dist' END || '.png' AS distribution_stmt, 's' || c_custkey AS income_schedule, CASE WHEN c_custkey % 4 <> 0 THEN 'b' || c_custkey END AS beneficiary_itr FROM customer")
def tru4_manifest(spark, sf_dir):
    k = F.col("c_custkey")
    at = lambda p: F.concat(F.lit(p), k)
    entry = F.create_map(F.lit("trust_return"), at("r"), F.lit("trust_income_schedule"), at("s"), F.lit("beneficiary_itr"), F.when(k % 4 != 0, at("b")))
    name = F.when(k % 9 == 0, "dist.png").otherwise(F.concat(F.lit("case"), k, F.lit("_dist.png")))
    return projection.manifest(spark.read.parquet(f"{sf_dir}/customer.parquet").select(name.alias("distribution_stmt"), entry.alias("entry")))


@query("""SELECT doc, CASE WHEN v = 0 THEN 'BANK_STATEMENT' WHEN v IN (1, 3, 8, 10) THEN 'RECEIPT' WHEN v IN (2, 4) THEN 'TRAVEL' ELSE 'UNIVERSAL' END AS type, CASE WHEN v IN (0, 6) THEN 'mapping' WHEN v IN (1, 2, 3, 4, 8, 10) THEN 'keyword' ELSE 'fallback' END AS source FROM (SELECT doc, doc % 11 AS v FROM answer_texts)
    """.replace("WHEN v = 0 THEN 'BANK_STATEMENT' WHEN v IN (1, 3, 8, 10) THEN 'RECEIPT' WHEN v IN (2, 4) THEN 'TRAVEL' ELSE", "WHEN v = 6 THEN 'INVOICE' WHEN v = 0 THEN 'BANK_STATEMENT' WHEN v IN (2, 3, 4, 10) THEN 'TRAVEL' WHEN v IN (1, 8) THEN 'RECEIPT' ELSE"))
def rul4_rul5_mapped_types(spark, sf_dir):
    kind = rules.document_type(F.col("raw"), (("Tax Invoice", "INVOICE"), ("narrative", "BANK_STATEMENT")), (("TRAVEL", ("travel", "ticket")), ("RECEIPT", ("paid",))), "UNIVERSAL")
    return view(spark, sf_dir, "answer_texts").select("doc", kind["type"].alias("type"), kind["source"].alias("source"))


@query("""SELECT doc, max(value) FILTER (field = 'SUPPLIER_NAME') AS supplier, '$' || max(value) FILTER (field = 'TOTAL_AMOUNT') AS total, '1 | 2' AS quantities, CASE WHEN doc % 2 = 0 THEN '2' END AS items_off FROM gt_fields GROUP BY doc""")
def par16_handled_responses(spark, sf_dir):
    line = F.concat(F.lit("**"), F.col("field"), F.lit(":** "), F.when(F.col("field") == "TOTAL_AMOUNT", F.concat(F.lit("$"), "value")).otherwise(F.col("value")))
    docs = view(spark, sf_dir, "gt_fields").filter("field IN ('SUPPLIER_NAME', 'TOTAL_AMOUNT')").groupBy("doc").agg(F.array_join(F.array_sort(F.collect_list(line)), "\n").alias("own"))
    totals = F.when(F.col("doc") % 2 == 0, "$2.00 | $9.00").otherwise("$2.00 | $6.00")
    raw = F.concat(F.lit("Here is the answer\n"), "own", F.lit("\nLINE_ITEM_QUANTITIES:\n* 1x\n* 2 EACH\nLINE_ITEM_PRICES: $2.00 | $3.00\nLINE_ITEM_TOTAL_PRICES: "), totals)
    done = responses.handle(docs.select("doc", raw.alias("raw")), "raw", ("SUPPLIER_NAME", "TOTAL_AMOUNT", "LINE_ITEM_QUANTITIES", "LINE_ITEM_PRICES", "LINE_ITEM_TOTAL_PRICES"))
    of = lambda f: F.element_at("fields", f)
    off = F.nullif(F.array_join(F.transform("items_off", lambda i: i.cast("string")), ","), F.lit(""))
    return done.select("doc", of("SUPPLIER_NAME").alias("supplier"), of("TOTAL_AMOUNT").alias("total"), of("LINE_ITEM_QUANTITIES").alias("quantities"), off.alias("items_off"))


@query("""WITH l AS (SELECT case_id, list(supplier ORDER BY rid) FILTER (WHERE rid % 2 = 1) AS s, list(coalesce(total::DECIMAL(18,2)::VARCHAR, 'NOT_FOUND') ORDER BY rid) AS t FROM receipts GROUP BY case_id)
    SELECT case_id, i AS idx, CASE WHEN len(s) > 0 THEN s[least(i + 1, len(s))] END AS store, t[i + 1] AS total FROM (SELECT case_id, coalesce(s, []) AS s, t, unnest(range(0, len(t))) AS i FROM l)""")
def arr2_receipts_of_images(spark, sf_dir):
    """Several receipts of one image as parallel pipe lists; a store list that is too short goes on with its last one."""
    piped = lambda c, test: F.array_join(F.transform(F.array_sort(F.collect_list(F.when(test, F.struct("rid", c.alias("x"))))), lambda r: r["x"]), " | ")
    total = F.coalesce(F.col("total").cast("decimal(18,2)").cast("string"), F.lit(text.MISSING))
    lists = view(spark, sf_dir, "receipts").groupBy("case_id").agg(piped(F.col("supplier"), F.col("rid") % 2 == 1).alias("stores"), piped(total, F.lit(True)).alias("totals"))
    stores = text.split_items(F.col("stores"))
    each = lists.select("case_id", stores.alias("s"), F.posexplode(text.split_items(F.col("totals"))).alias("i", "total"))
    return each.select("case_id", F.col("i").cast("long").alias("idx"), F.when(F.size("s") > 0, F.get("s", F.least(F.col("i"), F.size("s") - 1))).alias("store"), "total")
