"""Queries of the response readers: statements, blocks, cut JSON and answers, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.functions.arrays import each
from ledgerloom.operators import blocks, statements
from ledgerloom.plans.queries_records import duck
from ledgerloom.plans.views import view

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str):
    """Register a query under its function's name, with DuckDB SQL over the record views."""

    def add(f):
        QUERIES[f.__name__] = f
        ORACLE[f.__name__] = duck(sql)
        return f

    return add


def texts(spark, sf_dir, name):
    """The lines of a view (doc, i, line) as one text a document."""
    lines = F.transform(F.array_sort(F.collect_list(F.struct("i", "line"))), lambda x: x["line"])
    return view(spark, sf_dir, name).groupBy("doc").agg(F.array_join(lines, "\n").alias("raw"))


# --- statements ------------------------------------------------------------------------------
def statement_sql(form: str, columns: dict[str, str]) -> str:
    """The line machine as a recursive query: one step a line, and a row whenever the row before it is closed."""
    strip = lambda x: f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"
    group = lambda p, k=1: strip(f"regexp_extract(t, '{p}', {k})")
    label = strip(f"regexp_replace({group(statements._LABEL)}, '^[*]+|[*]+$', '', 'g')")
    date = "coalesce(" + ", ".join(f"nullif({x}, '')" for x in (label, *map(group, statements.DATE_LINES[form]))) + ")"
    fields = statements.FIELD_LINES[form]
    name = "coalesce(" + ", ".join(f"nullif(lower({group(p)}), '')" for p in fields) + ")"
    value = "CASE " + " ".join(f"WHEN {group(p)} <> '' THEN nullif({group(p, 2)}, '')" for p in fields) + " END"
    if form == "balance":
        name = strip(f"replace({name}, ' amount', '')")
    roles = ""
    for kind, words in statements.LABELS[form].items():
        own = [columns[kind].lower()] if kind in columns and (form, kind) != ("balance", "balance") else []
        roles += f" WHEN name IN ({', '.join(repr(w) for w in [*words, *own])}) THEN '{kind}'"
    amount_is = "debit" if form == "balance" else "amount"
    if form == "balance":
        more = "e.kind = 'more' AND s.going AND s.description IS NOT NULL"
        going = "CASE WHEN e.kind = 'description' THEN true WHEN e.kind IS NULL OR e.kind IN ('other', 'more') THEN s.going ELSE false END"
    else:
        more = "e.kind = 'more' AND (s.description IS NULL OR s.going)"
        going = "CASE WHEN e.kind = 'description' OR (e.kind = 'more' AND s.description IS NULL) THEN true WHEN e.kind IS NULL OR e.kind = 'more' THEN s.going ELSE false END"
    filled = "coalesce({0}.description, {0}.debit, {0}.credit, {0}.amount, {0}.balance) IS NOT NULL"
    closes = f"coalesce((e.kind = 'date' AND {filled.format('s')} AND s.date IS NOT NULL) OR (e.kind = 'description' AND s.description IS NOT NULL), false)"
    keep = lambda c, new: f"CASE WHEN {new} THEN e.value WHEN {closes} THEN NULL ELSE s.{c} END AS {c}"
    is_ = lambda c: f"coalesce(e.kind = '{c}'" + (f" OR (e.kind = 'amount' AND s.debit IS NULL), false)" if c == amount_is == "debit" else ", false)")
    columns_ = ", ".join(("CASE WHEN " + more + " THEN concat_ws(' ', s.description, e.value) WHEN e.kind = 'description' THEN e.value WHEN " + closes + " THEN NULL ELSE s.description END AS description") if c == "description" else keep(c, "false" if c == "amount" and form == "balance" else is_(c)) for c in statements.VALUES)
    return f"""
    WITH RECURSIVE l AS (SELECT doc, row_number() OVER (PARTITION BY doc ORDER BY i) AS i, t FROM (SELECT doc, i, {strip("line")} AS t FROM statement_lines) WHERE t <> ''),
    f AS (SELECT doc, i, {date} AS date, {name} AS name, {value} AS value, nullif({group(statements._GOES_ON)}, '') AS more FROM l),
    e AS (SELECT doc, i, CASE WHEN date IS NOT NULL THEN 'date' WHEN name IS NOT NULL AND value IS NOT NULL THEN CASE{roles} ELSE 'other' END WHEN more IS NOT NULL THEN 'more' END AS kind,
      CASE WHEN date IS NOT NULL THEN date WHEN name IS NOT NULL AND value IS NOT NULL THEN value ELSE more END AS value FROM f),
    s AS (SELECT DISTINCT doc, 0::BIGINT AS i, NULL::VARCHAR AS date, NULL::VARCHAR AS description, NULL::VARCHAR AS debit, NULL::VARCHAR AS credit, NULL::VARCHAR AS amount, NULL::VARCHAR AS balance, false AS going, false AS closed FROM l
      UNION ALL SELECT s.doc, e.i, CASE WHEN e.kind = 'date' THEN e.value ELSE s.date END, {columns_}, {going}, {closes} FROM s JOIN e ON e.doc = s.doc AND e.i = s.i + 1),
    r AS (SELECT p.* FROM s JOIN s p ON p.doc = s.doc AND p.i = s.i - 1 WHERE s.closed
      UNION ALL SELECT s.* FROM s JOIN (SELECT doc, max(i) AS i FROM s GROUP BY doc) USING (doc, i) WHERE date IS NOT NULL AND {filled.format('s')})
    SELECT doc, row_number() OVER (PARTITION BY doc ORDER BY i) AS n, date, description, debit, credit, amount, balance FROM r"""


def _statement(spark, sf_dir, form, columns):
    rows = statements.statement_rows(F.col("raw"), form, columns)
    return texts(spark, sf_dir, "statement_lines").select("doc", rows.alias("rows")).transform(each, "rows", "n", "r").select("doc", (F.col("n") + 1).cast("long").alias("n"), "r.*")


_BALANCE = {"description": "Narrative", "debit": "Paid out", "credit": "Paid in", "balance": "Running balance"}
_AMOUNT = {"description": "Transaction", "amount": "Debit", "balance": "Running balance"}


@query(statement_sql("balance", _BALANCE))
def par8_balance_rows(spark, sf_dir):
    return _statement(spark, sf_dir, "balance", _BALANCE)


@query(statement_sql("amount", _AMOUNT))
def par9_amount_rows(spark, sf_dir):
    return _statement(spark, sf_dir, "amount", _AMOUNT)


# --- blocks ----------------------------------------------------------------------------------
def block_sql(keys: tuple[str, ...], bare: bool = False) -> str:
    """The last line of each key in each block, by a running count of headers."""
    names = ", ".join(f"'{k}'" for k in keys)
    return f"""b AS (SELECT doc, i, line, regexp_matches(line, '(?i)^(?:---\\s*)?RECEIPT\\s+\\d+') AS h, upper(trim(split_part(line, ':', 1))) AS key, CASE WHEN contains(line, ':') THEN trim(substr(line, instr(line, ':') + 1)) ELSE '' END AS value, contains(line, ':') AS colon
      FROM (SELECT doc, i, trim(line) AS line FROM block_lines WHERE trim(line) <> '')),
    c AS (SELECT *, count(*) FILTER (h) OVER (PARTITION BY doc ORDER BY i) AS block FROM b),
    d AS (SELECT doc, block, key, arg_max(value, i) AS value FROM c WHERE block > 0 AND NOT h AND key IN ({names}) {'' if bare else 'AND colon'} GROUP BY ALL)"""


def _exploded(t, column):
    blocks_ = each(t.select("doc", column.alias("b")), "b", "n", "m").select("doc", (F.col("n") + 1).cast("long").alias("n"), "m")
    return each(blocks_, "m", "key", "value")


@query(f"WITH {block_sql(blocks.RECEIPT_KEYS)} SELECT doc, dense_rank() OVER (PARTITION BY doc ORDER BY block) AS n, key, value FROM d")
def par7_receipt_blocks(spark, sf_dir):
    return _exploded(texts(spark, sf_dir, "block_lines"), blocks.receipt_blocks(F.col("raw")))


@query(f"""WITH {block_sql(blocks.RECEIPT_KEYS)}, p AS (SELECT doc, row_number() OVER (PARTITION BY doc ORDER BY block) AS n, coalesce(max(value) FILTER (key = 'STORE'), 'UNKNOWN') AS s, coalesce(max(value) FILTER (key = 'DATE'), 'UNKNOWN') AS t, coalesce(max(value) FILTER (key = 'TOTAL'), 'UNKNOWN') AS u FROM d GROUP BY doc, block)
    SELECT doc, count(*) AS receipts, string_agg('Purchase ' || n || ': ' || s || ', date ' || t || ', total ' || u, chr(10) ORDER BY n) AS listed FROM p GROUP BY doc""")
def par7_purchases(spark, sf_dir):
    t = texts(spark, sf_dir, "block_lines").withColumn("b", blocks.receipt_blocks(F.col("raw"))).filter(F.size("b") > 0)
    return t.select("doc", F.size("b").cast("long").alias("receipts"), blocks.purchases(F.col("b")).alias("listed"))


@query(f"WITH {block_sql(blocks.MATCH_KEYS)} SELECT doc, dense_rank() OVER (PARTITION BY doc ORDER BY block) AS n, key, value FROM d")
def par7_match_blocks(spark, sf_dir):
    return _exploded(texts(spark, sf_dir, "block_lines"), blocks.match_blocks(F.col("raw")))


_STORE = "max(value) FILTER (key = 'RECEIPT_STORE') OVER (PARTITION BY doc, block)"


@query(f"""WITH {block_sql(blocks.LINK_KEYS, bare=True)}, s AS (SELECT doc, block, key, value, coalesce({_STORE}, '') AS store FROM d),
    j AS (SELECT doc, 1 AS n, key, value FROM (SELECT case_id AS doc, unnest(['RECEIPT_STORE', 'MATCHED_TRANSACTION', 'CONFIDENCE', 'REASONING']) AS key, unnest([description, 'FOUND', '', qty::VARCHAR]) AS value FROM bank_rows WHERE case_id % 4 = 0 AND pos = 1))
    SELECT doc, dense_rank() OVER (PARTITION BY doc ORDER BY block) AS n, key, value FROM s WHERE doc % 4 <> 0 AND store <> '' AND store[1] <> '[' AND lower(store) NOT IN ('not specified', 'unknown', 'n/a', 'none', 'next purchase')
    UNION ALL SELECT * FROM j""")
def par13_flt10_link_answers(spark, sf_dir):
    rows = view(spark, sf_dir, "bank_rows").filter("case_id % 4 = 0 AND pos = 1")
    body = F.to_json(F.struct(F.col("description").alias("receipt_store"), F.lit("FOUND").alias("Matched_Transaction"), F.lit(None).cast("string").alias("CONFIDENCE"), F.col("qty").alias("REASONING"), F.lit("x").alias("other")), {"ignoreNullFields": "false"})
    as_json = rows.select(F.col("case_id").alias("doc"), F.concat(F.lit("RECEIPT 1\n```json\n"), body, F.lit("\n```")).alias("raw"))
    both = texts(spark, sf_dir, "block_lines").filter("doc % 4 <> 0").unionByName(as_json)
    return _exploded(both, blocks.link_answers(F.col("raw")))


@query("""WITH o AS (SELECT doc, raw, CASE WHEN contains(raw, '{') THEN regexp_replace(regexp_replace(regexp_replace(substr(raw, instr(raw, '{')), '```.*', '', 's'), '(\\d|"b")(\\s+"(seg|c)": )', '\\1,\\2'), ',\\s*\\]', ']') END AS t FROM cut_json),
    p AS (SELECT doc, t, unnest(range(1, length(t) + 1)) AS n FROM o WHERE t IS NOT NULL),
    q AS (SELECT doc, n, substr(t, 1, n) || e AS x FROM p, (SELECT unnest(['', '}', ']}', '}}', ']}}', '}]}', '"}', '"]}', '"}}', '"}]}', ']]}', '}}}']) AS e)),
    r AS (SELECT doc, arg_max(json(x)::VARCHAR, n) AS repaired FROM q WHERE json_valid(x) GROUP BY doc)
    SELECT doc, repaired, json_extract_string(repaired, '$.name') AS name FROM cut_json LEFT JOIN r USING (doc)""")
def jsn2_cut_json(spark, sf_dir):
    t = view(spark, sf_dir, "cut_json").withColumn("repaired", blocks.repair_json(F.col("raw")))
    return t.select("doc", "repaired", F.get_json_object("repaired", "$.name").alias("name"))
