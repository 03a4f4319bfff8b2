"""Queries of statement maths: lists to rows, amounts by the balance, lists again, each with its SQL by joins and windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.functions.arrays import each
from ledgerloom.operators import statement_fields, statements
from ledgerloom.operators import statement_maths as maths
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


_PIPED = lambda c: f"list_transform(string_split({c}, '|'), lambda x: trim(x))"
_FULL = lambda c: f"list_filter({c}, lambda x: x <> '')"


def _first_of(c: str, patterns: tuple[str, ...], last: str = "[]") -> str:
    runs = [f"regexp_extract_all({c}, '{p}')" for p in patterns]
    return "CASE " + " ".join(f"WHEN len({r}) > 0 THEN {r}" for r in runs) + f" ELSE {last} END"


_NUM = lambda x: f"TRY_CAST(regexp_replace({x}, '[^0-9.-]', '', 'g') AS DOUBLE)"
_DATE = """CASE WHEN regexp_matches(x, '^\\d+/\\d+/\\d{4}$') THEN TRY_CAST(split_part(x, '/', 3) || '-' || split_part(x, '/', 2) || '-' || split_part(x, '/', 1) AS DATE) WHEN regexp_matches(x, '^\\d{4}-\\d+-\\d+$') THEN TRY_CAST(x AS DATE)
    WHEN regexp_matches(x, '^[A-Za-z]{3} \\d+ [A-Za-z]{3} \\d{4}$') THEN TRY_CAST(split_part(x, ' ', 4) || '-' || lpad(((instr('xxJanFebMarAprMayJunJulAugSepOctNovDec', split_part(x, ' ', 3))) / 3)::INT::VARCHAR, 2, '0') || '-' || split_part(x, ' ', 2) AS DATE) END"""
_WORDS = lambda words: " + ".join(f"contains(lower(t), '{w}')::INT" for w in words)
_LISTS = f"""
    l AS (SELECT doc, CASE WHEN contains(dates, '|') THEN {_FULL(_PIPED('dates'))} ELSE {_first_of("coalesce(dates, '')", maths.DATE_RUNS)} END AS d,
      CASE WHEN contains(balances, '|') THEN {_FULL(_PIPED('balances'))} ELSE {_first_of("coalesce(balances, '')", maths.MONEY_RUNS, "list_filter(regexp_split_to_array(coalesce(balances, ''), '\\s+'), lambda x: contains(x, '$') OR regexp_matches(x, '^[0-9]'))")} END AS b,
      CASE WHEN coalesce(descriptions, '') IN ('', 'NOT_FOUND') THEN [] ELSE {_FULL(_PIPED('descriptions'))} END AS t,
      CASE WHEN coalesce(paid, '') IN ('', 'NOT_FOUND') THEN [] WHEN contains(paid, '|') THEN {_PIPED('paid')} ELSE {_first_of('paid', maths.MONEY_RUNS)} END AS p,
      CASE WHEN coalesce(received, '') IN ('', 'NOT_FOUND') THEN [] WHEN contains(received, '|') THEN {_PIPED('received')} ELSE {_first_of('received', maths.MONEY_RUNS)} END AS r FROM statement_lists),
    m AS (SELECT doc, list_filter(list_transform(d, lambda x: {{'date': {_DATE}, 'text': x}}), lambda x: x.date IS NOT NULL) AS d, list_filter(list_transform(b, lambda x: {_NUM('x')}), lambda x: x IS NOT NULL) AS b, t,
      list_transform(p, lambda x: coalesce({_NUM('x')}, 0.0)) AS p, list_transform(r, lambda x: coalesce({_NUM('x')}, 0.0)) AS r FROM l)"""
_ROWS = f"""
    e AS (SELECT *, unnest(range(0, len(d))) AS i FROM m WHERE len(d) > 0 AND len(b) > 0),
    f AS (SELECT doc, i, d[i + 1].date AS date, d[i + 1].text AS text, coalesce(b[i + 1], 0.0) AS balance, coalesce(t[i + 1], 'Transaction') AS t, abs(coalesce(p[i + 1], 0.0)) AS paid, abs(coalesce(r[i + 1], 0.0)) AS received FROM e),
    g AS (SELECT *, round(balance - lag(balance) OVER (PARTITION BY doc ORDER BY date, i), 6) AS change, {_WORDS(maths.DEBIT_WORDS)} AS dw, {_WORDS(maths.CREDIT_WORDS)} AS cw FROM f),
    h AS (SELECT *, dw > cw AND received > 0 AND paid = 0 AS out_, cw > dw AND paid > 0 AND received = 0 AS in_ FROM g),
    k AS (SELECT *, CASE WHEN out_ THEN received WHEN in_ THEN 0 ELSE paid END AS op, CASE WHEN in_ THEN paid WHEN out_ THEN 0 ELSE received END AS orr FROM h),
    rows_ AS (SELECT *, CASE WHEN op > 0 THEN op WHEN change < 0 THEN -change END AS fp, CASE WHEN orr > 0 THEN orr WHEN change > 0 THEN change END AS fr, coalesce(nullif(paid, 0), nullif(received, 0)) AS vlm FROM k)"""


def _statements(spark, sf_dir):
    v = view(spark, sf_dir, "statement_lists")
    names = {"dates": maths.DATES, "balances": maths.BALANCES, "descriptions": maths.DESCRIPTIONS, "paid": maths.PAID, "received": maths.RECEIVED}
    # Spark writes a created map out anew wherever one of its fields is asked for; one from arrays is made once
    return v.select("doc", F.map_from_arrays(F.array(*map(F.lit, names.values())), F.array(*names)).alias("fields"))


@query(f"WITH {_LISTS} SELECT doc, len(d) AS n_dates, min(x.date) AS first_date, len(b) AS n_balances, round(list_sum(b), 2) AS sum_balances, len(t) AS n_descriptions, len(p) AS n_paid, round(list_sum(p), 2) AS sum_paid, len(r) AS n_received FROM m LEFT JOIN LATERAL (SELECT unnest(d) AS x) ON true GROUP BY ALL".replace("min(x.date) AS first_date", "list_min(list_transform(d, lambda x: x.date)) AS first_date").replace(" LEFT JOIN LATERAL (SELECT unnest(d) AS x) ON true GROUP BY ALL", ""))
def bnk3_statement_lists(spark, sf_dir):
    of = lambda f: F.try_element_at("fields", F.lit(f))
    t = _statements(spark, sf_dir).select(
        "doc", maths.statement_dates(of(maths.DATES)).alias("d"), maths.statement_balances(of(maths.BALANCES)).alias("b"), maths.statement_descriptions(of(maths.DESCRIPTIONS)).alias("t"),
        maths.statement_amounts(of(maths.PAID)).alias("p"), maths.statement_amounts(of(maths.RECEIVED)).alias("r"),
    )
    n = lambda c: F.size(c).cast("long")
    total = lambda c: F.when(F.size(c) > 0, F.round(F.aggregate(c, F.lit(0.0), lambda a, x: a + x), 2))
    return t.select("doc", n("d").alias("n_dates"), F.array_min(F.col("d.date")).alias("first_date"), n("b").alias("n_balances"), total("b").alias("sum_balances"), n("t").alias("n_descriptions"), n("p").alias("n_paid"), total("p").alias("sum_paid"), n("r").alias("n_received"))


@query(f"""WITH {_LISTS}, {_ROWS} SELECT doc, i, date, text, t AS description, balance, change, fp AS paid, fr AS received, CASE WHEN fp > 0 THEN 'DEBIT' WHEN fr > 0 THEN 'CREDIT' ELSE 'UNKNOWN' END AS kind, out_ OR in_ AS moved,
    CASE WHEN vlm IS NULL THEN NULL WHEN paid <> 0 THEN coalesce(change < 0, false) ELSE coalesce(change > 0, false) END AS right, round(CASE WHEN change <> 0 THEN 1.0 - abs(vlm - abs(change)) / abs(change) END, 6) AS accuracy,
    CASE WHEN vlm IS NULL THEN 0.80 WHEN CASE WHEN paid <> 0 THEN coalesce(change < 0, false) ELSE coalesce(change > 0, false) END THEN 0.95 ELSE 0.85 END AS confidence FROM rows_""".replace(" AS right", ' AS "right"'))
def bnk1_rul16_rul17_rows(spark, sf_dir):
    t = each(maths.analyse(_statements(spark, sf_dir)).select("doc", "rows"), "rows", "place", "r").select("doc", "r.*")
    return t.withColumns({"i": F.col("i").cast("long"), "accuracy": F.round("accuracy", 6)})


@query(f"""WITH {_LISTS}, {_ROWS},
    o AS (SELECT r.doc, count(*) AS transactions, round(sum(coalesce(fp, 0)), 2) AS total_debits, round(sum(coalesce(fr, 0)), 2) AS total_credits,
      string_agg(CASE WHEN fp > 0 THEN CASE WHEN s.signed THEN '-' ELSE '' END || '$' || fp::DECIMAL(18,2)::VARCHAR ELSE 'NOT_FOUND' END, ' | ' ORDER BY i) AS paid,
      string_agg(CASE WHEN fr > 0 AND NOT coalesce(fp > 0, false) THEN '$' || fr::DECIMAL(18,2)::VARCHAR ELSE 'NOT_FOUND' END, ' | ' ORDER BY i) AS received
      FROM rows_ r JOIN (SELECT doc, len(list_filter(p, lambda x: x < 0)) > 0 AS signed FROM m) s ON s.doc = r.doc GROUP BY r.doc)
    SELECT l.doc, o.doc IS NOT NULL AS success, coalesce(o.paid, l.paid) AS paid, CASE WHEN o.doc IS NOT NULL THEN o.received ELSE l.received END AS received, total_debits, total_credits, coalesce(transactions, 0) AS transactions FROM statement_lists l LEFT JOIN o ON o.doc = l.doc""")
def bnk4_enhanced_lists(spark, sf_dir):
    t = maths.enhance(_statements(spark, sf_dir))
    return t.select("doc", F.try_element_at("fields", F.lit(maths.PAID)).alias("paid"), F.try_element_at("fields", F.lit(maths.RECEIVED)).alias("received"), "analysis.*")


# --- rows to a statement's fields ----------------------------------------------------------------
_ROW = """SELECT case_id AS doc, pos, CASE WHEN (case_id + pos) % 17 = 0 THEN '' ELSE lpad(day(txn_date)::VARCHAR, 2, '0') || '/' || lpad(month(txn_date)::VARCHAR, 2, '0') || '/' || year(txn_date) END AS date, CASE WHEN (case_id + pos) % 17 <> 0 THEN txn_date END AS d,
    CASE WHEN (case_id * 3 + pos) % 19 = 0 THEN 'Opening Balance' WHEN (case_id + pos) % 23 = 0 THEN NULL ELSE description END AS description, CASE WHEN debit > 0 THEN '$' || debit::DECIMAL(18,2) WHEN pos % 2 = 0 THEN 'NOT_FOUND' END AS debit, CASE WHEN credit > 0 THEN credit::DECIMAL(18,2)::VARCHAR ELSE '' END AS credit,
    CASE WHEN debit > 0 THEN CASE WHEN pos % 2 = 0 THEN '(' || debit::DECIMAL(18,2) || ')' ELSE '-$' || debit::DECIMAL(18,2) END ELSE credit::DECIMAL(18,2)::VARCHAR END AS amount, CASE WHEN balance IS NULL THEN 'n/a' WHEN balance < 0 THEN '($' || (-balance)::DECIMAL(18,2) || ')' ELSE '$' || balance::DECIMAL(18,2) || ' CR' END AS balance, balance AS b, debit AS dn, credit AS cn FROM register"""
_FIELDS_SQL = f"""WITH r AS ({_ROW}), ends AS (SELECT doc, count(*) AS n, arg_min(coalesce(d, DATE '9999-01-01'), pos) AS a, arg_max(coalesce(d, DATE '0001-01-01'), pos) AS z, arg_min(date, pos) FILTER (date <> '') AS first, arg_max(date, pos) FILTER (date <> '') AS last, arg_min(d, pos) FILTER (d IS NOT NULL) AS fd, arg_max(d, pos) FILTER (d IS NOT NULL) AS ld, count(*) FILTER (date <> '') AS nd FROM r GROUP BY doc),
    o AS (SELECT r.*, row_number() OVER (PARTITION BY r.doc ORDER BY CASE WHEN n > 1 AND a < z THEN pos END, d NULLS LAST, pos) AS k FROM r JOIN ends USING (doc) WHERE coalesce(upper(description) <> 'OPENING BALANCE', true)),
    c AS (SELECT *, round(b - lag(b IGNORE NULLS) OVER (PARTITION BY doc ORDER BY k), 6) AS delta FROM o),
    f AS (SELECT *, CASE WHEN delta IS NULL OR abs(delta) < 0.01 THEN debit WHEN delta > 0 THEN 'NOT_FOUND' WHEN dn > 0 AND round(abs(dn + delta), 6) < 0.01 THEN debit WHEN cn > 0 AND round(abs(cn + delta), 6) < 0.01 THEN credit ELSE '$' || (-delta)::DECIMAL(18,2) END AS paid FROM c),
    p AS (SELECT doc, 'balance' AS way, k, date, description, paid, balance FROM f WHERE coalesce(paid NOT IN ('', 'NOT_FOUND', '$0.00', '0.00'), false)
      UNION ALL SELECT doc, 'debit_credit', pos, date, description, debit, 'NOT_FOUND' FROM r WHERE dn > 0 AND coalesce(upper(description) <> 'OPENING BALANCE', true)
      UNION ALL SELECT doc, 'amount', pos, date, description, '-$' || dn::DECIMAL(18,2), balance FROM r WHERE dn > 0 AND coalesce(upper(description) <> 'OPENING BALANCE', true)),
    l AS (SELECT doc, way, string_agg(date, ' | ' ORDER BY k) AS dates, string_agg(description, ' | ' ORDER BY k) AS descriptions, string_agg(paid, ' | ' ORDER BY k) AS paid, string_agg(balance, ' | ' ORDER BY k) AS balances FROM p WHERE date <> '' AND description IS NOT NULL GROUP BY ALL)
    SELECT e.doc, w.way, CASE WHEN nd = 0 THEN 'NOT_FOUND' WHEN nd = 1 THEN first WHEN fd > ld THEN last || ' - ' || first ELSE first || ' - ' || last END AS span, coalesce(dates, 'NOT_FOUND') AS dates, coalesce(descriptions, 'NOT_FOUND') AS descriptions, coalesce(paid, 'NOT_FOUND') AS paid, coalesce(balances, 'NOT_FOUND') AS balances
    FROM ends e CROSS JOIN (SELECT unnest(['balance', 'debit_credit', 'amount']) AS way) w LEFT JOIN l ON l.doc = e.doc AND l.way = w.way"""


@query(_FIELDS_SQL)
def bnk6_bnk7_statement_fields(spark, sf_dir):
    c, k = F.col, F.col("case_id") + F.col("pos")
    money = lambda x: x.cast("decimal(18,2)").cast("string")
    row = F.struct(
        "pos", F.when(k % 17 == 0, "").otherwise(F.date_format("txn_date", "dd/MM/yyyy")).alias("date"), F.when((c("case_id") * 3 + c("pos")) % 19 == 0, "Opening Balance").when(k % 23 == 0, None).otherwise(c("description")).alias("description"),
        F.when(c("debit") > 0, F.concat(F.lit("$"), money(c("debit")))).when(c("pos") % 2 == 0, "NOT_FOUND").alias("debit"), F.when(c("credit") > 0, money(c("credit"))).otherwise("").alias("credit"),
        F.when(c("debit") > 0, F.when(c("pos") % 2 == 0, F.concat(F.lit("("), money(c("debit")), F.lit(")"))).otherwise(F.concat(F.lit("-$"), money(c("debit"))))).otherwise(money(c("credit"))).alias("amount"),
        F.when(c("balance").isNull(), "n/a").when(c("balance") < 0, F.concat(F.lit("($"), money(-c("balance")), F.lit(")"))).otherwise(F.concat(F.lit("$"), money(c("balance")), F.lit(" CR"))).alias("balance"),
    )
    names = ("date", *statements.VALUES)
    docs = view(spark, sf_dir, "register").groupBy(c("case_id").alias("doc")).agg(F.transform(F.sort_array(F.collect_list(row)), lambda r: F.struct(*[r[n].alias(n) for n in names])).alias("rows"))
    of = {"span": "STATEMENT_DATE_RANGE", "dates": maths.DATES, "descriptions": maths.DESCRIPTIONS, "paid": maths.PAID, "balances": maths.BALANCES}
    return statement_fields.fields_by_strategy(docs, "rows").select("doc", "way", *[F.try_element_at("fields", F.lit(f)).alias(n) for n, f in of.items()])


@query(f"""WITH {_LISTS}, e AS (SELECT *, unnest(range(0, least(len(d), len(b)))) AS i FROM m WHERE len(d) > 0 AND len(b) > 0), f AS (SELECT doc, i, b[i + 1] AS balance, d[i + 1].date AS date, p[1] AS p1, r[1] AS r1 FROM e),
    g AS (SELECT *, row_number() OVER w AS k, round(balance - lag(balance) OVER w, 6) AS change FROM f WINDOW w AS (PARTITION BY doc ORDER BY date, i)), h AS (SELECT *, CASE WHEN k = 1 THEN CASE WHEN p1 > 0 THEN -p1 WHEN r1 > 0 THEN r1 ELSE 0 END ELSE change END AS x FROM g),
    o AS (SELECT doc, string_agg(CASE WHEN x < 0 THEN '$' || (-x)::DECIMAL(18,2) ELSE 'NOT_FOUND' END, ' | ' ORDER BY i) AS paid, string_agg(CASE WHEN x > 0 THEN '$' || x::DECIMAL(18,2) ELSE 'NOT_FOUND' END, ' | ' ORDER BY i) AS received, round(sum(CASE WHEN x < 0 THEN -x ELSE 0 END), 2) AS total_debits, round(sum(CASE WHEN x > 0 THEN x ELSE 0 END), 2) AS total_credits FROM h GROUP BY doc)
    SELECT l.doc, o.doc IS NOT NULL AS success, coalesce(paid, '') AS paid, coalesce(received, '') AS received, coalesce(total_debits, 0) AS total_debits, coalesce(total_credits, 0) AS total_credits FROM (SELECT doc FROM statement_lists) l LEFT JOIN o ON o.doc = l.doc""")
def bnk2_by_change_alone(spark, sf_dir):
    t = maths.by_change_alone(_statements(spark, sf_dir))
    return t.select("doc", "success", F.array_join("paid", " | ").alias("paid"), F.array_join("received", " | ").alias("received"), "total_debits", "total_credits")
