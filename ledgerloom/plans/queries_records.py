"""Queries of the scalar library, linking, bank registers, trust cases and scores, each with its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions import dates, money, text
from ledgerloom.operators import bank, linking, scoring, trust
from ledgerloom.plans.views import duck, view

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name, with DuckDB SQL over the record views."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE[f.__name__] = duck(sql)
        return f

    return add


# --- amounts ---------------------------------------------------------------------------------
_TIDY = "CASE WHEN regexp_matches({x}, '^[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)$') THEN CAST({x} AS DOUBLE) END"


@query("SELECT case_id, pos, CASE WHEN text = 'NOT_FOUND' THEN NULL WHEN b[1:1] IN ('-', '(') THEN -v ELSE v END AS value FROM (SELECT *, " + _TIDY.format(x="replace(regexp_replace(b, '^[-()]+|[-()]+$', '', 'g'), ',', '')") + " AS v FROM (SELECT *, regexp_replace(trim(text), '[$€£\\s]', '', 'g') AS b FROM amount_texts))")
def num1_signed_amounts(spark, sf_dir):
    return view(spark, sf_dir, "amount_texts").select("case_id", "pos", money.parse_signed(F.col("text")).alias("value"))


@query("SELECT case_id, pos, CASE WHEN upper(trim(text)) NOT IN ('NOT_FOUND', 'N/A', 'NONE', 'NULL', '') THEN " + _TIDY.format(x="b") + " END AS value FROM (SELECT *, CASE WHEN a LIKE '(%)' THEN '-' || a[2:-2] ELSE a END AS b FROM (SELECT *, regexp_replace(trim(text), '[$,\\s]', '', 'g') AS a FROM amount_texts))")
def num2_bracketed_amounts(spark, sf_dir):
    return view(spark, sf_dir, "amount_texts").select("case_id", "pos", money.parse_bracketed(F.col("text")).alias("value"))


@query("SELECT case_id, pos, " + _TIDY.format(x="a") + " AS value, abs(" + _TIDY.format(x="a") + ") AS magnitude FROM (SELECT *, regexp_replace(trim(text), '[$,\\s]', '', 'g') AS a FROM amount_texts)")
def num3_num4_plain_amounts(spark, sf_dir):
    t = view(spark, sf_dir, "amount_texts")
    return t.select("case_id", "pos", money.parse_plain(F.col("text")).alias("value"), money.parse_absolute(F.col("text")).alias("magnitude"))


@query("SELECT case_id, pos, coalesce(abs(" + _TIDY.format(x="a") + "), 0.0) AS ledger, " + _TIDY.format(x="g") + " AS digits FROM (SELECT *, regexp_replace(regexp_replace(upper(text), 'CR|DR', '', 'g'), '[$,\\s()]', '', 'g') AS a, regexp_replace(text, '[^0-9.\\-]', '', 'g') AS g FROM amount_texts)")
def num5_num6_ledger_and_digits(spark, sf_dir):
    t = view(spark, sf_dir, "amount_texts")
    return t.select("case_id", "pos", money.parse_ledger(F.col("text")).alias("ledger"), money.parse_digits(F.col("text")).alias("digits"))


@query("SELECT case_id, pos, abs(amount - other) <= CASE WHEN other <> 0 THEN abs(other * 0.01) ELSE 0.01 END AS equal, round(CASE WHEN greatest(abs(amount), abs(other)) = 0 THEN 0.0 ELSE abs(amount - other) / greatest(abs(amount), abs(other)) END, 6) AS diff, round_even(amount, 0) = round_even(other, 0) AS same_dollar FROM (SELECT *, amount + pos * 100 - 300 AS other FROM bank_rows)")
def num8_num9_num11_comparisons(spark, sf_dir):
    t = view(spark, sf_dir, "bank_rows").withColumn("other", F.col("amount") + F.col("pos") * 100 - 300)
    a, b = F.col("amount"), F.col("other")
    return t.select("case_id", "pos", money.money_equal(a, b).alias("equal"), F.round(money.pct_diff(a, b), 6).alias("diff"), (F.bround(a, 0) == F.bround(b, 0)).alias("same_dollar"))


@query("SELECT c_custkey AS id, len(filtered) = 11 AND (list_sum([(CAST(filtered[i:i] AS INT) - CASE WHEN i = 1 THEN 1 ELSE 0 END) * w[i] for i in range(1, 12)])) % 89 = 0 AS valid FROM (SELECT c_custkey, CAST(51824753000 + c_custkey AS VARCHAR) AS filtered, [10,1,3,5,7,9,11,13,15,17,19] AS w FROM customer)")
def num12_abn_checksum(spark, sf_dir):
    t = spark.read.parquet(f"{sf_dir}/customer.parquet")
    return t.select(F.col("c_custkey").alias("id"), money.abn_valid((F.lit(51824753000) + F.col("c_custkey")).cast("string")).alias("valid"))


@query("SELECT case_id, pos, CASE WHEN upper(trim(text)) IN ('NOT_FOUND', '') THEN 'NOT_FOUND' ELSE CASE WHEN trim(text)[1:1] IN ('-', '(') THEN '-$' ELSE '$' END || regexp_replace(trim(text), '[$()\\s-]', '', 'g') END AS debit FROM amount_texts")
def num14_debit_text(spark, sf_dir):
    return view(spark, sf_dir, "amount_texts").select("case_id", "pos", money.debit_text(F.col("text")).alias("debit"))


# --- dates -----------------------------------------------------------------------------------
@query("SELECT case_id, pos, CASE WHEN (case_id + pos) % 7 <= 4 THEN txn_date END AS value FROM date_texts")
def dat1_parse_dates(spark, sf_dir):
    return view(spark, sf_dir, "date_texts").select("case_id", "pos", dates.parse_date(F.col("text")).alias("value"))


_BDAYS = "(SELECT count(*) FROM range(least(txn_date, other) + 1, greatest(txn_date, other) + 1, INTERVAL 1 DAY) r(d) WHERE isodow(r.d) < 6)"


@query("SELECT case_id, pos, CAST(n AS BIGINT) AS n, round(CASE WHEN n > 5 THEN 0.0 WHEN n = 0 THEN 1.0 ELSE 1.0 - n / 6.0 END, 6) AS score, abs(datediff('day', txn_date, other)) <= 3 AS near FROM (SELECT *, abs((floor(b / 7) * 5 + least(b % 7 + 1, 5)) - (floor(a / 7) * 5 + least(a % 7 + 1, 5))) AS n FROM (SELECT *, datediff('day', DATE '1900-01-01', txn_date) AS a, datediff('day', DATE '1900-01-01', other) AS b FROM (SELECT *, txn_date + CAST((case_id * 3 + pos) % 14 - 4 AS INT) AS other FROM bank_rows)))")
def dat9_dat10_dat11_business_days(spark, sf_dir):
    t = view(spark, sf_dir, "bank_rows").withColumn("other", F.expr("date_add(txn_date, CAST((case_id * 3 + pos) % 14 - 4 AS INT))"))
    a, b = F.col("txn_date"), F.col("other")
    return t.select("case_id", "pos", dates.business_days(a, b).alias("n"), F.round(dates.date_score(a, b), 6).alias("score"), dates.near_dates(a, b, 3).alias("near"))


@query("""SELECT case_id, pos, d, m, CASE WHEN y < 100 THEN CASE WHEN y < 50 THEN 2000 + y ELSE 1900 + y END ELSE y END AS y FROM (
    SELECT case_id, pos, r[1] AS d, CASE WHEN mon > 0 THEN mon ELSE r[2] END AS m, CASE WHEN mon > 0 THEN r[2] ELSE r[3] END AS y FROM (
    SELECT *, [CAST(x AS INT) for x in regexp_extract_all(text, '\\d+')] AS r, CAST((instr('xxjanfebmaraprmayjunjulaugsepoctnovdec', nullif(lower(regexp_extract(text, '[A-Za-z]{3}')), 'not')) ) / 3 AS INT) AS mon FROM date_texts))""")
def dat2_date_parts(spark, sf_dir):
    p = dates.date_parts(F.col("text"))
    return view(spark, sf_dir, "date_texts").select("case_id", "pos", p["d"].alias("d"), p["m"].alias("m"), p["y"].alias("y"))


# --- strings ---------------------------------------------------------------------------------
_PAIRS = "(SELECT case_id, pos, description AS a, CASE WHEN (case_id + pos) % 3 = 0 THEN description || ' SYD' WHEN (case_id + pos) % 3 = 1 THEN substr(description, 3) ELSE reverse(description) END AS b FROM bank_rows)"
_ANLS = "CASE WHEN greatest(length(a), length(b)) = 0 THEN 1.0 ELSE 1.0 - levenshtein(lower(trim(a)), lower(trim(b))) / greatest(length(trim(a)), length(trim(b)))::DOUBLE END"
_JAC = "len(list_intersect(x, y)) / len(list_distinct(list_concat(x, y)))::DOUBLE"


def _pairs(spark, sf_dir):
    a, k = F.col("description"), F.pmod(F.col("case_id") + F.col("pos"), F.lit(3))
    return view(spark, sf_dir, "bank_rows").select("case_id", "pos", a.alias("a"), F.when(k == 0, F.concat(a, F.lit(" SYD"))).when(k == 1, F.substring(a, F.lit(3), F.length(a))).otherwise(F.reverse(a)).alias("b"))


@query(f"SELECT case_id, pos, round(s, 6) AS similarity, round(CASE WHEN s >= 0.5 THEN s ELSE 0.0 END, 6) AS floored, round({_JAC}, 6) AS overlap, s >= 0.9 OR {_JAC} >= 0.75 AS fuzzy FROM (SELECT *, {_ANLS} AS s, list_distinct(string_split(lower(trim(a)), ' ')) AS x, list_distinct(string_split(lower(trim(b)), ' ')) AS y FROM {_PAIRS})")
def str1_str5_similarity(spark, sf_dir):
    a, b = F.col("a"), F.col("b")
    return _pairs(spark, sf_dir).select("case_id", "pos", F.round(text.anls(a, b), 6).alias("similarity"), F.round(text.anls_floored(a, b), 6).alias("floored"), F.round(text.jaccard(a, b), 6).alias("overlap"), text.fuzzy_equal(a, b).alias("fuzzy"))


@query(f"SELECT case_id, pos, round(len(list_filter(x, lambda w: list_contains(y, w))) / len(x)::DOUBLE, 6) AS share, lower(a) = lower(b) OR contains(lower(b), lower(a)) OR contains(lower(a), lower(b)) OR len(list_intersect(list_distinct(x), list_distinct(y))) * 2 >= len(list_distinct(x)) AS matches FROM (SELECT *, string_split(upper(a), ' ') AS x, string_split(upper(b), ' ') AS y FROM {_PAIRS})")
def str6_str7_containment(spark, sf_dir):
    a, b = F.col("a"), F.col("b")
    return _pairs(spark, sf_dir).select("case_id", "pos", F.round(text.containment(a, b), 6).alias("share"), text.description_matches(a, b).alias("matches"))


@query("SELECT case_id, pos, CAST(qty AS VARCHAR) AS bare, CASE (case_id + pos) % 4 WHEN 3 THEN 'EACH' ELSE CAST(qty AS VARCHAR) END AS cleaned FROM bank_rows")
def str10_quantities(spark, sf_dir):
    q, k = F.col("qty").cast("string"), F.pmod(F.col("case_id") + F.col("pos"), F.lit(4))
    dressed = F.when(k == 0, F.concat(q, F.lit("x"))).when(k == 1, F.concat(F.lit("x"), q)).when(k == 2, F.concat(q, F.lit(" EACH"))).otherwise("EACH")
    return view(spark, sf_dir, "bank_rows").select("case_id", "pos", q.alias("bare"), text.strip_quantity(dressed).alias("cleaned"))


@query("SELECT case_id, pos, CASE WHEN pos % 3 = 0 THEN '_ungrouped' ELSE 'CASE' || case_id END AS grp, 'bank_statement' AS base, CAST(51824753000 + case_id AS VARCHAR) AS abn FROM bank_rows")
def str14_str21_str22_names(spark, sf_dir):
    name = F.when(F.col("pos") % 3 == 0, F.concat(F.lit("page"), F.col("pos"))).otherwise(F.concat(F.lit("case"), F.col("case_id"), F.lit("_p.png")))
    abn = (F.lit(51824753000) + F.col("case_id")).cast("string")
    spaced = F.concat(F.lit("ABN: "), F.substring(abn, 1, 2), F.lit(" "), F.substring(abn, 3, 9))
    kind = F.when(F.col("pos") % 2 == 0, "bank_statement_FLAT").otherwise("bank_statement_date_grouped")
    return view(spark, sf_dir, "bank_rows").select("case_id", "pos", text.case_id(name).alias("grp"), text.base_type(kind).alias("base"), text.clean_id(spaced).alias("abn"))


# --- registers as lists ----------------------------------------------------------------------
@query("SELECT case_id, string_agg(CAST(CAST(amount AS DECIMAL(18,2)) AS VARCHAR), ' | ' ORDER BY pos) AS amounts, count(*) AS n FROM bank_rows GROUP BY case_id")
def arr4_pipe_lists(spark, sf_dir):
    t = view(spark, sf_dir, "bank_rows").groupBy("case_id").agg(F.array_sort(F.collect_list(F.struct("pos", F.col("amount").cast("decimal(18,2)").cast("string").alias("a")))).alias("x"))
    return t.select("case_id", text.join_items(F.transform("x", lambda r: r["a"])).alias("amounts"), F.size("x").cast("long").alias("n"))


@query("SELECT case_id, pos, CASE WHEN pos <= n - 1 THEN CAST(txn_date AS VARCHAR) END AS d, amount FROM (SELECT *, count(*) OVER (PARTITION BY case_id) AS n FROM bank_rows)")
def arr1_register_explode(spark, sf_dir):
    """Parallel pipe lists to rows over the amounts; a date list that is one short gives a null."""
    lists = view(spark, sf_dir, "bank_rows").groupBy("case_id").agg(F.array_sort(F.collect_list(F.struct("pos", "txn_date", "amount"))).alias("x"))
    lists = lists.select("case_id", F.array_join(F.transform("x", lambda r: r["amount"].cast("string")), " | ").alias("amounts"), F.array_join(F.transform(F.slice("x", 1, F.greatest(F.size("x") - 1, F.lit(0))), lambda r: r["txn_date"].cast("string")), " | ").alias("dates"))
    days = text.split_items(F.col("dates"))
    return lists.select("case_id", days.alias("days"), F.posexplode(text.split_items(F.col("amounts"))).alias("i", "a")).select("case_id", (F.col("i") + 1).cast("long").alias("pos"), F.get("days", F.col("i")).alias("d"), F.col("a").cast("double").alias("amount"))


# --- linking ---------------------------------------------------------------------------------
_SCORED = """(SELECT *, CASE WHEN receipt_date IS NULL OR n > 5 THEN 0.0 WHEN n = 0 THEN 1.0 ELSE 1.0 - n / 6.0 END AS ds, len(list_filter(x, lambda w: list_contains(y, w))) / len(x)::DOUBLE AS ts FROM (
    SELECT r.case_id, r.rid, r.receipt_date, b.pos, string_split(upper(r.supplier), ' ') AS x, string_split(upper(b.description), ' ') AS y,
           abs((floor(q / 7) * 5 + least(q % 7 + 1, 5)) - (floor(p / 7) * 5 + least(p % 7 + 1, 5))) AS n
    FROM (SELECT *, datediff('day', DATE '1900-01-01', receipt_date) AS p FROM receipts) r
    JOIN (SELECT *, datediff('day', DATE '1900-01-01', txn_date) AS q FROM bank_rows) b ON r.case_id = b.case_id AND abs(r.total - b.amount) <= 0.01))"""
_CONF = "CASE WHEN ds IS NULL THEN 'NONE' WHEN ds > 0 AND ts >= 0.5 THEN 'HIGH' WHEN ds > 0 OR ts >= 0.5 THEN 'MEDIUM' ELSE 'LOW' END"
_BEST = f"(SELECT r.case_id, r.rid, c.pos, c.ds, c.ts, {_CONF} AS confidence FROM receipts r LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY case_id, rid ORDER BY ds + ts DESC, pos) AS k FROM {_SCORED}) WHERE k = 1) c ON r.case_id = c.case_id AND r.rid = c.rid)"


@query(f"SELECT case_id, rid, pos, round(ds, 6) AS date_score, round(ts, 6) AS desc_score FROM {_SCORED}")
def jn1_band_join(spark, sf_dir):
    c = linking.candidates(view(spark, sf_dir, "receipts"), view(spark, sf_dir, "bank_rows"))
    return c.select("case_id", "rid", "pos", F.round("date_score", 6).alias("date_score"), F.round("desc_score", 6).alias("desc_score"))


@query(f"SELECT case_id, rid, pos, round(ds, 6) AS date_score, round(ts, 6) AS desc_score, confidence FROM {_BEST}")
def jn2_best_match(spark, sf_dir):
    m = linking.best_match(view(spark, sf_dir, "receipts"), view(spark, sf_dir, "bank_rows"))
    return m.select("case_id", "rid", "pos", F.round("date_score", 6).alias("date_score"), F.round("desc_score", 6).alias("desc_score"), "confidence")


@query(f"SELECT confidence, count(*) AS n, round(avg(ds), 6) AS avg_date_score, round(avg(ts), 6) AS avg_desc_score FROM {_BEST} GROUP BY confidence")
def link_confidence_mix(spark, sf_dir):
    """The flagship: receipts linked to bank rows, and how sure the links are."""
    m = linking.best_match(view(spark, sf_dir, "receipts"), view(spark, sf_dir, "bank_rows"))
    return m.groupBy("confidence").agg(F.count("*").alias("n"), F.round(F.avg("date_score"), 6).alias("avg_date_score"), F.round(F.avg("desc_score"), 6).alias("avg_desc_score"))


_ONE_TO_ONE = f"""WITH RECURSIVE c AS (SELECT case_id, rid, pos, ds, ts, CASE WHEN ds > 0 AND ts >= 0.5 THEN 0 WHEN ds > 0 OR ts >= 0.5 THEN 1 ELSE 2 END AS level FROM {_SCORED}),
    b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY case_id, rid ORDER BY ds + ts DESC, pos) AS n FROM c) WHERE n = 1),
    o AS (SELECT case_id, rid, row_number() OVER (PARTITION BY case_id ORDER BY level, ds + ts DESC, rid) AS k FROM b),
    l AS (SELECT c.case_id, c.rid, o.k, list(c.pos ORDER BY c.ds + c.ts DESC, c.pos) AS free FROM c JOIN o ON c.case_id = o.case_id AND c.rid = o.rid GROUP BY 1, 2, 3),
    s(case_id, k, rid, used, hit) AS (SELECT DISTINCT case_id, CAST(0 AS BIGINT), CAST(NULL AS BIGINT), CAST([] AS BIGINT[]), CAST(NULL AS BIGINT) FROM o
      UNION ALL SELECT case_id, k, rid, CASE WHEN hit IS NULL THEN used ELSE list_append(used, hit) END, hit
      FROM (SELECT s.case_id, l.k, l.rid, s.used, list_filter(l.free, lambda x: NOT list_contains(s.used, x))[1] AS hit FROM s JOIN l ON s.case_id = l.case_id AND l.k = s.k + 1))
    SELECT r.case_id, r.rid, s.hit AS pos, round(c.ds, 6) AS date_score, round(c.ts, 6) AS desc_score, CASE WHEN c.ds IS NULL THEN 'NONE' WHEN c.level = 0 THEN 'HIGH' WHEN c.level = 1 THEN 'MEDIUM' ELSE 'LOW' END AS confidence
    FROM receipts r LEFT JOIN s ON s.case_id = r.case_id AND s.rid = r.rid LEFT JOIN c ON c.case_id = r.case_id AND c.rid = r.rid AND c.pos = s.hit"""


@query(_ONE_TO_ONE)
def jn3_one_to_one(spark, sf_dir):
    out = linking.assign(view(spark, sf_dir, "receipts"), view(spark, sf_dir, "bank_rows"))
    return out.select("case_id", "rid", "pos", F.round("date_score", 6).alias("date_score"), F.round("desc_score", 6).alias("desc_score"), "confidence")


_TRUTH = "(SELECT case_id, pos AS rid, CASE WHEN (case_id + pos) % 7 = 0 THEN NULL ELSE pos END AS expected FROM bank_rows WHERE (case_id * 31 + pos) % 3 = 0 AND case_id % 10 <> 0)"
_EVAL = f"(SELECT coalesce(l.case_id, t.case_id) AS case_id, coalesce(l.rid, t.rid) AS rid, t.expected, l.pos AS actual, CASE WHEN t.rid IS NULL THEN 'no_ground_truth' WHEN l.rid IS NULL THEN 'missing_link' WHEN t.expected IS NULL AND l.pos IS NULL THEN 'true_negative' WHEN t.expected IS NULL THEN 'false_positive' WHEN l.pos IS NULL THEN 'false_negative' WHEN t.expected = l.pos THEN 'correct' ELSE 'wrong_row' END AS outcome, l.confidence FROM {_BEST} l FULL OUTER JOIN {_TRUTH} t ON l.case_id = t.case_id AND l.rid = t.rid)"


def _evaluated(spark, sf_dir):
    links = linking.best_match(view(spark, sf_dir, "receipts"), view(spark, sf_dir, "bank_rows"))
    truth = view(spark, sf_dir, "bank_rows").filter("(case_id * 31 + pos) % 3 = 0 AND case_id % 10 <> 0").select("case_id", F.col("pos").alias("rid"), F.expr("CASE WHEN (case_id + pos) % 7 = 0 THEN NULL ELSE pos END").alias("pos"))
    return linking.evaluate(links, truth)


@query(f"SELECT case_id, rid, expected, actual, outcome FROM {_EVAL}")
def jn5_evl10_link_evaluation(spark, sf_dir):
    return _evaluated(spark, sf_dir)


@query(f"SELECT outcome, count(*) AS n, count(DISTINCT case_id) AS cases FROM {_EVAL} GROUP BY outcome")
def agg9_link_summary(spark, sf_dir):
    return _evaluated(spark, sf_dir).groupBy("outcome").agg(F.count("*").alias("n"), F.countDistinct("case_id").alias("cases"))


@query("SELECT r.case_id, r.rid, b.pos, CASE WHEN r.total IS NULL THEN true ELSE abs(abs(r.total) - abs(b.amount)) <= 0.01 END AS absolute, CASE WHEN r.total IS NULL OR r.total = 0 THEN true ELSE abs(r.total - b.amount) <= abs(r.total) * 0.01 END AS relative FROM receipts r JOIN bank_rows b ON r.case_id = b.case_id")
def flt12_flt13_amount_gates(spark, sf_dir):
    j = view(spark, sf_dir, "receipts").join(view(spark, sf_dir, "bank_rows"), "case_id")
    return j.select("case_id", "rid", "pos", linking.amount_gate(F.col("total"), F.col("amount")).alias("absolute"), linking.relative_gate(F.col("total"), F.col("amount")).alias("relative"))


@query("SELECT r.case_id, count(*) AS unlinked FROM receipts r WHERE NOT EXISTS (SELECT 1 FROM bank_rows b WHERE b.case_id = r.case_id AND b.amount = r.total) GROUP BY r.case_id")
def jn8_anti_join(spark, sf_dir):
    r, b = view(spark, sf_dir, "receipts"), view(spark, sf_dir, "bank_rows")
    return r.join(b, (r.case_id == b.case_id) & (r.total == b.amount), "left_anti").groupBy("case_id").agg(F.count("*").alias("unlinked"))


# --- bank registers --------------------------------------------------------------------------
_PREV = "last_value(balance IGNORE NULLS) OVER (PARTITION BY case_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
_DELTA = f"(SELECT *, round(balance - {_PREV}, 2) AS delta, {_PREV} AS prev_balance FROM register)"


@query("SELECT case_id, pos, round(true_balance - lag(true_balance) OVER (PARTITION BY case_id ORDER BY txn_date, pos), 2) AS diff FROM register")
def win1_balance_diff(spark, sf_dir):
    from pyspark.sql import Window

    w = Window.partitionBy("case_id").orderBy("txn_date", "pos")
    return view(spark, sf_dir, "register").select("case_id", "pos", F.round(F.col("true_balance") - F.lag("true_balance").over(w), 2).alias("diff"))


@query(f"SELECT case_id, pos, prev_balance, delta FROM {_DELTA}")
def win2_balance_chain(spark, sf_dir):
    return bank.with_delta(view(spark, sf_dir, "register")).select("case_id", "pos", "prev_balance", "delta")


@query("SELECT case_id, arg_min(txn_date, pos) AS first_date, arg_max(txn_date, pos) AS last_date, count(*) AS n_rows, count(*) > 1 AND arg_min(txn_date, pos) < arg_max(txn_date, pos) AS chronological FROM register GROUP BY case_id")
def win3_chronology(spark, sf_dir):
    return bank.chronology(view(spark, sf_dir, "register"))


_FIT = "({c} > 0 AND round(abs({c} - abs(delta)), 6) < 0.01)"
_OWN, _OTHER = "CASE WHEN delta < 0 THEN debit ELSE credit END", "CASE WHEN delta < 0 THEN credit ELSE debit END"
_ACTION = f"CASE WHEN delta IS NULL OR abs(delta) < 0.01 THEN 'kept' WHEN {_FIT.format(c=_OWN)} THEN 'confirmed' WHEN {_FIT.format(c=_OTHER)} THEN 'swapped' ELSE 'derived' END"
_FIXED = f"(SELECT *, CASE action WHEN 'confirmed' THEN {_OWN} WHEN 'swapped' THEN {_OTHER} ELSE abs(delta) END AS val FROM (SELECT *, {_ACTION} AS action FROM {_DELTA}))"


@query(f"SELECT case_id, pos, action, CASE WHEN action = 'kept' THEN debit WHEN delta < 0 THEN val ELSE 0.0 END AS new_debit, CASE WHEN action = 'kept' THEN credit WHEN delta > 0 THEN val ELSE 0.0 END AS new_credit FROM {_FIXED}")
def rul14_register_correction(spark, sf_dir):
    return bank.correct(view(spark, sf_dir, "register")).select("case_id", "pos", "action", "new_debit", "new_credit")


@query(f"SELECT action, count(*) AS n, count(*) FILTER (balance IS NULL) AS unreadable FROM {_FIXED} GROUP BY action")
def bnk5_correction_stats(spark, sf_dir):
    return bank.correct(view(spark, sf_dir, "register")).groupBy("action").agg(F.count("*").alias("n"), F.count_if(F.col("balance").isNull()).alias("unreadable"))


@query("SELECT case_id, round(sum(debit), 2) AS total_debit, round(sum(credit), 2) AS total_credit, count(*) AS n_rows, arg_min(true_balance, pos) AS first_balance, arg_max(true_balance, pos) AS last_balance, round(arg_max(true_balance, pos) - arg_min(true_balance, pos), 2) AS moved FROM register GROUP BY case_id")
def agg35_register_totals(spark, sf_dir):
    return bank.totals(view(spark, sf_dir, "register"))


@query("SELECT case_id, count(*) FILTER (debit > 0) AS debits, count(*) FILTER (credit > 0) AS credits, count(*) FILTER (description LIKE '%WIDGET%') AS widgets FROM register GROUP BY case_id")
def flt2_flt5_register_filters(spark, sf_dir):
    t = view(spark, sf_dir, "register").filter(bank.is_transaction(F.col("description")))
    return t.groupBy("case_id").agg(F.count_if(F.col("debit") > 0).alias("debits"), F.count_if(F.col("credit") > 0).alias("credits"), F.count_if(F.col("description").contains("WIDGET")).alias("widgets"))


@query("SELECT case_id, pos, CASE WHEN d > c THEN 'DEBIT' WHEN c > d THEN 'CREDIT' END AS kind FROM (SELECT *, contains(description, 'WIDGET')::INT + contains(description, 'SMALL')::INT AS d, contains(description, 'BOLT')::INT + contains(description, 'LARGE')::INT AS c FROM bank_rows)")
def rul15_keyword_type(spark, sf_dir):
    return view(spark, sf_dir, "bank_rows").select("case_id", "pos", bank.keyword_type(F.col("description"), ("WIDGET", "SMALL"), ("BOLT", "LARGE")).alias("kind"))


# --- trust cases -----------------------------------------------------------------------------
_K = "trust_return distribution_stmt income_schedule beneficiary_itr".split()
_QUADS = "(SELECT case_id, " + ", ".join(f"max({f}) FILTER (kind = '{k}') AS {k[:2]}_{f}" for k in _K for f in ("income", "franking", "cgt", "abn")) + " FROM trust_docs GROUP BY case_id)"
_PCT = "(CASE WHEN greatest(abs({a}), abs({b})) = 0 THEN 0.0 ELSE abs({a} - {b}) / greatest(abs({a}), abs({b})) END)"


def _p(a, b):
    return _PCT.format(a=a, b=b)


_DISC = f"CASE WHEN be_income < di_income AND {_p('be_income', 'di_income')} > 0.01 THEN 'under_reported_income' WHEN be_franking > di_franking AND {_p('be_franking', 'di_franking')} > 0.01 THEN 'over_claimed_franking' WHEN di_cgt > 0 AND in_cgt = 0 THEN 'missing_cgt' WHEN {_p('tr_income', 'di_income')} > 0.01 THEN 'trust_return_mismatch' ELSE 'none' END"
_AGREE = lambda f: "coalesce(" + " AND ".join(f"({k}_{f} IS NULL OR {_p('coalesce(tr_' + f + ', di_' + f + ')', k + '_' + f)} <= 0.01)" for k in ("di", "in", "be")) + ", true)"


@query("SELECT case_id, count(*) AS docs, count(DISTINCT kind) = 4 AS complete, max(income) FILTER (kind = 'distribution_stmt') AS income FROM trust_docs GROUP BY case_id")
def tru1_quad_assembly(spark, sf_dir):
    docs = view(spark, sf_dir, "trust_docs")
    return docs.groupBy("case_id").agg(F.count("*").alias("docs")).join(trust.assemble(docs), "case_id").select("case_id", "docs", "complete", F.col("distribution_stmt.income").alias("income"))


@query(f"SELECT case_id, tr_income IS NOT NULL AND di_income IS NOT NULL AND in_income IS NOT NULL AND be_income IS NOT NULL AS complete, '51824753556' AS trust_abn, di_income AS income, {_DISC} AS discrepancy, CASE WHEN {_DISC} = 'none' THEN 'compliant' ELSE 'non_compliant' END AS status, {_AGREE('income')} AS income_agrees, {_AGREE('franking')} AS franking_agrees, {_AGREE('cgt')} AS cgt_agrees FROM {_QUADS}")
def tru2_compliance(spark, sf_dir):
    return trust.compliance(trust.assemble(view(spark, sf_dir, "trust_docs")))


@query(f"SELECT discrepancy, count(*) AS n, round(avg(income), 4) AS avg_income FROM (SELECT di_income AS income, {_DISC} AS discrepancy FROM {_QUADS}) GROUP BY discrepancy")
def agg10_trust_summary(spark, sf_dir):
    return trust.compliance(trust.assemble(view(spark, sf_dir, "trust_docs"))).groupBy("discrepancy").agg(F.count("*").alias("n"), F.round(F.avg("income"), 4).alias("avg_income"))


# --- scores ----------------------------------------------------------------------------------
_B = "CASE WHEN lower({x}) IN ('true', '1', 'yes', 'y') THEN true WHEN lower({x}) IN ('false', '0', 'no', 'n') THEN false END"
_D = "try_cast(regexp_replace({x}, '[^0-9.\\-]', '', 'g') AS DOUBLE)"
_F1 = f"""round(CASE WHEN t = 'NOT_FOUND' THEN (v = 'NOT_FOUND')::INT::DOUBLE WHEN v = 'NOT_FOUND' THEN 0.0
    WHEN field = 'IS_GST_INCLUDED' THEN coalesce({_B.format(x='v')} = {_B.format(x='t')}, false)::INT::DOUBLE
    WHEN field = 'TOTAL_AMOUNT' THEN coalesce(abs({_D.format(x='v')} - {_D.format(x='t')}) <= CASE WHEN {_D.format(x='t')} <> 0 THEN abs({_D.format(x='t')} * 0.01) ELSE 0.01 END, false)::INT::DOUBLE
    WHEN field = 'BUSINESS_ABN' THEN (v = t)::INT::DOUBLE
    ELSE CASE WHEN 1.0 - levenshtein(lower(v), lower(t)) / greatest(length(v), length(t))::DOUBLE >= 0.5 THEN 1.0 - levenshtein(lower(v), lower(t)) / greatest(length(v), length(t))::DOUBLE ELSE 0.0 END END, 6)"""
_SCORES = f"(SELECT doc, field, f1, (t <> 'NOT_FOUND' AND f1 > 0.5)::BIGINT AS tp, (CASE WHEN t = 'NOT_FOUND' THEN v <> 'NOT_FOUND' ELSE v <> 'NOT_FOUND' AND f1 <= 0.5 END)::BIGINT AS fp, (t <> 'NOT_FOUND' AND f1 <= 0.5)::BIGINT AS fn FROM (SELECT *, {_F1} AS f1 FROM (SELECT doc, field, g.value AS t, p.value AS v FROM gt_fields g JOIN pred_fields p USING (doc, field))))"


def _scores(spark, sf_dir):
    return scoring.score_fields(view(spark, sf_dir, "pred_fields"), view(spark, sf_dir, "gt_fields"))


@query(f"SELECT * FROM {_SCORES}")
def evl1_field_scores(spark, sf_dir):
    return _scores(spark, sf_dir)


@query(f"SELECT doc, round(avg(f1), 6) AS mean_f1, round(median(f1), 6) AS median_f1, count(*) FILTER (f1 = 1) AS perfect, count(*) AS fields, round(avg(f1), 6) >= 0.8 AS meets FROM {_SCORES} GROUP BY doc")
def agg3_document_summary(spark, sf_dir):
    return scoring.document_summary(_scores(spark, sf_dir))


@query(f"SELECT field, round(avg(f1), 6) AS mean_f1, round(stddev_pop(f1), 6) AS sd, round(greatest(0.0, avg(f1) - 1.96 * stddev_pop(f1) / sqrt(count(*))), 6) AS low, round(least(1.0, avg(f1) + 1.96 * stddev_pop(f1) / sqrt(count(*))), 6) AS high, count(*) AS n FROM {_SCORES} GROUP BY field")
def agg5_field_distribution(spark, sf_dir):
    return scoring.field_distribution(_scores(spark, sf_dir))


_P, _R = "CASE WHEN tp + fp > 0 THEN tp / (tp + fp)::DOUBLE ELSE 0.0 END", "CASE WHEN tp + fn > 0 THEN tp / (tp + fn)::DOUBLE ELSE 0.0 END"
_F = f"CASE WHEN {_P} + {_R} > 0 THEN 2 * ({_P}) * ({_R}) / (({_P}) + ({_R})) ELSE 0.0 END"


@query(f"SELECT *, round({_P}, 6) AS micro_precision, round({_R}, 6) AS micro_recall, round({_F}, 6) AS micro_f1 FROM (SELECT field, count(DISTINCT doc) AS docs, round(avg(f1), 6) AS macro_f1, round(stddev_samp(f1), 6) AS sd, min(f1) AS least, max(f1) AS most, sum(tp)::BIGINT AS tp, sum(fp)::BIGINT AS fp, sum(fn)::BIGINT AS fn FROM {_SCORES} GROUP BY field)")
def agg6_macro_micro(spark, sf_dir):
    return scoring.macro_micro(_scores(spark, sf_dir))


_NUM_EQ = "coalesce(abs(CAST(got AS DOUBLE) - CAST(want AS DOUBLE)) <= abs(CAST(want AS DOUBLE) * 0.01), false)"
_LISTS = f"(SELECT doc, count(*) FILTER ({_NUM_EQ}) AS tp, count(*) FILTER (want IS NULL) AS fp, count(*) FILTER (want IS NOT NULL AND NOT {_NUM_EQ}) AS fn FROM (SELECT doc, pos, g.item AS want, p.item AS got FROM gt_items g FULL OUTER JOIN pred_items p USING (doc, pos)) GROUP BY doc)"


@query(f"SELECT *, round({_P}, 6) AS precision, round({_R}, 6) AS recall, round({_F}, 6) AS f1 FROM {_LISTS}")
def evl1_win8_list_scores(spark, sf_dir):
    return scoring.score_lists(view(spark, sf_dir, "pred_items"), view(spark, sf_dir, "gt_items"))


_BAGS = "(SELECT doc, sum(least(want, got))::BIGINT AS tp, (sum(got) - sum(least(want, got)))::BIGINT AS fp, (sum(want) - sum(least(want, got)))::BIGINT AS fn FROM (SELECT doc, item, coalesce(g.n, 0) AS want, coalesce(p.n, 0) AS got FROM (SELECT doc, item, count(*) AS n FROM gt_items GROUP BY ALL) g FULL OUTER JOIN (SELECT doc, item, count(*) AS n FROM pred_items GROUP BY ALL) p USING (doc, item)) GROUP BY doc)"


@query(f"SELECT *, round({_P}, 6) AS precision, round({_R}, 6) AS recall, round({_F}, 6) AS f1 FROM {_BAGS}")
def evl2_position_agnostic(spark, sf_dir):
    return scoring.position_agnostic(view(spark, sf_dir, "pred_items"), view(spark, sf_dir, "gt_items"))
