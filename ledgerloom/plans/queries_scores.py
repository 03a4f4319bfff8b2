"""Queries of list scores, link and trust metrics, model comparisons and reports, each with its SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerloom.functions import money, text
from ledgerloom.operators import analytics, linking, parsers, scoring, trust
from ledgerloom.plans import queries_records
from ledgerloom.plans.views import duck, view

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None):
    """Register a query under its function's name, with DuckDB SQL over the record views."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = duck(sql)
        return f

    return add


def _table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- lists -------------------------------------------------------------------------------------
_WORDS = lambda x: f"list_distinct(list_filter(regexp_split_to_array(lower(trim({x})), '\\s+'), lambda z: z <> ''))"
_ALIKE = lambda a, b: f"(1 - levenshtein(lower(trim({a})), lower(trim({b}))) / greatest(length(trim({a})), length(trim({b})))::DOUBLE >= 0.9 OR len(list_intersect({_WORDS(a)}, {_WORDS(b)})) / len(list_distinct(list_concat({_WORDS(a)}, {_WORDS(b)})))::DOUBLE >= 0.75)"


@query(f"""WITH RECURSIVE w AS (SELECT doc, list(want ORDER BY pos) AS l FROM item_pairs GROUP BY doc), e AS (SELECT doc, coalesce(list(got ORDER BY pos DESC) FILTER (WHERE got IS NOT NULL), []) AS l FROM item_pairs GROUP BY doc),
    s(doc, k, used) AS (SELECT doc, 0, []::BIGINT[] FROM w
      UNION ALL SELECT doc, k + 1, CASE WHEN hit IS NULL THEN used ELSE list_append(used, hit) END
      FROM (SELECT s.doc, s.k, s.used, list_filter(range(1, len(w.l) + 1), lambda i: NOT list_contains(s.used, i) AND {_ALIKE('e.l[s.k + 1]', 'w.l[i]')})[1] AS hit FROM s JOIN w ON s.doc = w.doc JOIN e ON s.doc = e.doc WHERE s.k < len(e.l))),
    r AS (SELECT s.doc, len(s.used) AS tp, len(e.l) AS n_got, len(w.l) AS n_want FROM s JOIN w ON s.doc = w.doc JOIN e ON s.doc = e.doc WHERE s.k = len(e.l))
    SELECT doc, tp, n_got - tp AS fp, n_want - tp AS fn, least(n_got, n_want) - tp AS substitution, n_want - least(n_got, n_want) AS addition, n_got - least(n_got, n_want) AS deletion, round(1 - (greatest(n_got, n_want) - tp) / greatest(n_got, n_want)::DOUBLE, 6) AS score FROM r""")
def evl2_evl3_greedy_lists(spark, sf_dir):
    lists = view(spark, sf_dir, "item_pairs").groupBy("doc").agg(
        F.sort_array(F.collect_list(F.struct("pos", "want")))["want"].alias("want"),
        F.sort_array(F.collect_list(F.when(F.col("got").isNotNull(), F.struct("pos", "got"))), asc=False)["got"].alias("got"),
    )
    read = lambda c: F.transform(c, text.read_text)
    tp = lists.select("doc", scoring.greedy_matches(read("got"), read("want"), text.reads_equal).alias("tp"), F.size("got").cast("long").alias("g"), F.size("want").cast("long").alias("w"))
    cost = scoring.correction_cost(F.col("tp"), F.col("g"), F.col("w"))
    return tp.select("doc", "tp", (F.col("g") - F.col("tp")).alias("fp"), (F.col("w") - F.col("tp")).alias("fn"), *[(F.round(c, 6) if k == "score" else c).alias(k) for k, c in cost.items()])


@query("""SELECT doc, coalesce(string_agg(field, ',' ORDER BY field) FILTER (upper(trim(value)) = 'NOT_FOUND' AND upper(trim(truth)) <> 'NOT_FOUND'), '') AS missing, coalesce(string_agg(field, ',' ORDER BY field) FILTER (upper(trim(value)) <> 'NOT_FOUND' AND lower(trim(value)) <> lower(trim(truth))), '') AS incorrect
    FROM (SELECT g.doc, g.field, coalesce(p.value, 'NOT_FOUND') AS value, g.value AS truth FROM gt_fields g LEFT JOIN pred_fields p ON g.doc = p.doc AND g.field = p.field) GROUP BY doc""")
def evl8_evl14_missing_and_incorrect(spark, sf_dir):
    g = view(spark, sf_dir, "gt_fields").withColumnRenamed("value", "truth")
    return scoring.missing_and_incorrect(g.join(view(spark, sf_dir, "pred_fields"), ["doc", "field"], "left"))


_KEPT = "(SELECT case_id, pos, CASE WHEN case_id % 4 = 0 OR flag <> 'R' THEN CAST(CAST(amount AS DECIMAL(18,2)) AS VARCHAR) ELSE 'NOT_FOUND' END AS paid, description FROM bank_rows WHERE case_id % 9 <> 0 OR pos > 1)"


@query(f"""SELECT case_id, string_agg(description, ' | ' ORDER BY pos) FILTER (paid <> 'NOT_FOUND' OR k = 0) AS descriptions, string_agg(paid, ' | ' ORDER BY pos) FILTER (paid <> 'NOT_FOUND' OR k = 0) AS paid
    FROM (SELECT *, count(*) FILTER (paid <> 'NOT_FOUND') OVER (PARTITION BY case_id) AS k FROM {_KEPT}) GROUP BY case_id""")
def flt6_flt7_flt8_debit_rows(spark, sf_dir):
    rows = view(spark, sf_dir, "bank_rows").filter("case_id % 9 <> 0 OR pos > 1")
    paid = F.when((F.col("case_id") % 4 == 0) | (F.col("flag") != "R"), F.col("amount").cast("decimal(18,2)").cast("string")).otherwise(text.MISSING)
    lists = rows.withColumn("paid", paid).groupBy("case_id").agg(F.array_sort(F.collect_list(F.struct("pos", "paid", "description"))).alias("x"))
    text_of = lists.select("case_id", F.array_join(F.col("x.description"), " | ").alias("descriptions"), F.array_join(F.col("x.paid"), " | ").alias("paid"))
    kept = parsers.debit_rows({"descriptions": F.col("descriptions"), "paid": F.col("paid")}, "paid")
    return text_of.select("case_id", kept["descriptions"].alias("descriptions"), kept["paid"].alias("paid"))


# --- links and trust ---------------------------------------------------------------------------
_N = lambda *names: "count(*) FILTER (outcome IN (" + ", ".join(f"'{n}'" for n in names) + "))"


@query(f"""SELECT n, tp, tn, fp, fn, round((tp + tn) / n::DOUBLE, 6) AS accuracy, round(CASE WHEN tp + fp > 0 THEN tp / (tp + fp)::DOUBLE ELSE 0 END, 6) AS precision, round(CASE WHEN tp + fn > 0 THEN tp / (tp + fn)::DOUBLE ELSE 0 END, 6) AS recall, round(CASE WHEN located > 0 THEN tp / located::DOUBLE ELSE 0 END, 6) AS row_accuracy
    FROM (SELECT count(*) AS n, {_N('correct')} AS tp, {_N('true_negative')} AS tn, {_N('false_positive', 'wrong_row')} AS fp, {_N('false_negative', 'wrong_row')} AS fn, {_N('correct', 'wrong_row')} AS located FROM {queries_records._EVAL} WHERE outcome NOT IN ('no_ground_truth', 'missing_link'))""")
def agg9_link_metrics(spark, sf_dir):
    return linking.link_metrics(queries_records._evaluated(spark, sf_dir))


_CASES = "(SELECT DISTINCT case_id FROM bank_rows WHERE case_id % 6 <> 0)"


@query(f"""SELECT l.case_id, l.rid, l.pos, l.pos IS NOT NULL AND l.confidence IN ('MEDIUM', 'HIGH') AS matched, CASE WHEN l.pos IS NOT NULL AND l.confidence IN ('MEDIUM', 'HIGH') THEN l.confidence ELSE 'NONE' END AS confidence,
    NOT (l.pos IS NOT NULL AND l.confidence IN ('MEDIUM', 'HIGH')) AND c.case_id IS NOT NULL AS queued,
    CASE WHEN c.case_id IS NULL THEN 'no statement in this case' WHEN l.pos IS NOT NULL AND l.confidence IN ('MEDIUM', 'HIGH') THEN 'matched' WHEN l.pos IS NULL THEN 'no row of this amount' ELSE 'below the least confidence' END AS reasoning
    FROM (SELECT b.* REPLACE (CASE WHEN c2.case_id IS NULL THEN NULL ELSE b.pos END AS pos, CASE WHEN c2.case_id IS NULL THEN 'NONE' ELSE b.confidence END AS confidence) FROM {queries_records._BEST} b LEFT JOIN {_CASES} c2 ON b.case_id = c2.case_id) l LEFT JOIN {_CASES} c ON l.case_id = c.case_id""")
def lnk1_lnk2_rul13_link_records(spark, sf_dir):
    rows = view(spark, sf_dir, "bank_rows").filter("case_id % 6 <> 0")
    return linking.gated(linking.best_match(view(spark, sf_dir, "receipts"), rows), rows, "MEDIUM")


@query(f"SELECT r.case_id, r.rid, min(b.pos) AS pos FROM receipts r JOIN bank_rows b ON r.case_id = b.case_id AND abs(r.total - b.amount) <= 6 AND NOT EXISTS (SELECT 1 FROM {queries_records._BEST} l WHERE l.case_id = r.case_id AND l.rid = r.rid AND l.pos IS NOT NULL) GROUP BY 1, 2")
def jn15_first_statement_row(spark, sf_dir):
    receipts, rows = view(spark, sf_dir, "receipts"), view(spark, sf_dir, "bank_rows")
    done = linking.best_match(receipts, rows).filter("pos is not null").select("case_id", "rid")
    left = receipts.join(done, ["case_id", "rid"], "left_anti")
    return linking.candidates(left, rows, 6.0).groupBy("case_id", "rid").agg(F.min("pos").alias("pos"))


_PCT = lambda a, b: f"CASE WHEN greatest(abs({a}), abs({b})) = 0 THEN true ELSE abs({a} - {b}) / greatest(abs({a}), abs({b})) <= 0.01 END"
_TRUST = f"""(SELECT t.case_id, b.case_id IS NULL AS errored, coalesce(t.abn = b.abn, false) AS abn_right, coalesce({_PCT('b.income', 't.income')}, false) AS income_right, coalesce({_PCT('b.franking', 't.franking')}, false) AS franking_right, coalesce({_PCT('b.cgt', 't.cgt')}, false) AS cgt_right
    FROM trust_docs t LEFT JOIN trust_docs b ON t.case_id = b.case_id AND b.kind = 'income_schedule' WHERE t.kind = 'distribution_stmt')"""


@query(f"SELECT * FROM {_TRUST}")
def evl11_trust_cases(spark, sf_dir):
    d = view(spark, sf_dir, "trust_docs")
    return trust.evaluate_cases(d.filter("kind = 'income_schedule'"), d.filter("kind = 'distribution_stmt'"))


@query(f"""WITH m AS (SELECT count(*) FILTER (p AND a) AS tp, count(*) FILTER (p AND NOT a) AS fp, count(*) FILTER (NOT p AND a) AS fn, count(*) FILTER (NOT p AND NOT a) AS tn FROM (SELECT NOT errored AND NOT (abn_right AND income_right AND franking_right) AS p, case_id % 4 = 0 AS a FROM {_TRUST}))
    SELECT *, round(CASE WHEN tp + fp > 0 THEN tp / (tp + fp)::DOUBLE ELSE 0 END, 6) AS precision, round(CASE WHEN tp + fn > 0 THEN tp / (tp + fn)::DOUBLE ELSE 0 END, 6) AS recall, round(CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn)::DOUBLE ELSE 0 END, 6) AS f1, round(CASE WHEN fp + tn > 0 THEN fp / (fp + tn)::DOUBLE ELSE 0 END, 6) AS fpr FROM m""")
def agg10_trust_metrics(spark, sf_dir):
    d = view(spark, sf_dir, "trust_docs")
    cases = trust.evaluate_cases(d.filter("kind = 'income_schedule'"), d.filter("kind = 'distribution_stmt'"))
    # a case with an error counts as predicted compliant
    flagged = ~F.col("errored") & ~(F.col("abn_right") & F.col("income_right") & F.col("franking_right"))
    return analytics.binary_metrics(cases, flagged, F.col("case_id") % 4 == 0)


@query(f"SELECT label, unnest(['predicted', 'actual']) AS side, unnest([p, a]) AS n FROM (SELECT CASE WHEN case_id % 5 = 0 THEN 'income' ELSE 'abn' END AS label, count(*) FILTER (NOT income_right) AS p, count(*) FILTER (case_id % 3 = 0) AS a FROM {_TRUST} WHERE NOT errored GROUP BY 1)")
def agg36_discrepancies_by_side(spark, sf_dir):
    d = view(spark, sf_dir, "trust_docs")
    cases = trust.evaluate_cases(d.filter("kind = 'income_schedule'"), d.filter("kind = 'distribution_stmt'")).filter("not errored")
    n = cases.groupBy(F.when(F.col("case_id") % 5 == 0, "income").otherwise("abn").alias("label")).agg(F.count_if(~F.col("income_right")).alias("predicted"), F.count_if(F.col("case_id") % 3 == 0).alias("actual"))
    return n.unpivot("label", ["predicted", "actual"], "side", "n")


# --- models ------------------------------------------------------------------------------------
_MEANS = "(SELECT field, avg(f1) FILTER (model = 'alpha') AS x, avg(f1) FILTER (model = 'beta') AS y FROM runs WHERE model IN ('alpha', 'beta') GROUP BY field)"
_CAT = "CASE WHEN field IN ('field_0', 'field_1') THEN 'money' ELSE 'text' END"


def _means(spark, sf_dir):
    return analytics.field_means(view(spark, sf_dir, "runs"), "alpha", "beta")


@query(f"SELECT {_CAT} AS category, round(avg(x), 6) AS mean_x, round(avg(y), 6) AS mean_y, count(*) FILTER (round(x - y, 9) > 0) AS wins_x, count(*) FILTER (round(x - y, 9) < 0) AS wins_y, count(*) AS fields FROM {_MEANS} GROUP BY 1")
def agg28_categories(spark, sf_dir):
    return analytics.by_category(_means(spark, sf_dir), F.when(F.col("field").isin("field_0", "field_1"), "money").otherwise("text"))


_SPREAD = lambda c: f"round(avg({c}), 6) AS mean_{c}, round(median({c}), 6) AS median_{c}, round(stddev_samp({c}), 6) AS sd_{c}, round(min({c}), 6) AS least_{c}, round(max({c}), 6) AS most_{c}"


@query(f"SELECT {_SPREAD('x')}, {_SPREAD('y')}, count(*) FILTER (round(x - y, 9) > 0) AS wins, count(*) FILTER (round(x - y, 9) < 0) AS losses, count(*) FILTER (round(x - y, 9) = 0) AS ties, round(avg(x) FILTER (field = 'field_2'), 6) AS critical_x, round(avg(y) FILTER (field = 'field_2'), 6) AS critical_y FROM {_MEANS}")
def agg29_comparison(spark, sf_dir):
    return analytics.comparison(_means(spark, sf_dir), F.col("field") == "field_2")


@query(f"""WITH d AS (SELECT round(x - y, 9) AS d FROM {_MEANS}), r AS (SELECT d, rank() OVER (ORDER BY abs(d)) + (count(*) OVER (PARTITION BY abs(d)) - 1) / 2.0 AS k FROM d WHERE d <> 0)
    SELECT count(*) AS n, round(avg(d) / (stddev_samp(d) / sqrt(count(*))), 5) AS t, round(avg(d) / stddev_pop(d), 5) AS cohens_d, (SELECT round(coalesce(sum(k) FILTER (d > 0), 0), 6)::DOUBLE FROM r) AS w_plus, (SELECT round(coalesce(sum(k) FILTER (d < 0), 0), 6)::DOUBLE FROM r) AS w_minus FROM d""")
def evl13_signed_ranks(spark, sf_dir):
    return analytics.paired_ranks(_means(spark, sf_dir))


@query("SELECT model, count(*) AS images, count(*) FILTER (f1 >= 0.8) AS passed, sum(tp)::BIGINT AS correct, sum(tp + fn)::BIGINT AS total, round(sum(tp) / sum(tp + fn)::DOUBLE, 6) AS accuracy, round(avg(f1), 6) AS mean_f1 FROM runs GROUP BY model")
def agg32_batch_totals(spark, sf_dir):
    return view(spark, sf_dir, "runs").groupBy("model").agg(
        F.count("*").alias("images"), F.count_if(F.col("f1") >= 0.8).alias("passed"), F.sum("tp").alias("correct"), F.sum(F.col("tp") + F.col("fn")).alias("total"),
        F.round(F.sum("tp") / F.sum(F.col("tp") + F.col("fn")), 6).alias("accuracy"), F.round(F.avg("f1"), 6).alias("mean_f1"),
    )


@query("""WITH a AS (SELECT DISTINCT field FROM gt_fields WHERE field <> 'PAYER_NAME' UNION SELECT 'INVOICE_DATE'), e AS (SELECT DISTINCT field FROM pred_fields WHERE field <> 'TOTAL_AMOUNT' UNION SELECT 'EXTRA'), t AS (SELECT DISTINCT field FROM gt_fields WHERE field <> 'SUPPLIER_NAME'),
    f AS (SELECT field, bool_or(a) AS asked, bool_or(e) AS emitted, bool_or(t) AS truth FROM (SELECT field, true AS a, false AS e, false AS t FROM a UNION ALL SELECT field, false, true, false FROM e UNION ALL SELECT field, false, false, true FROM t) GROUP BY field)
    SELECT *, CASE WHEN asked AND emitted AND truth THEN 'scored' WHEN asked AND emitted THEN 'not in truth' WHEN asked AND truth THEN 'never emitted' WHEN emitted AND truth THEN 'not asked' WHEN asked THEN 'asked only' WHEN emitted THEN 'emitted only' ELSE 'truth only' END AS reason FROM f""")
def agg38_field_reconciliation(spark, sf_dir):
    g, p = view(spark, sf_dir, "gt_fields"), view(spark, sf_dir, "pred_fields")
    one = lambda v: spark.createDataFrame([(v,)], "field string")
    pick = lambda df, but: df.filter(F.col("field") != but).select("field")
    return analytics.reconciled(pick(g, "PAYER_NAME").unionByName(one("INVOICE_DATE")), pick(p, "TOTAL_AMOUNT").unionByName(one("EXTRA")), pick(g, "SUPPLIER_NAME"))


@query("SELECT a.doc, a.f1, b.seconds FROM runs a LEFT JOIN runs b ON a.doc = b.doc AND b.model = 'beta' AND b.tier <> 'heavy' WHERE a.model = 'alpha'")
def jn10_seconds_by_document(spark, sf_dir):
    r = view(spark, sf_dir, "runs")
    return r.filter("model = 'alpha'").select("doc", "f1").join(r.filter("model = 'beta' AND tier <> 'heavy'").select("doc", "seconds"), "doc", "left")


@query("SELECT (SELECT count(*) FROM (SELECT doc FROM runs WHERE model = 'alpha' AND f1 > 0.5 INTERSECT SELECT doc FROM runs WHERE model = 'beta' AND f1 > 0.5)) AS common, (SELECT count(DISTINCT case_id) FROM receipts WHERE case_id NOT IN (SELECT o_orderkey FROM orders WHERE o_orderkey % 4 = 0)) AS skipped")
def jn11_jn12_common_keys(spark, sf_dir):
    r = view(spark, sf_dir, "runs").filter("f1 > 0.5")
    pick = lambda m: r.filter(F.col("model") == m).select("doc")
    common = pick("alpha").distinct().join(pick("beta").distinct(), "doc").agg(F.count("*").alias("common"))
    have = _table(spark, sf_dir, "orders").filter("o_orderkey % 4 = 0").select(F.col("o_orderkey").alias("case_id"))
    skipped = view(spark, sf_dir, "receipts").join(have, "case_id", "left_anti").agg(F.countDistinct("case_id").alias("skipped"))
    return common.crossJoin(skipped)  # one row each


@query("SELECT field, round(max(m) - min(m), 6) AS spread FROM (SELECT field, model, avg(f1) AS m FROM runs GROUP BY 1, 2) GROUP BY field HAVING round(max(m) - min(m), 6) > 0.001 ORDER BY spread DESC, field LIMIT 5")
def srt6_wide_spreads(spark, sf_dir):
    return analytics.spread(view(spark, sf_dir, "runs"), 0.001)


@query("""WITH r AS (SELECT doc, f1, row_number() OVER (ORDER BY f1 DESC, doc) AS best, row_number() OVER (ORDER BY f1, doc) AS worst FROM runs WHERE model = 'alpha')
    SELECT doc, f1, 'top' AS part FROM r WHERE best <= 5 UNION ALL SELECT doc, f1, 'bottom' FROM r WHERE worst <= 5 UNION ALL SELECT doc, f1, 'below' FROM r WHERE f1 < 0.05""")
def srt5_best_and_worst(spark, sf_dir):
    r = view(spark, sf_dir, "runs").filter("model = 'alpha'").select("doc", "f1")
    part = lambda df, name: df.withColumn("part", F.lit(name))
    return part(r.orderBy(F.desc("f1"), "doc").limit(5), "top").unionByName(part(r.orderBy("f1", "doc").limit(5), "bottom")).unionByName(part(r.filter("f1 < 0.05"), "below"))


@query("SELECT r.field, round(avg(r.f1) FILTER (model = 'alpha'), 6) AS alpha, round(avg(r.f1) FILTER (model = 'beta'), 6) AS beta, t.place FROM runs r JOIN (SELECT field, row_number() OVER (ORDER BY round(avg(f1), 9) DESC, field) AS place FROM runs GROUP BY field ORDER BY place LIMIT 3) t ON r.field = t.field GROUP BY r.field, t.place")
def srt8_srt9_leading_fields(spark, sf_dir):
    r = view(spark, sf_dir, "runs")
    top = r.groupBy("field").agg(F.round(F.avg("f1"), 9).alias("m")).orderBy(F.desc("m"), "field").limit(3)
    place = F.row_number().over(Window.orderBy(F.desc("m"), "field")).cast("long")  # three rows
    return r.join(top.select("field", place.alias("place")), "field").groupBy("field", "place").pivot("model", ["alpha", "beta"]).agg(F.round(F.avg("f1"), 6))


@query("SELECT doc, string_agg(item, ' | ' ORDER BY d NULLS LAST, pos) AS items, string_agg(item, ' | ' ORDER BY d NULLS FIRST, pos) AS early FROM (SELECT case_id AS doc, pos, description AS item, CASE WHEN pos % 4 = 0 THEN NULL ELSE txn_date END AS d FROM bank_rows) GROUP BY doc")
def srt2_srt3_srt4_by_date(spark, sf_dir):
    rows = view(spark, sf_dir, "bank_rows").select(F.col("case_id").alias("doc"), "pos", F.col("description").alias("item"), F.when(F.col("pos") % 4 != 0, F.col("txn_date")).alias("d"))
    listed = lambda first: F.transform(F.array_sort(F.collect_list(F.struct(first.alias("k"), "d", "pos", "item"))), lambda x: x["item"])
    return rows.groupBy("doc").agg(F.array_join(listed(F.col("d").isNull()), " | ").alias("items"), F.array_join(listed(F.col("d").isNotNull()), " | ").alias("early"))


# --- responses ---------------------------------------------------------------------------------
@query("""SELECT doc, CASE WHEN has THEN 'json' ELSE 'none' END AS form, CASE WHEN has THEN amount END AS matched_transaction, CASE WHEN has THEN coalesce(nullif(trim(conf), ''), 'NOT_FOUND') END AS confidence
    FROM (SELECT o_orderkey AS doc, o_orderkey % 3 = 0 AS has, CAST(o_custkey AS VARCHAR) AS amount, CASE WHEN o_orderkey % 2 = 0 THEN 'HIGH' ELSE ' ' END AS conf FROM orders)""")
def jsn4_link_objects(spark, sf_dir):
    o, key = _table(spark, sf_dir, "orders"), F.col("o_orderkey")
    body = F.concat(F.lit('I found {"MATCHED_TRANSACTION": '), F.col("o_custkey").cast("string"), F.lit(', "CONFIDENCE": "'), F.when(key % 2 == 0, "HIGH").otherwise(" "), F.lit('", "NOTE": "x"}\nThanks'))
    raw = F.when(key % 3 == 0, body).when(key % 3 == 1, F.lit('{"CONFIDENCE": "HIGH"}')).otherwise(F.lit("{broken"))
    rows = o.select(key.alias("doc"), parsers.link_object(raw, ("MATCHED_TRANSACTION", "CONFIDENCE")).alias("m"))
    return rows.select("doc", F.when(F.col("m").isNotNull(), "json").otherwise("none").alias("form"), F.try_element_at("m", F.lit("MATCHED_TRANSACTION")).alias("matched_transaction"), F.try_element_at("m", F.lit("CONFIDENCE")).alias("confidence"))


@query("SELECT o_orderkey AS doc, CASE WHEN o_orderkey % 4 = 2 THEN 'NOT_FOUND' ELSE o_orderstatus END AS status, CASE WHEN o_orderkey % 4 = 1 THEN 'NOT_FOUND' ELSE CAST(o_custkey AS VARCHAR) END AS customer FROM orders")
def par1_par10_hybrid(spark, sf_dir):
    key, customer = F.col("o_orderkey"), F.col("o_custkey").cast("string")
    as_json = F.concat(F.lit('```json\n{"STATUS": "'), "o_orderstatus", F.lit('", "CUSTOMER": '), F.when(key % 4 == 1, "null").otherwise(customer), F.lit("}\n```"))
    as_text = F.concat_ws("\n", F.lit("Here it is:"), F.when(key % 4 != 2, F.concat(F.lit("Status: "), "o_orderstatus")), F.concat(F.lit("customer: "), F.when(key % 4 != 1, customer)), F.lit("OTHER: 3"), F.lit("Customer:"))
    rows = _table(spark, sf_dir, "orders").select(key.alias("doc"), F.when(key % 4 < 2, as_json).otherwise(as_text).alias("raw"))
    m = parsers.hybrid(F.col("raw"), ("STATUS", "CUSTOMER"))
    return rows.select("doc", m["STATUS"].alias("status"), m["CUSTOMER"].alias("customer"))
