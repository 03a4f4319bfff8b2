"""More queries of filters, lookups, lists, routing and reports, each with its SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerloom.functions import text
from ledgerloom.operators import analytics, rules
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


def _table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- filters and projections -------------------------------------------------------------------
@query("SELECT lower(doc_type) IN ('invoice', 'other') AS skipped, count(*) AS n FROM runs GROUP BY 1")
def flt1_skip_labels(spark, sf_dir):
    skipped = F.lower("doc_type").isin("invoice", "other")
    return view(spark, sf_dir, "runs").groupBy(skipped.alias("skipped")).agg(F.count("*").alias("n"))


@query("SELECT doc, string_agg(field, ',' ORDER BY field) AS asked FROM gt_fields WHERE field NOT IN ('ACCOUNT_BALANCE', 'PAYER_NAME') GROUP BY doc")
def flt9_flt15_evaluation_fields(spark, sf_dir):
    have = view(spark, sf_dir, "gt_fields").groupBy("doc").agg(F.collect_set("field").alias("f"))
    return have.select("doc", F.array_join(F.array_sort(F.array_except("f", F.array(F.lit("ACCOUNT_BALANCE"), F.lit("PAYER_NAME")))), ",").alias("asked"))


@query("SELECT doc, field FROM pred_fields WHERE value IS NOT NULL AND trim(value) <> '' AND value[1:1] <> '[' AND lower(value) NOT IN ('wrong', 'unknown', 'not_found', 'n/a')")
def flt10_placeholders(spark, sf_dir):
    v = F.col("value")
    return view(spark, sf_dir, "pred_fields").filter(v.isNotNull() & (F.trim(v) != "") & ~v.startswith("[") & ~F.lower(v).isin("wrong", "unknown", "not_found", "n/a")).select("doc", "field")


@query("SELECT r.case_id, r.rid FROM receipts r JOIN bank_rows b ON r.case_id = b.case_id AND r.rid = b.pos AND lower(trim(r.supplier)) = lower(trim(b.description))")
def flt11_row_echo(spark, sf_dir):
    r, b = view(spark, sf_dir, "receipts"), view(spark, sf_dir, "bank_rows").withColumnRenamed("pos", "rid")
    return r.join(b, ["case_id", "rid"]).filter(F.lower(F.trim("supplier")) == F.lower(F.trim("description"))).select("case_id", "rid")


@query("SELECT case_id, count(*) FILTER (total IS NOT NULL AND receipt_date IS NOT NULL) AS aligned, count(*) FILTER (total IS NULL OR receipt_date IS NULL) AS dropped FROM receipts GROUP BY case_id")
def flt14_complete_rows(spark, sf_dir):
    whole = F.col("total").isNotNull() & F.col("receipt_date").isNotNull()
    return view(spark, sf_dir, "receipts").groupBy("case_id").agg(F.count_if(whole).alias("aligned"), F.count_if(~whole).alias("dropped"))


@query("SELECT doc, count(*) AS fields, round(avg(f1), 6) AS mean_f1, sum(tp)::BIGINT AS tp FROM runs GROUP BY doc")
def prj4_per_document(spark, sf_dir):
    return view(spark, sf_dir, "runs").groupBy("doc").agg(F.count("*").alias("fields"), F.round(F.avg("f1"), 6).alias("mean_f1"), F.sum("tp").alias("tp"))


@query("SELECT doc, max(value) FILTER (field = 'SUPPLIER_NAME') AS supplier, max(lower(value)) FILTER (field = 'IS_GST_INCLUDED') AS gst, '$' || max(value) FILTER (field = 'TOTAL_AMOUNT') AS total, 'NOT_FOUND' AS invoice_date FROM gt_fields GROUP BY doc")
def prj1_prj2_schema_projection(spark, sf_dir):
    names = ["SUPPLIER_NAME", "IS_GST_INCLUDED", "TOTAL_AMOUNT", "INVOICE_DATE"]
    wide = view(spark, sf_dir, "gt_fields").groupBy("doc").pivot("field", names).agg(F.max("value"))
    or_missing = lambda c: F.coalesce(F.col(c), F.lit(text.MISSING))
    return wide.select("doc", or_missing("SUPPLIER_NAME").alias("supplier"), F.lower(or_missing("IS_GST_INCLUDED")).alias("gst"), F.concat(F.lit("$"), F.col("TOTAL_AMOUNT")).alias("total"), or_missing("INVOICE_DATE").alias("invoice_date"))


@query("SELECT doc, round(100 * max(f1) FILTER (model = 'alpha'), 4) AS accuracy_alpha, round(100 * max(f1) FILTER (model = 'beta'), 4) AS accuracy_beta FROM runs GROUP BY doc")
def prj7_accuracy_columns(spark, sf_dir):
    wide = view(spark, sf_dir, "runs").groupBy("doc").pivot("model", ["alpha", "beta"]).agg(F.max("f1"))
    return wide.select("doc", *[F.round(100 * F.col(m), 4).alias(f"accuracy_{m}") for m in ("alpha", "beta")])


# --- lookups -----------------------------------------------------------------------------------
@query("SELECT o_orderkey AS doc, CASE WHEN o_orderkey % 3 = 0 THEN 'name' WHEN o_orderkey % 3 = 1 THEN 'stem' ELSE 'none' END AS found FROM orders")
def jn4_jn19_name_then_stem(spark, sf_dir):
    key = F.col("o_orderkey")
    docs = _table(spark, sf_dir, "orders").select(key.alias("doc"), F.concat(F.lit("img"), key, F.lit(".png")).alias("name"))
    truth = docs.filter("doc % 3 <> 2").select(F.when(F.col("doc") % 3 == 0, F.col("name")).otherwise(F.concat(F.lit("img"), "doc", F.lit(".jpg"))).alias("gt_name"))
    stem = lambda c: F.regexp_replace(c, r"\.[^.]*$", "")
    by_name = docs.join(truth.select(F.col("gt_name").alias("name"), F.lit(True).alias("exact")), "name", "left")
    stems = truth.select(stem(F.col("gt_name")).alias("stem"), F.lit(True).alias("near")).distinct()
    return by_name.withColumn("stem", stem(F.col("name"))).join(stems, "stem", "left").select("doc", F.when(F.col("exact"), "name").when(F.col("near"), "stem").otherwise("none").alias("found"))


@query("SELECT count(*) FILTER (p.doc IS NOT NULL) AS matched, count(*) FILTER (p.doc IS NULL) AS unmatched FROM gt_items g LEFT JOIN pred_items p ON g.doc = p.doc AND g.pos = p.pos AND g.item = p.item")
def jn7_matched_and_unmatched(spark, sf_dir):
    g, p = view(spark, sf_dir, "gt_items"), view(spark, sf_dir, "pred_items").withColumn("hit", F.lit(True))
    return g.join(p, ["doc", "pos", "item"], "left").agg(F.count_if(F.col("hit")).alias("matched"), F.count_if(F.col("hit").isNull()).alias("unmatched"))


@query("SELECT a.field, count(*) AS n, round(avg(a.f1 - b.f1), 6) AS gap, count(*) FILTER (a.f1 > b.f1) AS wins FROM runs a JOIN runs b ON a.doc = b.doc AND b.model = 'beta' WHERE a.model = 'alpha' GROUP BY a.field")
def jn9_jn18_two_models(spark, sf_dir):
    r = view(spark, sf_dir, "runs")
    b = r.filter("model = 'beta'").select("doc", F.col("f1").alias("other"))
    return r.filter("model = 'alpha'").join(b, "doc").groupBy("field").agg(F.count("*").alias("n"), F.round(F.avg(F.col("f1") - F.col("other")), 6).alias("gap"), F.count_if(F.col("f1") > F.col("other")).alias("wins"))


@query("SELECT doc, sum(least(g, p))::BIGINT AS matched, sum(greatest(g - p, 0))::BIGINT AS missing, sum(greatest(p - g, 0))::BIGINT AS spurious FROM (SELECT doc, item, coalesce(a.n, 0) AS g, coalesce(b.n, 0) AS p FROM (SELECT doc, item, count(*) AS n FROM gt_items GROUP BY ALL) a FULL JOIN (SELECT doc, item, count(*) AS n FROM pred_items GROUP BY ALL) b USING (doc, item)) GROUP BY doc")
def jn13_multiset_difference(spark, sf_dir):
    number = lambda df, n: df.withColumn("k", F.row_number().over(Window.partitionBy("doc", "item").orderBy("pos"))).select("doc", "item", "k", F.lit(True).alias(n))
    both = number(view(spark, sf_dir, "gt_items"), "g").join(number(view(spark, sf_dir, "pred_items"), "p"), ["doc", "item", "k"], "full_outer")
    return both.groupBy("doc").agg(F.count_if(F.col("g") & F.col("p")).alias("matched"), F.count_if(F.col("p").isNull()).alias("missing"), F.count_if(F.col("g").isNull()).alias("spurious"))


@query("SELECT c_nationkey AS institution, c_custkey AS doc, first_value(c_mktsegment) OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS cached FROM customer")
def jn17_institution_cache(spark, sf_dir):
    docs = _table(spark, sf_dir, "customer")
    first = docs.groupBy("c_nationkey").agg(F.min_by("c_mktsegment", "c_custkey").alias("cached"))  # combined before the shuffle, however many share an institution
    return docs.join(first, "c_nationkey").select(F.col("c_nationkey").alias("institution"), F.col("c_custkey").alias("doc"), "cached")


@query("SELECT o_custkey AS key, count(*) AS n FROM orders WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey) GROUP BY o_custkey")
def jn16_jn20_semi_join(spark, sf_dir):
    o, li = _table(spark, sf_dir, "orders"), _table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return o.join(li, "o_orderkey", "left_semi").groupBy(F.col("o_custkey").alias("key")).agg(F.count("*").alias("n"))


# --- lists ------------------------------------------------------------------------------------
@query("SELECT case_id, i AS idx, CASE WHEN i = 0 THEN 's0' ELSE 's1' END AS store, CAST(i AS VARCHAR) AS total FROM (SELECT DISTINCT case_id FROM bank_rows) CROSS JOIN (SELECT unnest(range(4)) AS i)")
def arr2_multi_receipts(spark, sf_dir):
    lists = view(spark, sf_dir, "bank_rows").select("case_id").distinct().select("case_id", F.lit("s0 | s1").alias("stores"), F.lit("0 | 1 | 2 | 3").alias("totals"))
    stores = text.split_items(F.col("stores"))
    return lists.select("case_id", stores.alias("s"), F.posexplode(text.split_items(F.col("totals"))).alias("i", "total")).select("case_id", F.col("i").cast("long").alias("idx"), F.get("s", F.least(F.col("i"), F.size("s") - 1)).alias("store"), "total")


@query("SELECT case_id, CASE WHEN dated = 0 THEN 0 ELSE least(dated, n) END::BIGINT AS kept FROM (SELECT case_id, count(*) AS n, count(*) FILTER (pos % 4 <> 0) AS dated FROM bank_rows GROUP BY case_id)")
def arr5_arr6_shortest(spark, sf_dir):
    t = view(spark, sf_dir, "bank_rows").groupBy("case_id").agg(F.collect_list("amount").alias("a"), F.collect_list(F.when(F.col("pos") % 4 != 0, F.col("txn_date"))).alias("d"))
    n = F.when((F.size("a") == 0) | (F.size("d") == 0), 0).otherwise(F.least(F.size("a"), F.size("d")))
    return t.select("case_id", F.size(F.slice("a", F.lit(1), n)).cast("long").alias("kept"))


@query("SELECT case_id, CAST(min(txn_date) AS VARCHAR) || ' - ' || CAST(max(txn_date) AS VARCHAR) AS span FROM bank_rows GROUP BY case_id")
def dat8_date_range(spark, sf_dir):
    return view(spark, sf_dir, "bank_rows").groupBy("case_id").agg(F.concat_ws(" - ", F.min("txn_date").cast("string"), F.max("txn_date").cast("string")).alias("span"))


# --- rules and labels ---------------------------------------------------------------------------
@query("SELECT model, CASE WHEN avg(f1) * 100 >= 95 THEN 'READY' WHEN avg(f1) * 100 >= 80 THEN 'PILOT' ELSE 'NEEDS_WORK' END AS label FROM runs GROUP BY model")
def rul19_readiness(spark, sf_dir):
    return view(spark, sf_dir, "runs").groupBy("model").agg(rules.readiness(F.avg("f1") * 100).alias("label"))


@query("SELECT field, CASE WHEN abs(d) < 0.2 THEN 'negligible' WHEN abs(d) < 0.5 THEN 'small' WHEN abs(d) < 0.8 THEN 'medium' ELSE 'large' END AS effect FROM (SELECT field, (avg(f1) - 0.5) / stddev_samp(f1) AS d FROM runs GROUP BY field)")
def rul20_effect_size(spark, sf_dir):
    t = view(spark, sf_dir, "runs").groupBy("field").agg(((F.avg("f1") - 0.5) / F.stddev_samp("f1")).alias("d"))
    return t.select("field", analytics.effect_label(F.col("d")).alias("effect"))


@query("SELECT case_id, pos, CASE WHEN d IS NULL THEN 'UNKNOWN' WHEN d < 0 THEN 'DEBIT' WHEN d > 0 THEN 'CREDIT' ELSE 'UNKNOWN' END AS kind, CASE WHEN d IS NULL THEN 0.80 WHEN abs(abs(d) - amount) < 0.01 THEN 0.95 ELSE 0.85 END::DOUBLE AS confidence FROM (SELECT *, round(true_balance - lag(true_balance) OVER (PARTITION BY case_id ORDER BY pos), 2) AS d FROM register)")
def rul17_bnk2_final_type(spark, sf_dir):
    d = F.round(F.col("true_balance") - F.lag("true_balance").over(Window.partitionBy("case_id").orderBy("pos")), 2)
    t = view(spark, sf_dir, "register").withColumn("d", d)
    return t.select("case_id", "pos", F.when(F.col("d") < 0, "DEBIT").when(F.col("d") > 0, "CREDIT").otherwise("UNKNOWN").alias("kind"), F.when(F.col("d").isNull(), 0.80).when(F.abs(F.abs("d") - F.col("amount")) < 0.01, 0.95).otherwise(0.85).alias("confidence"))


# --- reports ------------------------------------------------------------------------------------
@query("SELECT case_id, count(*) AS n, round(sum(amount), 2) AS total FROM (SELECT CASE WHEN pos % 6 = 0 THEN '_ungrouped' ELSE 'CASE' || case_id END AS case_id, amount FROM bank_rows) GROUP BY case_id")
def agg1_group_by_case(spark, sf_dir):
    name = F.when(F.col("pos") % 6 == 0, F.lit("scan.png")).otherwise(F.concat(F.lit("CASE"), "case_id", F.lit("_1.png")))
    return view(spark, sf_dir, "bank_rows").groupBy(text.case_id(name).alias("case_id")).agg(F.count("*").alias("n"), F.round(F.sum("amount"), 2).alias("total"))


@query("SELECT count(*) AS docs, round(avg(m), 6) AS mean_of_means, round(avg(d), 6) AS mean_of_medians FROM (SELECT doc, avg(f1) AS m, median(f1) AS d FROM runs GROUP BY doc)")
def agg4_corpus_means(spark, sf_dir):
    t = view(spark, sf_dir, "runs").groupBy("doc").agg(F.avg("f1").alias("m"), F.median("f1").alias("d"))
    return t.agg(F.count("*").alias("docs"), F.round(F.avg("m"), 6).alias("mean_of_means"), F.round(F.avg("d"), 6).alias("mean_of_medians"))


@query("SELECT metric, count(value) AS n, round(avg(value), 6) AS mean, round(median(value), 6) AS median, round(stddev_samp(value), 6) AS sd, min(value) AS least, max(value) AS most FROM (SELECT unnest(['f1', 'seconds']) AS metric, unnest([f1, seconds]) AS value FROM runs) GROUP BY metric")
def agg7_agg14_execution_summary(spark, sf_dir):
    return analytics.summary(view(spark, sf_dir, "runs").unpivot("doc", ["f1", "seconds"], "metric", "value"), ["metric"], "value")


@query("SELECT best, count(*) AS fields FROM (SELECT field, arg_max(model, (m, model)) AS best FROM (SELECT field, model, round(avg(f1), 6) AS m FROM runs GROUP BY 1, 2) GROUP BY field) GROUP BY best")
def agg18_specialisation(spark, sf_dir):
    m = view(spark, sf_dir, "runs").groupBy("field", "model").agg(F.round(F.avg("f1"), 6).alias("m"))
    return m.groupBy("field").agg(F.max_by("model", F.struct("m", "model")).alias("best")).groupBy("best").agg(F.count("*").alias("fields"))


@query("SELECT field, count(*) FILTER (v = t) AS correct, count(*) FILTER (v <> t AND v <> 'NOT_FOUND') AS incorrect, count(*) FILTER (v <> t AND v = 'NOT_FOUND') AS not_found FROM (SELECT g.field, g.value AS t, p.value AS v FROM gt_fields g JOIN pred_fields p ON g.doc = p.doc AND g.field = p.field) GROUP BY field")
def agg20_field_status(spark, sf_dir):
    j = view(spark, sf_dir, "gt_fields").withColumnRenamed("value", "t").join(view(spark, sf_dir, "pred_fields"), ["doc", "field"])
    same, gone = F.col("value") == F.col("t"), F.col("value") == text.MISSING
    return j.groupBy("field").agg(F.count_if(same).alias("correct"), F.count_if(~same & ~gone).alias("incorrect"), F.count_if(~same & gone).alias("not_found"))


@query("SELECT field, model, count(*) AS support, round(avg(CASE WHEN tp + fp > 0 THEN tp / (tp + fp)::DOUBLE ELSE 0 END), 6) AS p, round(avg(CASE WHEN tp + fn > 0 THEN tp / (tp + fn)::DOUBLE ELSE 0 END), 6) AS r, round(stddev_pop(f1), 6) AS sd_population, round(stddev_samp(f1), 6) AS sd_sample FROM runs GROUP BY 1, 2")
def agg21_agg42_support(spark, sf_dir):
    share = lambda other: F.when(F.col("tp") + F.col(other) > 0, F.col("tp") / (F.col("tp") + F.col(other))).otherwise(0.0)
    return view(spark, sf_dir, "runs").groupBy("field", "model").agg(
        F.count("*").alias("support"), F.round(F.avg(share("fp")), 6).alias("p"), F.round(F.avg(share("fn")), 6).alias("r"),
        F.round(F.stddev_pop("f1"), 6).alias("sd_population"), F.round(F.stddev_samp("f1"), 6).alias("sd_sample"),
    )


@query("SELECT doc_type AS layout, sum(tp)::BIGINT AS matched, sum(fn)::BIGINT AS missed, sum(fp)::BIGINT AS spurious, round(sum(tp) / sum(tp + fn)::DOUBLE, 6) AS recall, CASE WHEN sum(fn) > sum(fp) THEN 'missing' WHEN sum(fp) > sum(fn) THEN 'spurious' ELSE 'even' END AS dominant, sum(tp + fp) / sum(tp + fn)::DOUBLE < 0.9 AS under FROM runs GROUP BY doc_type")
def agg30_agg31_layout_recall(spark, sf_dir):
    t = view(spark, sf_dir, "runs").groupBy(F.col("doc_type").alias("layout")).agg(F.sum("tp").alias("matched"), F.sum("fn").alias("missed"), F.sum("fp").alias("spurious"))
    m, f, s = F.col("matched"), F.col("missed"), F.col("spurious")
    return t.select("*", F.round(m / (m + f), 6).alias("recall"), F.when(f > s, "missing").when(s > f, "spurious").otherwise("even").alias("dominant"), ((m + s) / (m + f) < 0.9).alias("under"))


@query("SELECT model, doc_type, round(avg(f1) / avg(seconds), 6) AS efficiency, round(stddev_samp(f1), 6) AS consistency, rank() OVER (PARTITION BY doc_type ORDER BY round(avg(f1), 6) DESC, model) AS place FROM runs GROUP BY model, doc_type")
def agg39_leaders(spark, sf_dir):
    t = view(spark, sf_dir, "runs").groupBy("model", "doc_type").agg(F.round(F.avg("f1"), 6).alias("m"), F.round(F.avg("f1") / F.avg("seconds"), 6).alias("efficiency"), F.round(F.stddev_samp("f1"), 6).alias("consistency"))
    return t.withColumn("place", F.rank().over(Window.partitionBy("doc_type").orderBy(F.desc("m"), "model")).cast("long")).drop("m")


@query("SELECT field, round(avg(f1), 6) AS with_missing, round(avg(f1) FILTER (NOT both_missing), 6) AS without FROM (SELECT g.field, (g.value = p.value)::INT AS f1, g.value = 'NOT_FOUND' AND p.value = 'NOT_FOUND' AS both_missing FROM gt_fields g JOIN pred_fields p ON g.doc = p.doc AND g.field = p.field) GROUP BY field")
def agg41_skip_missing(spark, sf_dir):
    j = view(spark, sf_dir, "gt_fields").withColumnRenamed("value", "t").join(view(spark, sf_dir, "pred_fields"), ["doc", "field"])
    f1, gone = (F.col("t") == F.col("value")).cast("int"), (F.col("t") == text.MISSING) & (F.col("value") == text.MISSING)
    return j.groupBy("field").agg(F.round(F.avg(f1), 6).alias("with_missing"), F.round(F.avg(F.when(~gone, f1)), 6).alias("without"))


@query("SELECT doc, CASE WHEN tp + fp + fn = 0 THEN 1.0 ELSE round(2 * tp / (2 * tp + fp + fn)::DOUBLE, 6) END AS f1 FROM (SELECT doc, count(*) FILTER (want = got) AS tp, count(*) FILTER (got IS NOT NULL AND got IS DISTINCT FROM want) AS fp, count(*) FILTER (want IS NOT NULL AND got IS DISTINCT FROM want) AS fn FROM (SELECT doc, pos, g.item AS want, p.item AS got FROM gt_items g FULL JOIN pred_items p USING (doc, pos)) GROUP BY doc)")
def evl9_zip_scorer(spark, sf_dir):
    both = view(spark, sf_dir, "gt_items").withColumnRenamed("item", "want").join(view(spark, sf_dir, "pred_items").withColumnRenamed("item", "got"), ["doc", "pos"], "full_outer")
    same = F.col("want").eqNullSafe(F.col("got"))
    t = both.groupBy("doc").agg(F.count_if(same).alias("tp"), F.count_if(F.col("got").isNotNull() & ~same).alias("fp"), F.count_if(F.col("want").isNotNull() & ~same).alias("fn"))
    n = 2 * F.col("tp") + F.col("fp") + F.col("fn")
    return t.select("doc", F.when(n == 0, 1.0).otherwise(F.round(2 * F.col("tp") / n, 6)).alias("f1"))


@query("SELECT field, spread FROM (SELECT field, round(max(m) - min(m), 6) AS spread FROM (SELECT field, model, avg(f1) AS m FROM runs GROUP BY 1, 2) GROUP BY field) ORDER BY spread DESC, field LIMIT 5")
def srt6_srt9_widest_spread(spark, sf_dir):
    m = view(spark, sf_dir, "runs").groupBy("field", "model").agg(F.avg("f1").alias("m"))
    return m.groupBy("field").agg(F.round(F.max("m") - F.min("m"), 6).alias("spread")).orderBy(F.desc("spread"), "field").limit(5)


@query("SELECT case_id, pos, description FROM (SELECT *, row_number() OVER (PARTITION BY case_id, description ORDER BY pos) AS r FROM bank_rows) WHERE r = 1 OR description = ''")
def win5_win6_first_seen(spark, sf_dir):
    w = Window.partitionBy("case_id", "description").orderBy("pos")
    t = view(spark, sf_dir, "bank_rows").withColumn("r", F.row_number().over(w))
    return t.filter((F.col("r") == 1) | (F.col("description") == "")).select("case_id", "pos", "description")


@query("SELECT doc, model, CASE (doc * 31 + length(model)) % 4 WHEN 0 THEN 'kept' WHEN 1 THEN 'dropped' WHEN 2 THEN 'truncated' ELSE 'scaled' END AS change, CASE (doc * 31 + length(model)) % 4 WHEN 0 THEN f1 WHEN 1 THEN NULL WHEN 2 THEN floor(f1 * 10) / 10 ELSE f1 * 2 END AS value FROM runs")
def syn1_seeded_changes(spark, sf_dir):
    k, f1 = (F.col("doc") * 31 + F.length("model")) % 4, F.col("f1")
    change = F.when(k == 0, "kept").when(k == 1, "dropped").when(k == 2, "truncated").otherwise("scaled")
    return view(spark, sf_dir, "runs").select("doc", "model", change.alias("change"), F.when(k == 0, f1).when(k == 2, F.floor(f1 * 10) / 10).when(k == 3, f1 * 2).alias("value"))
