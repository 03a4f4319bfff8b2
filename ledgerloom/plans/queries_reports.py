"""Queries of rules, parsers, reports, set operations and incremental reads, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.functions import text
from ledgerloom.operators import analytics, parsers, rules
from ledgerloom.plans.queries_records import duck
from ledgerloom.plans.views import view

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name, with DuckDB SQL over the record views."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE[f.__name__] = duck(sql)
        return f

    return add


MODELS = ["alpha", "beta", "gamma"]
TYPES = ["receipt", "invoice", "bank_statement", "other"]


# --- rules -----------------------------------------------------------------------------------
@query("SELECT case_id, pos, CASE WHEN pos % 3 = 0 THEN 'BANK_STATEMENT' WHEN pos % 5 = 0 THEN 'LOGBOOK' WHEN pos % 7 = 0 THEN 'TRAVEL' WHEN case_id % 2 = 0 THEN 'RECEIPT' ELSE 'INVOICE' END AS kind, CAST((pos % 3 = 0)::INT + (pos % 5 = 0)::INT + (pos % 7 = 0)::INT + (case_id % 2 = 0)::INT + (case_id % 4 = 1)::INT AS BIGINT) AS n_kinds, CASE WHEN pos <= 5 THEN 'LOW' WHEN pos <= 20 THEN 'MEDIUM' ELSE 'HIGH' END AS tier FROM bank_rows")
def rul1_rul2_rul6_evidence_rules(spark, sf_dir):
    t = view(spark, sf_dir, "bank_rows")
    roles = F.filter(F.array(F.when(F.col("pos") % 3 == 0, "debit"), F.when(F.col("pos") % 5 == 0, "odometer"), F.when(F.col("case_id") % 4 == 1, "gst")), lambda r: r.isNotNull())
    paid, travel = F.col("case_id") % 2 == 0, F.col("pos") % 7 == 0
    return t.select("case_id", "pos", rules.first_type(roles, paid, travel).alias("kind"), F.size(rules.all_types(roles, paid, travel)).cast("long").alias("n_kinds"), rules.complexity(F.col("pos")).alias("tier"))


@query("SELECT c_custkey AS id, CASE WHEN c_custkey % 6 = 0 THEN 'BENEFICIARY_ITR' WHEN c_custkey % 5 = 1 THEN 'INCOME_SCHEDULE' WHEN c_custkey % 5 = 2 THEN 'TRUST_RETURN' WHEN c_custkey % 5 = 3 THEN 'DISTRIBUTION_STMT' WHEN c_custkey % 2 = 0 THEN 'DISTRIBUTION_STMT' WHEN c_custkey % 3 = 0 AND c_custkey % 5 = 4 THEN 'TRUST_RETURN' ELSE '' END AS kind, CASE WHEN c_custkey % 6 = 0 THEN 0.95 WHEN c_custkey % 5 IN (1, 2, 3) THEN 0.85 WHEN c_custkey % 2 = 0 THEN 0.9 WHEN c_custkey % 3 = 0 AND c_custkey % 5 = 4 THEN 0.85 ELSE 0.0 END::DOUBLE AS confidence FROM customer")
def rul10_trust_types(spark, sf_dir):
    c = F.col("c_custkey")
    header = F.element_at(F.array(F.lit("Notice"), F.lit("Income Schedule"), F.lit("Trust tax return"), F.lit("Distribution statement"), F.lit("The Trust")), (c % 5 + 1).cast("int"))
    t = rules.trust_type(header, c % 6 == 0, c % 2 == 0, c % 2 == 0, c % 3 == 0)
    return spark.read.parquet(f"{sf_dir}/customer.parquet").select(c.alias("id"), t["type"].alias("kind"), t["confidence"].alias("confidence"))


@query("SELECT CASE WHEN contains(lower(p_name), 'bolt') THEN 'fastener' WHEN contains(lower(p_name), 'widget') THEN 'widget' ELSE 'other' END AS kind, count(*) AS n FROM part GROUP BY 1")
def rul4_rul5_substring_rules(spark, sf_dir):
    kind = rules.by_substring(F.col("p_name"), (("bolt", "fastener"), ("widget", "widget")), "other")
    return spark.read.parquet(f"{sf_dir}/part.parquet").groupBy(kind.alias("kind")).agg(F.count("*").alias("n"))


@query("SELECT doc, field, CASE WHEN v = 'NOT_FOUND' AND t <> 'NOT_FOUND' THEN 'missing' WHEN t = 'NOT_FOUND' AND v <> 'NOT_FOUND' THEN 'spurious' WHEN v = t THEN 'right' WHEN contains(t, ' ') AND v = array_to_string(list_reverse(string_split(t, ' ')), ' ') THEN 'reversed' WHEN contains(t, v) OR contains(v, t) THEN 'partial' ELSE 'wrong' END AS error FROM (SELECT g.doc, g.field, g.value AS t, p.value AS v FROM gt_fields g JOIN pred_fields p ON g.doc = p.doc AND g.field = p.field)")
def rul18_error_taxonomy(spark, sf_dir):
    g = view(spark, sf_dir, "gt_fields").withColumnRenamed("value", "t")
    v, t = F.col("value"), F.col("t")
    gone = lambda c: c == text.MISSING
    error = F.when(gone(v) & ~gone(t), "missing").when(gone(t) & ~gone(v), "spurious").when(v == t, "right").when(t.contains(" ") & (v == F.array_join(F.reverse(F.split(t, " ")), " ")), "reversed").when(t.contains(v) | v.contains(t), "partial").otherwise("wrong")
    return g.join(view(spark, sf_dir, "pred_fields"), ["doc", "field"]).select("doc", "field", error.alias("error"))


# --- parsers ---------------------------------------------------------------------------------
_FIELDS = ("SUPPLIER_NAME", "TOTAL_AMOUNT", "PAYER_NAME", "BUSINESS_ABN")


def _responses(spark, sf_dir):
    line = F.concat(F.lower("field"), F.lit(": "), F.when(F.col("value") == text.MISSING, "").otherwise(F.col("value")))
    return view(spark, sf_dir, "gt_fields").groupBy("doc").agg(F.concat(F.lit("Here it is\n"), F.array_join(F.array_sort(F.collect_list(line)), "\n"), F.lit("\nsupplier_name: Last One")).alias("raw"))


@query("SELECT doc, 'Last One' AS supplier, max(CASE WHEN field = 'TOTAL_AMOUNT' THEN value END) AS total, coalesce(max(CASE WHEN field = 'BUSINESS_ABN' AND value <> 'NOT_FOUND' THEN value END), 'NOT_FOUND') AS abn, CAST(4 + max((field = 'BUSINESS_ABN' AND value <> 'NOT_FOUND')::INT) AS BIGINT) AS n FROM gt_fields GROUP BY doc")
def par3_key_values(spark, sf_dir):
    t = parsers.wide(_responses(spark, sf_dir).withColumn("m", parsers.key_values(F.col("raw"))), "m", _FIELDS)
    return t.select("doc", F.col("SUPPLIER_NAME").alias("supplier"), F.col("TOTAL_AMOUNT").alias("total"), F.col("BUSINESS_ABN").alias("abn"), F.size("m").cast("long").alias("n"))


@query("SELECT doc, max(CASE WHEN field = 'SUPPLIER_NAME' THEN value END) AS supplier FROM gt_fields GROUP BY doc")
def par14_first_key_wins(spark, sf_dir):
    return _responses(spark, sf_dir).select("doc", F.element_at(parsers.key_values(F.col("raw"), first_wins=True), "SUPPLIER_NAME").alias("supplier"))


@query("SELECT o_orderkey AS doc, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS total, CASE WHEN o_orderstatus = 'F' THEN 'NOT_FOUND' ELSE o_orderstatus END AS status, true AS is_json FROM orders")
def jsn1_jsn3_json_fields(spark, sf_dir):
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    raw = F.concat(F.lit("```json\n"), F.to_json(F.struct(F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("total"), F.when(F.col("o_orderstatus") != "F", F.col("o_orderstatus")).alias("status"))), F.lit("\n```"))
    m = parsers.json_fields(raw, ("total", "status"))
    return o.select(F.col("o_orderkey").alias("doc"), m["total"].alias("total"), m["status"].alias("status"), parsers.looks_like_json(raw).alias("is_json"))


@query("SELECT doc, 'Last One' AS supplier_name, max(value) FILTER (field = 'TOTAL_AMOUNT') AS total_amount, max(value) FILTER (field = 'PAYER_NAME') AS payer_name, max(value) FILTER (field = 'BUSINESS_ABN') AS business_abn FROM gt_fields GROUP BY doc")
def par2_line_machine(spark, sf_dir):
    t = parsers.field_lines(_responses(spark, sf_dir), "raw", _FIELDS)
    return t.select("doc", *[F.element_at("fields", f).alias(f.lower()) for f in _FIELDS])


# --- reports ---------------------------------------------------------------------------------
@query("SELECT model, tier, count(f1) AS n, round(avg(f1), 6) AS mean, round(median(f1), 6) AS median, round(stddev_samp(f1), 6) AS sd, min(f1) AS least, max(f1) AS most FROM runs GROUP BY model, tier")
def agg22_tier_summary(spark, sf_dir):
    return analytics.summary(view(spark, sf_dir, "runs"), ["model", "tier"], "f1")


@query("SELECT doc_type, count(seconds) AS n, round(avg(seconds), 6) AS mean, round(median(seconds), 6) AS median, round(stddev_samp(seconds), 6) AS sd, min(seconds) AS least, max(seconds) AS most FROM runs GROUP BY doc_type")
def agg13_type_timing(spark, sf_dir):
    return analytics.summary(view(spark, sf_dir, "runs"), ["doc_type"], "seconds")


@query("SELECT model, round(avg(f1) * 100, 4) AS accuracy, round(60 / median(seconds), 6) AS per_minute, round(avg(f1) * 100 * 60 / median(seconds), 4) AS efficiency, count(*) FILTER (f1 < 0.5) AS weak FROM runs GROUP BY model")
def agg15_agg16_executive_summary(spark, sf_dir):
    per = 60 / F.median("seconds")
    return view(spark, sf_dir, "runs").groupBy("model").agg(F.round(F.avg("f1") * 100, 4).alias("accuracy"), F.round(per, 6).alias("per_minute"), F.round(F.avg("f1") * 100 * per, 4).alias("efficiency"), F.count_if(F.col("f1") < 0.5).alias("weak"))


@query("SELECT *, CASE WHEN alpha >= beta AND alpha >= gamma THEN 'alpha' WHEN beta >= gamma THEN 'beta' ELSE 'gamma' END AS best, greatest(alpha, beta, gamma) AS best_f1, round(sqrt(((alpha - m) ** 2 + (beta - m) ** 2 + (gamma - m) ** 2) / 2), 6) AS spread FROM (SELECT *, (alpha + beta + gamma) / 3 AS m FROM (SELECT field, round(avg(f1) FILTER (model = 'alpha'), 6) AS alpha, round(avg(f1) FILTER (model = 'beta'), 6) AS beta, round(avg(f1) FILTER (model = 'gamma'), 6) AS gamma FROM runs GROUP BY field))".replace("SELECT *, CASE", "SELECT field, alpha, beta, gamma, CASE"))
def agg17_win7_best_model(spark, sf_dir):
    return analytics.best_model(view(spark, sf_dir, "runs"), MODELS)


@query("SELECT doc_type, count(*) FILTER (predicted = 'receipt') AS receipt, count(*) FILTER (predicted = 'invoice') AS invoice, count(*) FILTER (predicted = 'bank_statement') AS bank_statement, count(*) FILTER (predicted = 'other') AS other FROM runs GROUP BY doc_type")
def agg11_agg12_confusion(spark, sf_dir):
    return analytics.confusion(view(spark, sf_dir, "runs"), "doc_type", "predicted", TYPES)


@query("SELECT label, support, round(p, 6) AS precision, round(r, 6) AS recall, round(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0.0 END, 6) AS f1 FROM (SELECT label, support, CASE WHEN named > 0 THEN tp / named::DOUBLE ELSE 0.0 END AS p, CASE WHEN support > 0 THEN tp / support::DOUBLE ELSE 0.0 END AS r FROM (SELECT coalesce(a.label, b.label) AS label, coalesce(support, 0) AS support, coalesce(tp, 0) AS tp, coalesce(named, 0) AS named FROM (SELECT doc_type AS label, count(*) AS support, count(*) FILTER (doc_type = predicted) AS tp FROM runs GROUP BY 1) a FULL OUTER JOIN (SELECT predicted AS label, count(*) AS named FROM runs GROUP BY 1) b ON a.label = b.label))")
def agg12_class_report(spark, sf_dir):
    return analytics.class_report(view(spark, sf_dir, "runs"), "doc_type", "predicted")


@query("SELECT count(*) AS n, round(avg(x - y), 6) AS mean_difference, round(avg(x - y) / (stddev_samp(x - y) / sqrt(count(*))), 6) AS t, round(avg(x - y) / stddev_samp(x - y), 6) AS cohens_d, count(*) FILTER (x - y > 0) AS wins, count(*) FILTER (x - y < 0) AS losses, count(*) FILTER (x - y = 0) AS ties FROM (SELECT a.f1 AS x, b.f1 AS y FROM runs a JOIN runs b ON a.doc = b.doc WHERE a.model = 'alpha' AND b.model = 'beta')")
def evl12_paired_test(spark, sf_dir):
    return analytics.paired_test(view(spark, sf_dir, "runs"), "alpha", "beta")


def _rates(predicted: str) -> str:
    return f"""(SELECT pos, count(want) AS n, count(*) FILTER (want = got) AS "right", count(*) FILTER (want <> got) AS wrong, count(*) FILTER (got IS NULL) AS missing, count(*) FILTER (want IS NULL) AS extra, round(count(*) FILTER (want = got) / count(want)::DOUBLE, 6) AS rate
        FROM (SELECT coalesce(g.pos, p.pos) AS pos, g.item AS want, p.item AS got FROM gt_items g FULL JOIN {predicted} p ON g.doc = p.doc AND g.pos = p.pos) GROUP BY pos HAVING count(want) >= 5)"""


_RATES = _rates("pred_items")
_STRAIGHT = """(SELECT * FROM pred_items WHERE doc NOT IN (SELECT g.doc FROM (SELECT doc, list(item ORDER BY pos DESC) AS l FROM gt_items GROUP BY doc HAVING count(*) > 1) g JOIN (SELECT doc, list(item ORDER BY pos) AS l FROM pred_items GROUP BY doc) p ON g.doc = p.doc AND g.l = p.l))"""


@query(f"SELECT * FROM {_RATES}")
def agg25_position_rates(spark, sf_dir):
    return analytics.position_rates(view(spark, sf_dir, "pred_items"), view(spark, sf_dir, "gt_items"))


@query(f"SELECT count(*) AS positions, round(corr(pos, rate), 6) AS r, CASE WHEN count(*) < 3 THEN NULL WHEN round(corr(pos, rate), 6) < -0.3 THEN 'tail-drop' WHEN round(corr(pos, rate), 6) <= 0.3 THEN 'flat' ELSE 'improves' END AS trend FROM {_rates(_STRAIGHT)}")
def agg26_win9_decay(spark, sf_dir):
    p, g = view(spark, sf_dir, "pred_items"), view(spark, sf_dir, "gt_items")
    return analytics.decay(analytics.position_rates(analytics.not_reversed(p, g), g))


@query("SELECT doc_type, round(avg(wrong), 6) AS wrong_rate, sum(wrong)::BIGINT AS wrong, GROUPING(doc_type) + GROUPING(tier) AS lvl, tier FROM (SELECT doc_type, tier, (doc_type <> predicted)::INT AS wrong FROM runs) GROUP BY GROUPING SETS ((), (doc_type), (tier))")
def agg19_grouping_sets(spark, sf_dir):
    t = view(spark, sf_dir, "runs").withColumn("wrong", (F.col("doc_type") != F.col("predicted")).cast("int"))
    g = t.groupingSets([[], [F.col("doc_type")], [F.col("tier")]], F.col("doc_type"), F.col("tier")).agg(F.round(F.avg("wrong"), 6).alias("wrong_rate"), F.sum("wrong").alias("wrong"), (F.grouping("doc_type").cast("long") + F.grouping("tier").cast("long")).alias("lvl"))
    return g.select("doc_type", "wrong_rate", "wrong", "lvl", "tier")


@query("SELECT field, round(c, 6) AS clean, round(h, 6) AS heavy, round(c - h, 6) AS dropped, round(h / c, 6) AS retained FROM (SELECT field, avg(f1) FILTER (tier = 'clean') AS c, avg(f1) FILTER (tier = 'heavy') AS h FROM runs GROUP BY field)")
def agg23_field_by_tier(spark, sf_dir):
    at = lambda tier: F.avg(F.when(F.col("tier") == tier, F.col("f1")))
    t = view(spark, sf_dir, "runs").groupBy("field").agg(at("clean").alias("c"), at("heavy").alias("h"))
    return t.select("field", F.round("c", 6).alias("clean"), F.round("h", 6).alias("heavy"), F.round(F.col("c") - F.col("h"), 6).alias("dropped"), F.round(F.col("h") / F.col("c"), 6).alias("retained"))


@query("SELECT model, CASE WHEN got = want THEN 'exact' WHEN got < want THEN 'short' ELSE 'over' END AS outcome, count(*) AS n, round(avg(got - want), 6) AS delta FROM (SELECT model, tp + fp AS got, tp + fn AS want FROM runs) GROUP BY 1, 2")
def agg24_count_outcome(spark, sf_dir):
    got, want = F.col("tp") + F.col("fp"), F.col("tp") + F.col("fn")
    kind = F.when(got == want, "exact").when(got < want, "short").otherwise("over")
    return view(spark, sf_dir, "runs").groupBy("model", kind.alias("outcome")).agg(F.count("*").alias("n"), F.round(F.avg(got - want), 6).alias("delta"))


@query("SELECT field, doc_type, round(100.0 * count(*) FILTER (f1 = 1) / count(*), 6) AS perfect, round(100.0 * count(*) FILTER (f1 > 0 AND f1 < 1) / count(*), 6) AS partial, round(100.0 * count(*) FILTER (f1 = 0) / count(*), 6) AS miss FROM runs GROUP BY field, doc_type")
def agg27_outcome_shares(spark, sf_dir):
    share = lambda c: F.round(F.lit(100.0) * F.count_if(c) / F.count("*"), 6)
    f1 = F.col("f1")
    return view(spark, sf_dir, "runs").groupBy("field", "doc_type").agg(share(f1 == 1).alias("perfect"), share((f1 > 0) & (f1 < 1)).alias("partial"), share(f1 == 0).alias("miss"))


@query("SELECT tier AS stage, round(max(s), 4) AS wall, round(sum(s), 4) AS work, count(*) AS workers FROM (SELECT tier, doc % 4 AS worker, sum(seconds) AS s FROM runs GROUP BY 1, 2) GROUP BY tier")
def agg33_slowest_worker(spark, sf_dir):
    return analytics.slowest_worker(view(spark, sf_dir, "runs").withColumn("worker", F.col("doc") % 4).withColumnRenamed("tier", "stage"), "stage", "worker", "seconds")


@query("SELECT bucket, count(*) AS n FROM (SELECT CAST(least(floor(f1 * 20), 19) AS BIGINT) AS bucket FROM runs) GROUP BY bucket")
def agg43_histogram(spark, sf_dir):
    return view(spark, sf_dir, "runs").groupBy(F.least(F.floor(F.col("f1") * 20), F.lit(19)).cast("long").alias("bucket")).agg(F.count("*").alias("n"))


@query("SELECT doc, arg_min(predicted, first) FILTER (n >= 2) AS majority FROM (SELECT doc, predicted, count(*) AS n, min(model) AS first FROM runs GROUP BY 1, 2) GROUP BY doc")
def agg40_majority(spark, sf_dir):
    return analytics.majority(view(spark, sf_dir, "runs"), "doc", "predicted", "model")


@query("SELECT field, count(*) AS n, bool_and(f1 = 1) AS always_perfect, avg(f1) > 0 AND avg(f1) < 1 AS mixed FROM runs GROUP BY field")
def agg8_agg37_diagnostics(spark, sf_dir):
    f1 = F.col("f1")
    return view(spark, sf_dir, "runs").groupBy("field").agg(F.count("*").alias("n"), F.bool_and(f1 == 1).alias("always_perfect"), ((F.avg(f1) > 0) & (F.avg(f1) < 1)).alias("mixed"))


@query("SELECT model, doc_type, count(*) AS n, count(DISTINCT doc) AS docs FROM runs GROUP BY 1, 2")
def agg2_counts(spark, sf_dir):
    return view(spark, sf_dir, "runs").groupBy("model", "doc_type").agg(F.count("*").alias("n"), F.countDistinct("doc").alias("docs"))


# --- sorts, top-k, set operations, windows -----------------------------------------------------
@query("SELECT doc, model, f1 FROM runs ORDER BY f1, doc, model LIMIT 30")
def srt5_srt7_worst_first(spark, sf_dir):
    return view(spark, sf_dir, "runs").select("doc", "model", "f1").orderBy("f1", "doc", "model").limit(30)


@query("SELECT case_id, string_agg(CAST(pos AS VARCHAR), ',' ORDER BY txn_date, pos) AS by_date FROM bank_rows GROUP BY case_id")
def srt2_srt4_chronological(spark, sf_dir):
    t = view(spark, sf_dir, "bank_rows").groupBy("case_id").agg(F.array_sort(F.collect_list(F.struct("txn_date", "pos"))).alias("x"))
    return t.select("case_id", F.array_join(F.transform("x", lambda r: r["pos"].cast("string")), ",").alias("by_date"))


@query("SELECT doc, model, row_number() OVER (PARTITION BY model ORDER BY CASE doc_type WHEN 'bank_statement' THEN 1 WHEN 'invoice' THEN 2 ELSE 3 END, doc) AS place FROM runs")
def srt1_type_order(spark, sf_dir):
    from pyspark.sql import Window

    at = F.array_position(F.array(F.lit("bank_statement"), F.lit("invoice")), F.col("doc_type"))
    w = Window.partitionBy("model").orderBy(F.coalesce(F.nullif(at, F.lit(0)), F.lit(3)), "doc")
    return view(spark, sf_dir, "runs").select("doc", "model", F.row_number().over(w).cast("long").alias("place"))


@query("SELECT (SELECT count(*) FROM (SELECT doc FROM gt_items UNION SELECT doc FROM pred_items)) AS united, (SELECT count(*) FROM (SELECT doc, item FROM gt_items INTERSECT SELECT doc, item FROM pred_items)) AS shared, (SELECT count(*) FROM (SELECT doc, item FROM gt_items EXCEPT SELECT doc, item FROM pred_items)) AS missing, (SELECT count(*) FROM (SELECT doc, item FROM gt_items UNION ALL SELECT doc, item FROM pred_items)) AS stacked")
def set1_set4_set_operations(spark, sf_dir):
    g, p = view(spark, sf_dir, "gt_items"), view(spark, sf_dir, "pred_items")
    a, b = g.select("doc", "item"), p.select("doc", "item")
    n = lambda df, name: df.agg(F.count("*").alias(name))
    return n(g.select("doc").union(p.select("doc")).distinct(), "united").crossJoin(n(a.intersect(b), "shared")).crossJoin(n(a.subtract(b), "missing")).crossJoin(n(g.unionByName(p.withColumn("source", F.lit("p")), allowMissingColumns=True), "stacked"))


@query("SELECT kind, case_id, confidence FROM (SELECT *, row_number() OVER (PARTITION BY case_id ORDER BY confidence DESC, kind) AS r FROM trust_docs) WHERE r = 1")
def win4_best_per_case(spark, sf_dir):
    from pyspark.sql import Window

    w = Window.partitionBy("case_id").orderBy(F.desc("confidence"), "kind")
    return view(spark, sf_dir, "trust_docs").withColumn("r", F.row_number().over(w)).filter("r = 1").select("kind", "case_id", "confidence")


@query("SELECT user_id, event_type, max(event_id) AS event_id FROM events GROUP BY 1, 2")
def snk9_upsert_latest(spark, sf_dir):
    return analytics.latest(spark.read.parquet(f"{sf_dir}/events.parquet").select("user_id", "event_type", "event_id"), ["user_id", "event_type"], "event_id")


@query("SELECT doc, sum((value <> 'NOT_FOUND')::INT)::BIGINT AS found, count(*) AS fields FROM pred_fields GROUP BY doc")
def arr7_found_fields(spark, sf_dir):
    m = F.map_from_entries(F.collect_list(F.struct("field", "value"))).alias("m")
    t = view(spark, sf_dir, "pred_fields").groupBy("doc").agg(m)
    return t.select("doc", F.size(F.map_filter("m", lambda k, v: v != text.MISSING)).cast("long").alias("found"), F.size("m").cast("long").alias("fields"))


@query("SELECT doc, doc_type, field, f1, tp, fp, fn FROM runs WHERE model = 'alpha'")
def prj3_long_scores(spark, sf_dir):
    """Records with a map of field scores as one row a field."""
    t = view(spark, sf_dir, "runs").filter("model = 'alpha'")
    records = t.groupBy("doc", "doc_type").agg(F.map_from_entries(F.collect_list(F.struct("field", F.struct("f1", "tp", "fp", "fn")))).alias("field_scores"))
    return analytics.long_scores(records, "field_scores", "doc", "doc_type")
