"""Queries of diagnostics over scored documents and runs, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.operators import analytics, diagnostics
from ledgerloom.plans.views import duck, view

QUERIES: dict = {}
ORACLE: dict[str, str] = {}
TIERS = ("clean", "light", "moderate", "heavy")


def query(sql: str | None):
    """Register a query under its function's name, with DuckDB SQL over the record views where there is any."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = duck(sql)
        return f

    return add


_SCORED = "s AS (SELECT g.doc, CASE g.doc % 3 WHEN 0 THEN 'receipt' WHEN 1 THEN 'invoice' ELSE 'travel' END AS doc_type, g.field, CASE WHEN g.value = p.value OR (g.doc % 3 = 1 AND g.field = 'IS_GST_INCLUDED') THEN 1.0 WHEN length(p.value) > 5 THEN 0.5 ELSE 0.0 END::DOUBLE AS f1 FROM gt_fields g JOIN pred_fields p ON g.doc = p.doc AND g.field = p.field)"


def _scores(spark, sf_dir):
    g, p = view(spark, sf_dir, "gt_fields").withColumnRenamed("value", "t"), view(spark, sf_dir, "pred_fields")
    k = F.col("doc") % 3
    f1 = F.when((F.col("t") == F.col("value")) | ((k == 1) & (F.col("field") == "IS_GST_INCLUDED")), 1.0).when(F.length("value") > 5, 0.5).otherwise(0.0)
    return g.join(p, ["doc", "field"]).select("doc", F.when(k == 0, "receipt").when(k == 1, "invoice").otherwise("travel").alias("doc_type"), "field", f1.alias("f1"))


@query(f"""WITH {_SCORED}, f AS (SELECT doc_type, field, min(f1) = 1 AS free FROM s GROUP BY ALL), d AS (SELECT s.doc_type, doc, avg(f1) AS mean, median(f1) AS med, max(f1) FILTER (NOT free) AS best FROM s JOIN f ON s.doc_type = f.doc_type AND s.field = f.field GROUP BY ALL)
    SELECT f.doc_type, count(*) AS n_fields, count(*) FILTER (free) AS n_free, round(count(*) FILTER (free) / count(*)::DOUBLE, 6) AS floor, any_value(w) AS worst_mean, any_value(e) AS median_is_best, coalesce(string_agg(field, ', ' ORDER BY field) FILTER (free), '') AS free_fields
    FROM f JOIN (SELECT doc_type, round(min(mean), 6) AS w, round(avg((abs(med - best) < 1e-9)::INT), 6) AS e FROM d GROUP BY doc_type) x ON x.doc_type = f.doc_type GROUP BY f.doc_type""")
def agg8_scale_diagnostics(spark, sf_dir):
    return diagnostics.scale_diagnostics(_scores(spark, sf_dir))


@query("""SELECT CASE WHEN GROUPING(field) + GROUPING(doc) = 2 THEN 'all' WHEN GROUPING(doc) = 1 THEN 'field' ELSE 'doc' END AS level, field, doc, sum(bad)::BIGINT AS invented, count(*) AS absent, round(sum(bad) / count(*)::DOUBLE, 6) AS rate
    FROM (SELECT g.doc, g.field, (p.value IS NOT NULL AND upper(trim(p.value)) NOT IN ('NOT_FOUND', '', 'NAN'))::INT AS bad FROM gt_fields g LEFT JOIN (SELECT doc, field, CASE WHEN doc % 4 = 2 THEN value || ' seen' ELSE value END AS value FROM pred_fields) p ON g.doc = p.doc AND g.field = p.field WHERE upper(trim(g.value)) = 'NOT_FOUND' OR (g.doc % 10 = 3 AND g.field = 'PAYER_NAME'))
    GROUP BY GROUPING SETS ((), (field), (doc))""")
def agg19_invented_values(spark, sf_dir):
    g = view(spark, sf_dir, "gt_fields").select("doc", "field", F.when((F.col("doc") % 10 == 3) & (F.col("field") == "PAYER_NAME"), " ").otherwise(F.col("value")).alias("truth"))
    p = view(spark, sf_dir, "pred_fields").select("doc", "field", F.when(F.col("doc") % 4 == 2, F.concat("value", F.lit(" seen"))).otherwise(F.col("value")).alias("value"))
    return diagnostics.invented(g.join(p, ["doc", "field"], "left"))


@query("""SELECT model, count(*) AS images, count(*) FILTER (doc % 13 <> 0) AS succeeded, count(*) FILTER (doc % 13 = 0) AS failed, round(avg(f1 * 100) FILTER (doc % 13 <> 0), 6) AS mean, round(median(f1 * 100) FILTER (doc % 13 <> 0), 6) AS median, min(f1 * 100) FILTER (doc % 13 <> 0) AS least, max(f1 * 100) FILTER (doc % 13 <> 0) AS most,
    round(avg(seconds), 6) AS mean_seconds, round(sum(seconds), 4) AS total_seconds, round(60 / avg(seconds), 6) AS per_minute FROM runs GROUP BY model""")
def agg15_run_statistics(spark, sf_dir):
    return diagnostics.run_statistics(view(spark, sf_dir, "runs").withColumn("error", F.when(F.col("doc") % 13 == 0, "unreadable")), ["model"])


@query("SELECT model, tier, count(*) AS images, round(avg(f1), 6) AS mean_f1, round(avg(seconds), 6) AS mean_seconds, round(60 / avg(seconds), 6) AS per_minute FROM runs GROUP BY model, tier")
def agg22_tier_throughput(spark, sf_dir):
    return view(spark, sf_dir, "runs").groupBy("model", "tier").agg(F.count("*").alias("images"), F.round(F.avg("f1"), 6).alias("mean_f1"), F.round(F.avg("seconds"), 6).alias("mean_seconds"), F.round(60 / F.avg("seconds"), 6).alias("per_minute"))


@query("""SELECT model, field, round(c, 6) AS clean, round(l, 6) AS light, round(m, 6) AS moderate, round(h, 6) AS heavy, round(c - h, 6) AS lost, round(CASE WHEN c <> 0 THEN h / c END, 6) AS kept FROM (SELECT model, field, avg(f1) FILTER (tier = 'clean') AS c, avg(f1) FILTER (tier = 'light') AS l, avg(f1) FILTER (tier = 'moderate') AS m, avg(f1) FILTER (tier = 'heavy') AS h FROM runs WHERE field <> 'field_3' GROUP BY ALL)""")
def agg23_tier_matrix(spark, sf_dir):
    return diagnostics.tier_matrix(view(spark, sf_dir, "runs"), TIERS, ("field_3",))


@query("""SELECT model, w AS without, round(avg(f1) FILTER (tier = 'heavy') / avg(f1) FILTER (tier = 'clean'), 6) AS kept, count(DISTINCT field) AS fields FROM runs, (SELECT unnest(['none', 'lists', 'two']) AS w) WHERE NOT (w = 'lists' AND field = 'field_1') AND NOT (w = 'two' AND field IN ('field_0', 'field_4')) GROUP BY ALL""")
def agg23_retention(spark, sf_dir):
    return diagnostics.retention(view(spark, sf_dir, "runs"), TIERS, {"none": (), "lists": ("field_1",), "two": ("field_0", "field_4")})


@query("""WITH r AS (SELECT tier AS stage, doc % 4 AS worker, seconds FROM runs WHERE tier <> 'light'), w AS (SELECT tier AS stage, round(sum(seconds) / 3.5, 3) AS wall FROM runs GROUP BY tier UNION ALL SELECT 'extra', 7.5), i AS (SELECT stage, max(s) AS inference, count(*) AS workers FROM (SELECT stage, worker, sum(seconds) AS s FROM r GROUP BY ALL) GROUP BY stage)
    SELECT stage, round(wall, 4) AS wall, round(coalesce(inference, 0), 4) AS inference, round(greatest(0, wall - coalesce(inference, 0)), 4) AS startup, coalesce(workers, 0) AS workers FROM w LEFT JOIN i USING (stage)""")
def agg33_stage_times(spark, sf_dir):
    runs = view(spark, sf_dir, "runs").withColumnRenamed("tier", "stage")
    walls = runs.groupBy("stage").agg(F.round(F.sum("seconds") / 3.5, 3).alias("wall")).unionByName(spark.createDataFrame([("extra", 7.5)], "stage string, wall double"))
    return diagnostics.stage_times(runs.filter("stage <> 'light'").withColumn("worker", F.col("doc") % 4), walls)


@query("""WITH m AS (SELECT doc_type, model, round(avg(f1), 6) AS m FROM runs GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY doc_type ORDER BY m DESC, model) AS k FROM m)
    SELECT a.doc_type, a.model AS leader, a.m AS score, b.model AS second, round(a.m - b.m, 6) AS ahead FROM r a JOIN r b ON a.doc_type = b.doc_type AND a.k = 1 AND b.k = 2""")
def agg39_type_leaders(spark, sf_dir):
    return diagnostics.leaders(view(spark, sf_dir, "runs"))


@query("""WITH q AS (SELECT doc_type, quantile_cont(seconds, 0.25) AS q1, quantile_cont(seconds, 0.5) AS q2, quantile_cont(seconds, 0.75) AS q3 FROM runs WHERE doc % 50 <> 0 OR seconds < 2 GROUP BY doc_type)
    SELECT q.doc_type, q1, q2, q3, min(seconds) AS low, max(seconds) AS high, count(*) AS inside FROM (SELECT * FROM runs WHERE doc % 50 <> 0 OR seconds < 2) r JOIN q ON q.doc_type = r.doc_type AND seconds BETWEEN q1 - 1.5 * (q3 - q1) - 1e-12 AND q3 + 1.5 * (q3 - q1) + 1e-12 GROUP BY ALL""")
def agg43_quartiles(spark, sf_dir):
    return diagnostics.quartiles(view(spark, sf_dir, "runs").filter("doc % 50 <> 0 OR seconds < 2"), ["doc_type"], "seconds")


_MEANS = "(SELECT field, avg(f1) FILTER (model = 'alpha') AS x, avg(f1) FILTER (model = 'beta') AS y FROM runs GROUP BY field)"


@query(f"""WITH a AS (SELECT count(*) AS n, avg(round(x - y, 9)) AS m, stddev_samp(round(x - y, 9)) AS sd, var_samp(x) AS vx, var_samp(y) AS vy, avg(x) AS mx, avg(y) AS my FROM {_MEANS}),
    b AS (SELECT *, m / (sd / sqrt(n)) AS t, n - 1 AS df FROM a), c AS (SELECT *, atan(abs(t) / sqrt(df)) AS th FROM b),
    d AS (SELECT *, 1 - CASE WHEN df % 2 = 1 THEN 2 / pi() * (th + sin(th) * coalesce(list_sum(list_transform(range(0, (df - 1) // 2), lambda k: exp(k * ln(4) + 2 * lgamma(k + 1) - lgamma(2 * k + 2)) * pow(cos(th), 2 * k + 1))), 0))
      ELSE sin(th) * coalesce(list_sum(list_transform(range(0, df // 2), lambda k: exp(lgamma(2 * k + 1) - 2 * lgamma(k + 1) - k * ln(4)) * pow(cos(th), 2 * k))), 0) END AS p FROM c)
    SELECT n, round(t, 6) AS t, round(p, 6) AS p, CASE WHEN p < 0.001 THEN '***' WHEN p < 0.01 THEN '**' WHEN p < 0.05 THEN '*' ELSE 'ns' END AS stars, round(m / sd, 6) AS d_paired, round((mx - my) / sqrt((vx + vy) / 2), 6) AS d_pooled,
      CASE WHEN abs(m / sd) < 0.2 THEN 'negligible' WHEN abs(m / sd) < 0.5 THEN 'small' WHEN abs(m / sd) < 0.8 THEN 'medium' ELSE 'large' END AS effect, CASE WHEN mx > my THEN 'alpha' WHEN my > mx THEN 'beta' ELSE 'tie' END AS winner, round(abs(mx - my), 6) AS advantage FROM d""".replace("lgamma(k + 1)", "lgamma((k + 1)::DOUBLE)").replace("lgamma(2 * k + 2)", "lgamma((2 * k + 2)::DOUBLE)").replace("lgamma(2 * k + 1)", "lgamma((2 * k + 1)::DOUBLE)"))
def evl12_significance(spark, sf_dir):
    return diagnostics.significance(analytics.field_means(view(spark, sf_dir, "runs"), "alpha", "beta"), "alpha", "beta")


@query(None)  # draws by Spark's hash: tested by its bounds and by repetition
def evl13_bootstrap(spark, sf_dir):
    return analytics.bootstrap_interval(analytics.field_means(view(spark, sf_dir, "runs"), "alpha", "beta"), draws=2000)


@query("""WITH f AS (SELECT case_id, arg_min(txn_date, pos) AS a, arg_max(txn_date, pos) AS b, count(*) AS n FROM bank_rows GROUP BY case_id)
    SELECT case_id, CASE WHEN n = 1 THEN 'Thu ' || strftime(a, '%d/%m/%Y') WHEN a > b THEN strftime(b, '%d/%m/%Y') || ' - ' || strftime(a, '%d/%m/%Y') ELSE strftime(a, '%d/%m/%Y') || ' - ' || strftime(b, '%d/%m/%Y') END AS span FROM f""")
def dat8_date_span(spark, sf_dir):
    t = view(spark, sf_dir, "bank_rows").groupBy("case_id").agg(F.array_sort(F.collect_list(F.struct("pos", "txn_date"))).alias("x"))
    texts = F.transform("x.txn_date", lambda d: F.concat(F.lit("Thu "), F.date_format(d, "dd/MM/yyyy")))
    return t.select("case_id", diagnostics.date_span(texts, F.col("x.txn_date")).alias("span"))


@query("""WITH RECURSIVE g AS (SELECT doc, list(CAST(item AS DOUBLE) ORDER BY pos) AS w FROM gt_items GROUP BY doc), p AS (SELECT doc, list(CAST(item AS DOUBLE) + CASE WHEN pos % 2 = 0 THEN 0.4 ELSE 0 END ORDER BY pos) AS g FROM pred_items GROUP BY doc),
    b AS (SELECT g.doc, w, coalesce(p.g, []) AS g FROM g LEFT JOIN p ON p.doc = g.doc), st(doc, i, used, missing) AS (SELECT doc, 0, []::BIGINT[], []::DOUBLE[] FROM b UNION ALL
      SELECT doc, i + 1, CASE WHEN h IS NULL THEN used ELSE list_append(used, h) END, CASE WHEN h IS NULL THEN list_append(missing, x) ELSE missing END FROM (SELECT st.doc, i, used, missing, w[i + 1] AS x, list_filter(range(1, len(g) + 1), lambda k: NOT list_contains(used, k) AND abs(g[k] - w[i + 1]) <= 0.5)[1] AS h FROM st JOIN b USING (doc) WHERE i < len(w)))
    SELECT doc, len(used) AS matched, array_to_string(list_transform(missing, lambda x: round(x, 2)::DECIMAL(18,2)), ',') AS missing, len(g) - len(used) AS spurious FROM st JOIN b USING (doc) WHERE i = len(w)""")
def jn13_amounts_apart(spark, sf_dir):
    listed = lambda v, extra: view(spark, sf_dir, v).groupBy("doc").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", (F.col("item").cast("double") + extra).alias("x")))), lambda s: s["x"]).alias(v))
    both = listed("gt_items", F.lit(0.0)).join(listed("pred_items", F.when(F.col("pos") % 2 == 0, 0.4).otherwise(0.0)), "doc", "left")
    d = diagnostics.amounts_apart(F.coalesce("pred_items", F.array().cast("array<double>")), F.col("gt_items"), 0.5)
    t = both.select("doc", d.alias("d"))
    return t.select("doc", "d.matched", F.array_join(F.transform("d.missing", lambda x: F.round(x, 2).cast("decimal(18,2)").cast("string")), ",").alias("missing"), F.size("d.spurious").cast("long").alias("spurious"))
