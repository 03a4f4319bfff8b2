"""Queries of whole documents: aligned registers, field scores by every method, correlation, summaries, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.functions.arrays import each
from ledgerloom.functions.cleaning import ALIASES
from ledgerloom.operators import documents, linking, routing, scoring
from ledgerloom.plans.cases import doc_cases, doc_maps
from ledgerloom.plans.queries_records import _F1
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


# --- the same in SQL: both sides as rows (doc, doc_type, side, field, value) ----------------------
_IT = lambda x: f"list_filter(list_transform(string_split({x}, '|'), lambda z: trim(z)), lambda z: z <> '')"
_IS_LIST = lambda x: f"coalesce(contains({x}, '|') AND upper(trim({x})) <> 'NOT_FOUND', false)"
_REGISTER = "('TRANSACTION_DATES', 'TRANSACTION_AMOUNTS_PAID', 'TRANSACTION_AMOUNTS_RECEIVED', 'LINE_ITEM_DESCRIPTIONS', 'ACCOUNT_BALANCE')"


def ymd(x: str) -> str:
    """The date of a text as YYYYMMDD; null for other texts."""
    mon = f"(instr('xxjanfebmaraprmayjunjulaugsepoctnovdec', lower(regexp_extract({x}, '[A-Za-z]{{3}}'))) / 3)::INT::VARCHAR"
    short = f"CASE WHEN substr({x}, 7) <= '50' THEN '20' ELSE '19' END || substr({x}, 7) || substr({x}, 4, 2) || substr({x}, 1, 2)"
    return (
        f"CASE WHEN regexp_matches({x}, '^\\d\\d/\\d\\d/\\d{{4}}$') THEN substr({x}, 7) || substr({x}, 4, 2) || substr({x}, 1, 2) WHEN regexp_matches({x}, '^\\d\\d/\\d\\d/\\d\\d$') THEN {short} "
        f"WHEN regexp_matches({x}, '^\\d+ [A-Za-z]+ \\d{{4}}$') THEN split_part({x}, ' ', 3) || lpad({mon}, 2, '0') || lpad(split_part({x}, ' ', 1), 2, '0') END"
    )


_SIDES = f"""
    s0 AS (SELECT doc, doc_type, 'want' AS side, field, want AS value FROM doc_values UNION ALL SELECT doc, doc_type, 'got', field, got FROM doc_values WHERE got IS NOT NULL),
    s1 AS (SELECT s0.*, {_IT('p.value')} AS paid FROM s0 LEFT JOIN s0 p ON p.doc = s0.doc AND p.side = s0.side AND p.field = 'TRANSACTION_AMOUNTS_PAID' AND p.doc_type = 'bank_statement' AND {_IS_LIST('p.value')}),
    s2 AS (SELECT * EXCLUDE (value, paid), CASE WHEN field IN {_REGISTER} AND {_IS_LIST('value')} AND len({_IT('value')}) = len(paid) AND len(list_filter(paid, lambda x: upper(x) <> 'NOT_FOUND')) BETWEEN 1 AND len(paid) - 1
        THEN array_to_string(list_transform(list_filter(range(1, len(paid) + 1), lambda i: upper(paid[i]) <> 'NOT_FOUND'), lambda i: {_IT('value')}[i]), ' | ') ELSE value END AS value FROM s1),
    s3 AS (SELECT s2.*, {_IT('p.value')} AS dates FROM s2 LEFT JOIN s2 p ON p.doc = s2.doc AND p.side = s2.side AND p.field = 'TRANSACTION_DATES' AND p.doc_type = 'bank_statement' AND {_IS_LIST('p.value')}),
    s4 AS (SELECT * EXCLUDE (value, dates), CASE WHEN field IN {_REGISTER} AND {_IS_LIST('value')} AND len({_IT('value')}) = len(dates)
        THEN array_to_string(list_transform(list_sort(list_transform(range(1, len(dates) + 1), lambda i: {{'k': coalesce({ymd('dates[i]')}, '99999999'), 'i': i}})), lambda p: {_IT('value')}[p.i]), ' | ') ELSE value END AS value FROM s3),
    pairs AS (SELECT w.doc, w.doc_type, w.field, coalesce(g.value, 'NOT_FOUND') AS v, w.value AS t, g.value IS NOT NULL AS paired FROM s4 w LEFT JOIN s4 g ON g.doc = w.doc AND g.field = w.field AND g.side = 'got' WHERE w.side = 'want')"""
_WORDS = lambda x: f"list_distinct(list_filter(regexp_split_to_array(lower(trim({x})), '\\s+'), lambda z: z <> ''))"
_JACCARD = lambda a, b: f"len(list_intersect({_WORDS(a)}, {_WORDS(b)})) / len(list_distinct(list_concat({_WORDS(a)}, {_WORDS(b)})))::DOUBLE >= 0.75"
_NEAR = lambda a, b: f"(1 - levenshtein(lower(trim({a})), lower(trim({b}))) / greatest(length(trim({a})), length(trim({b})))::DOUBLE >= 0.9 OR {_JACCARD(a, b)})"
_NUMBER = lambda x: f"TRY_CAST(regexp_replace({x}, '[^0-9.-]', '', 'g') AS DOUBLE)"
_MONEY = lambda a, b: f"abs({_NUMBER(a)} - {_NUMBER(b)}) <= CASE WHEN {_NUMBER(b)} <> 0 THEN abs({_NUMBER(b)} * 0.01) ELSE 0.01 END"


def match_sql(field: str, a: str, b: str, by_row: bool = False) -> str:
    """Whether two items match: of a register by the field's name, of other lists by its kind."""
    rows = f"CASE WHEN contains({field}, 'AMOUNT') OR contains({field}, 'BALANCE') THEN {_MONEY(a, b)} WHEN contains({field}, 'DATE') THEN {a} = {b} OR {ymd(a)} = {ymd(b)} ELSE {_NEAR(a, b)} END"
    return f"coalesce({rows if by_row else f'''CASE WHEN {field} IN {_REGISTER} THEN {rows} WHEN {field} IN ('TOTAL_AMOUNT', 'LINE_ITEM_TOTAL_PRICES') THEN {_MONEY(a, b)} ELSE {_JACCARD(a, b)} END'''}, false)"


_SCALAR = _F1.removeprefix("round(").removesuffix(", 6)")
_HITS = f"list_filter(range(1, least(len(g), len(w)) + 1), lambda i: {match_sql('field', 'g[i]', 'w[i]')})"
_ORDERED = f"""
    x AS (SELECT *, {_IT('v')} AS g, {_IT('t')} AS w, CASE WHEN upper(trim(t)) = 'NOT_FOUND' THEN 'none' WHEN upper(trim(v)) = 'NOT_FOUND' THEN 'missed' WHEN contains(v, '|') OR contains(t, '|') THEN 'list' WHEN field IN {_REGISTER} THEN 'row' ELSE 'scalar' END AS c FROM pairs),
    y AS (SELECT *, CASE WHEN c = 'list' THEN len({_HITS}) END AS hits, CASE c WHEN 'row' THEN ({match_sql('field', 'v', 't')})::INT::DOUBLE WHEN 'scalar' THEN {_SCALAR} END AS s FROM x),
    z AS (SELECT *, (CASE WHEN c IN ('none', 'missed') THEN 0 WHEN c = 'list' THEN hits ELSE (s > 0.5)::INT END)::BIGINT AS tp,
        (CASE c WHEN 'none' THEN (upper(trim(v)) <> 'NOT_FOUND')::INT WHEN 'missed' THEN 0 WHEN 'list' THEN greatest(len(g) - len(w), 0) ELSE (s <= 0.5)::INT END)::BIGINT AS fp,
        (CASE c WHEN 'none' THEN 0 WHEN 'missed' THEN greatest(len(w), 1) WHEN 'list' THEN len(w) - hits ELSE (s <= 0.5)::INT END)::BIGINT AS fn FROM y),
    pr AS (SELECT *, CASE c WHEN 'none' THEN 1.0 - fp WHEN 'missed' THEN 0.0 WHEN 'list' THEN CASE WHEN tp + fp > 0 THEN tp / (tp + fp)::DOUBLE ELSE 0.0 END ELSE s END AS p, CASE c WHEN 'none' THEN 1.0 WHEN 'missed' THEN 0.0 WHEN 'list' THEN CASE WHEN tp + fn > 0 THEN tp / (tp + fn)::DOUBLE ELSE 0.0 END ELSE s END AS r FROM z),
    scored AS (SELECT doc, doc_type, field, v, t, CASE WHEN c = 'list' THEN CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0.0 END WHEN c = 'none' THEN p WHEN c = 'missed' THEN 0.0 ELSE s END AS f1, p, r, tp, fp, fn FROM pr)"""


def _pairs(spark, sf_dir):
    return documents.align(doc_maps(spark, sf_dir))


@query(f"WITH {_SIDES} SELECT doc, field, CASE WHEN paired THEN v END AS got, t AS want FROM pairs WHERE doc_type = 'bank_statement'")
def flt7_srt1_aligned_registers(spark, sf_dir):
    p = each(_pairs(spark, sf_dir).filter("doc_type = 'bank_statement'").select("doc", "got", "want"), "want", "field", "truth")
    return p.select("doc", "field", F.try_element_at("got", F.col("field")).alias("got"), F.col("truth").alias("want"))


@query(f"WITH {_SIDES}, {_ORDERED} SELECT doc, doc_type, field, round(f1, 6) AS f1, round(p, 6) AS precision, round(r, 6) AS recall, tp, fp, fn FROM scored")
def evl7_evl6_document_fields(spark, sf_dir):
    share = [F.round(c, 6).alias(c) for c in ("f1", "precision", "recall")]
    return documents.evaluate_fields(_pairs(spark, sf_dir)).select("doc", "doc_type", "field", *share, "tp", "fp", "fn")


@query(f"""WITH {_SIDES}, {_ORDERED} SELECT doc, doc_type, round(avg(f1), 6) AS accuracy, round(median(f1), 6) AS median_f1, round(avg(p), 6) AS precision, round(avg(r), 6) AS recall, count(*) AS fields, count(*) FILTER (f1 = 1) AS perfect,
    count(*) FILTER (upper(trim(v)) <> 'NOT_FOUND') AS extracted, coalesce(string_agg(field, ',' ORDER BY field) FILTER (upper(trim(v)) = 'NOT_FOUND' AND upper(trim(t)) <> 'NOT_FOUND'), '') AS missing,
    coalesce(string_agg(field, ',' ORDER BY field) FILTER (NOT (upper(trim(v)) = 'NOT_FOUND' AND upper(trim(t)) <> 'NOT_FOUND') AND f1 < 1), '') AS incorrect, median(f1) >= 0.8 AS meets FROM scored GROUP BY doc, doc_type""")
def evl7_document_summary(spark, sf_dir):
    return documents.summarise(documents.evaluate_fields(_pairs(spark, sf_dir)), "case_id").drop("case_id")


# greedy: every item of the prediction in turn takes the first free item of the truth that it matches
_GREEDY = f"""
    q AS (SELECT *, row_number() OVER (ORDER BY doc, field) AS id, {_IT('v')} AS g, {_IT('t')} AS w FROM (SELECT DISTINCT ON (doc, field) * FROM pairs)),
    lists AS (SELECT * FROM q WHERE upper(trim(t)) <> 'NOT_FOUND' AND upper(trim(v)) <> 'NOT_FOUND' AND (contains(v, '|') OR contains(t, '|'))),
    st(id, k, used) AS (SELECT id, 0, []::BIGINT[] FROM lists UNION ALL
      SELECT id, k + 1, CASE WHEN hit IS NULL THEN used ELSE list_append(used, hit) END FROM (
        SELECT st.id, k, used, list_filter(range(1, len(w) + 1), lambda i: NOT list_contains(used, i) AND {match_sql('field', 'g[k + 1]', 'w[i]')})[1] AS hit FROM st JOIN lists USING (id) WHERE k < len(g))),
    hit AS (SELECT id, len(used) AS hits FROM st JOIN lists USING (id) WHERE k = len(g)),
    ag AS (SELECT q.*, hits, CASE WHEN upper(trim(t)) = 'NOT_FOUND' THEN 'none' WHEN upper(trim(v)) = 'NOT_FOUND' THEN 'missed' WHEN hits IS NOT NULL THEN 'list' ELSE 'scalar' END AS c,
      (CASE WHEN field IN {_REGISTER} THEN {match_sql('field', 'v', 't')} ELSE {_JACCARD('v', 't')} END)::INT AS s FROM q LEFT JOIN hit USING (id)),
    tf AS (SELECT *, (CASE WHEN c IN ('none', 'missed') THEN 0 WHEN c = 'list' THEN hits ELSE s END)::BIGINT AS tp, (CASE c WHEN 'none' THEN (upper(trim(v)) <> 'NOT_FOUND')::INT WHEN 'missed' THEN 0 WHEN 'list' THEN len(g) - hits ELSE 1 - s END)::BIGINT AS fp,
      (CASE c WHEN 'none' THEN 0 WHEN 'missed' THEN greatest(len(w), 1) WHEN 'list' THEN len(w) - hits ELSE 1 - s END)::BIGINT AS fn FROM ag),
    ge AS (SELECT *, CASE c WHEN 'none' THEN 1.0 - fp WHEN 'missed' THEN 0.0 WHEN 'list' THEN CASE WHEN tp > 0 THEN 2 * tp / (2 * tp + fp + fn)::DOUBLE ELSE 0.0 END ELSE s::DOUBLE END AS f1,
      greatest(CASE WHEN contains(v, '|') THEN len(g) ELSE (v <> 'NOT_FOUND')::INT END, CASE WHEN contains(t, '|') THEN len(w) ELSE (t <> 'NOT_FOUND')::INT END) AS total FROM tf)"""


@query(f"WITH RECURSIVE {_SIDES}, {_GREEDY} SELECT doc, field, round(f1, 6) AS agnostic, tp, fp, fn, least(fp, fn) AS substitution, fn - least(fp, fn) AS addition, fp - least(fp, fn) AS deletion, round(CASE WHEN total > 0 THEN 1.0 - greatest(fp, fn) / total::DOUBLE ELSE 0.0 END, 6) AS kieval FROM ge")
def evl5_methods(spark, sf_dir):
    cost = documents.evaluate_fields(_pairs(spark, sf_dir), "kieval")
    return cost.select("doc", "field", F.round("agnostic", 6).alias("agnostic"), "tp", "fp", "fn", "substitution", "addition", "deletion", F.round("f1", 6).alias("kieval"))


def _alignment_sql(group: tuple[str, ...]) -> str:
    names = ", ".join(f"'{f}'" for f in group)
    row = match_sql("m.f", "m.g[i]", "m.w[i]", by_row=True)
    return f"""(SELECT doc, CASE WHEN n = 0 THEN 0.0 ELSE len(list_filter(range(1, n + 1), lambda i: len(list_filter(ms, lambda m: i > len(m.g) OR NOT {row})) = 0)) / n::DOUBLE END AS alignment
      FROM (SELECT doc, list({{'f': field, 'g': {_IT('v')}, 'w': {_IT('t')}}}) AS ms, min(len({_IT('t')})) AS n FROM (SELECT DISTINCT ON (doc, field) * FROM pairs WHERE paired AND upper(trim(v)) <> 'NOT_FOUND' AND upper(trim(t)) <> 'NOT_FOUND' AND field IN ({names})) GROUP BY doc))"""


@query(f"""WITH RECURSIVE {_SIDES}, {_GREEDY},
    al AS (SELECT doc, alignment FROM {_alignment_sql(documents.ROWS_OF_BANK)} WHERE doc >= 0 UNION ALL SELECT doc, alignment FROM {_alignment_sql(documents.ROWS_OF_ITEMS)} WHERE doc < 0)
    SELECT doc, round(coalesce(f, 0), 6) AS standard_f1, round(coalesce(alignment, 1.0), 6) AS alignment, round((coalesce(f, 0) + coalesce(alignment, 1.0)) / 2, 6) AS combined
    FROM (SELECT doc, avg(f1) FILTER (paired) AS f FROM ge GROUP BY doc) LEFT JOIN al USING (doc)""")
def evl4_correlation(spark, sf_dir):
    return documents.correlation(_pairs(spark, sf_dir), "case_id").drop("case_id")


# --- links and truth of images with several receipts ------------------------------------------
_TOL = 2.0
_E, _A = "upper(trim(coalesce(g.description, '')))", "upper(trim(coalesce(l.description, '')))"
_SPLIT = lambda x: f"list_distinct(list_filter(regexp_split_to_array({x}, '\\s+'), lambda z: z <> ''))"
_RECORDS = f"""
    ll AS (SELECT *, row_number() OVER (PARTITION BY image ORDER BY k) AS n FROM link_records), gg AS (SELECT *, row_number() OVER (PARTITION BY image ORDER BY k) AS n FROM link_truth),
    la AS (SELECT image, list(total ORDER BY n) AS t FROM ll GROUP BY image), ga AS (SELECT image, list(total ORDER BY n) AS t FROM gg GROUP BY image),
    st(image, i, used, hit) AS (SELECT image, 0, []::BIGINT[], NULL::BIGINT FROM la JOIN ga USING (image) UNION ALL
      SELECT image, i + 1, CASE WHEN h IS NULL THEN used ELSE list_append(used, h) END, h FROM (
        SELECT st.image, i, used, list_filter(range(1, len(la.t) + 1), lambda x: NOT list_contains(used, x) AND coalesce(abs(la.t[x] - ga.t[i + 1]) <= {_TOL}, false))[1] AS h FROM st JOIN la USING (image) JOIN ga USING (image) WHERE i < len(ga.t))),
    one AS (SELECT image, hit AS l, i AS g FROM st WHERE hit IS NOT NULL),
    rl AS (SELECT image, n, row_number() OVER (PARTITION BY image ORDER BY n) AS r FROM ll WHERE image IN (SELECT image FROM ga) AND (image, n) NOT IN (SELECT (image, l) FROM one)),
    rg AS (SELECT image, n, row_number() OVER (PARTITION BY image ORDER BY n) AS r FROM gg WHERE image IN (SELECT image FROM la) AND (image, n) NOT IN (SELECT (image, g) FROM one)),
    pr AS (SELECT image, l, g, 0 AS phase, g AS o FROM one UNION ALL SELECT coalesce(rl.image, rg.image), rl.n, rg.n, 1, coalesce(rl.r, rg.r) FROM rl FULL JOIN rg ON rl.image = rg.image AND rl.r = rg.r
      UNION ALL SELECT image, n, NULL, 2, n FROM ll WHERE image NOT IN (SELECT image FROM ga) UNION ALL SELECT image, NULL, n, 3, n FROM gg WHERE image NOT IN (SELECT image FROM la)),
    nr AS (SELECT *, CASE WHEN phase = 2 THEN 0 ELSE row_number() OVER (PARTITION BY image ORDER BY phase, o) - 1 END AS receipt FROM pr),
    rec AS (SELECT p.image, receipt, coalesce(g.expected, 'UNKNOWN') AS expected, CASE WHEN l.image IS NOT NULL THEN l.matched END AS actual,
      CASE WHEN g.image IS NULL THEN NULL WHEN l.image IS NULL THEN false ELSE (g.expected = 'FOUND') = l.matched END AS correct, coalesce(l.confidence, 'NONE') AS confidence,
      CASE WHEN g.image IS NOT NULL THEN coalesce(g.expected = 'FOUND' AND l.matched AND abs(l.amount - g.amount) <= {_TOL}, false) END AS amount_correct,
      CASE WHEN g.image IS NOT NULL THEN coalesce(g.expected = 'FOUND' AND l.matched AND l.date = g.date AND g.date <> '', false) END AS date_correct,
      CASE WHEN g.image IS NOT NULL THEN coalesce(g.expected = 'FOUND' AND l.matched AND {_A} <> '' AND {_E} <> '' AND (contains({_A}, {_E}) OR contains({_E}, {_A}) OR len(list_intersect({_SPLIT(_E)}, {_SPLIT(_A)})) * 2 >= len({_SPLIT(_E)})), false) END AS description_correct,
      CASE WHEN phase = 2 THEN 'no_ground_truth' WHEN phase = 3 THEN 'missing_link_output' WHEN l.image IS NULL THEN 'unmatched_ground_truth' WHEN g.image IS NULL THEN 'unmatched_link_output' END AS error
      FROM nr p LEFT JOIN ll l ON l.image = p.image AND l.n = p.l LEFT JOIN gg g ON g.image = p.image AND g.n = p.g)"""


def _records(spark, sf_dir):
    return linking.evaluate_receipts(view(spark, sf_dir, "link_records"), view(spark, sf_dir, "link_truth"), _TOL)


@query(f"WITH RECURSIVE {_RECORDS} SELECT * FROM rec")
def jn6_evl10_receipt_records(spark, sf_dir):
    return _records(spark, sf_dir)


@query(f"""WITH RECURSIVE {_RECORDS}, m AS (SELECT count(*) AS receipts, count(*) FILTER (correct) AS correct, count(*) FILTER (expected = 'FOUND' AND actual) AS tp, count(*) FILTER (expected = 'NOT_FOUND' AND actual) AS fp, count(*) FILTER (expected = 'FOUND' AND NOT coalesce(actual, false)) AS fn,
    count(*) FILTER (expected = 'FOUND' AND actual AND amount_correct) AS a, count(*) FILTER (expected = 'FOUND' AND actual AND date_correct) AS d, count(*) FILTER (expected = 'FOUND' AND actual AND description_correct) AS e FROM rec WHERE correct IS NOT NULL)
    SELECT receipts, correct, tp, fp, fn, round(correct / receipts::DOUBLE, 6) AS accuracy, round(tp / (tp + fp)::DOUBLE, 6) AS precision, round(tp / (tp + fn)::DOUBLE, 6) AS recall, round(a / tp::DOUBLE, 6) AS amount_accuracy, round(d / tp::DOUBLE, 6) AS date_accuracy, round(e / tp::DOUBLE, 6) AS description_accuracy FROM m""")
def evl10_receipt_metrics(spark, sf_dir):
    return linking.receipt_metrics(_records(spark, sf_dir))


@query(f"""WITH RECURSIVE {_RECORDS} SELECT confidence, count(*) AS n, any_value(t) AS receipts, round(any_value(t) / 90.0::DOUBLE * 60, 6) AS per_minute FROM rec, (SELECT count(*) AS t FROM rec WHERE correct IS NOT NULL) WHERE correct IS NOT NULL GROUP BY confidence""")
def agg9_confidence_throughput(spark, sf_dir):
    return linking.confidence_throughput(_records(spark, sf_dir), 90.0)


# --- the simple evaluator ------------------------------------------------------------------------
_PAIRS = """(SELECT -doc - 1 AS doc, field, CASE WHEN (-doc - 1) % 9 = 0 AND field = 'SUPPLIER_NAME' THEN ' ' WHEN field = 'BUSINESS_ABN' THEN replace(got, '53', '5 3') ELSE got END AS value, CASE WHEN (-doc - 1) % 8 = 1 AND field = 'PAYER_NAME' THEN '' ELSE want END AS truth FROM doc_values WHERE doc < 0
    UNION ALL SELECT doc, field, got, want FROM doc_values WHERE doc >= 0 UNION ALL SELECT DISTINCT doc, 'DOCUMENT_TYPE', CASE WHEN doc % 2 = 0 THEN 'Account Statement' ELSE 'memo' END, 'BANK_STATEMENT' FROM doc_values WHERE doc >= 0)"""
_TYPE = lambda x: "CASE " + " ".join(f"WHEN {x} IN ({', '.join(repr(w) for w in (name, *words))}) THEN '{name}'" for name, words in ALIASES.items()) + f" ELSE {x} END"
_CASH = lambda x: f"(regexp_matches({x}, '[$£€.,]') AND regexp_matches({x}, '[0-9]'))"
_WHOLE = lambda x: f"round_even(TRY_CAST(regexp_replace({x}, '[^0-9.]', '', 'g') AS DOUBLE), 0)"
_DIGITS = lambda x: f"regexp_replace({x}, '[^0-9]', '', 'g')"
_LONG = lambda x: f"(length({_DIGITS(x)}) >= 8 AND length({_DIGITS(x)}) / length(replace({x}, ' ', ''))::DOUBLE > 0.7)"
_SHARED = lambda a, b: f"CASE WHEN length({b}) <= 3 THEN {a} = {b} WHEN length({a}) = 0 THEN false ELSE len(list_filter(string_split({a}, ''), lambda ch: contains({b}, ch))) / greatest(length({a}), length({b}))::DOUBLE >= 0.85 END"
_ITEM = lambda a, b: f"CASE WHEN {_CASH(a)} OR {_CASH(b)} THEN coalesce({_WHOLE(a)} = {_WHOLE(b)}, false) ELSE {a} = {b} OR {_SHARED(a, b)} END"


@query(f"""WITH p AS (SELECT doc, field, trim(coalesce(value, '')) = '' AS none, regexp_replace(trim(lower(value)), '^"+|"+$', '', 'g') AS v, regexp_replace(trim(lower(truth)), '^"+|"+$', '', 'g') AS t FROM {_PAIRS} WHERE trim(coalesce(truth, '')) <> '' AND field <> 'ACCOUNT_BALANCE'),
    l AS (SELECT *, {_IT('v')} AS a, {_IT('t')} AS b FROM p),
    s AS (SELECT doc, field, CASE WHEN none THEN 'missing' WHEN coalesce(CASE WHEN v = t THEN true WHEN {_TYPE('v')} = {_TYPE('t')} THEN true
        WHEN contains(v, '|') OR contains(t, '|') THEN CASE WHEN contains(v, 'not_found') AND contains(t, 'not_found') THEN true WHEN contains(v, 'not_found') OR contains(t, 'not_found') THEN false ELSE len(a) = len(b) AND len(list_filter(range(1, len(a) + 1), lambda i: NOT coalesce({_ITEM('a[i]', 'b[i]')}, false))) = 0 END
        WHEN {_CASH('t')} OR {_CASH('v')} THEN coalesce({_WHOLE('v')} = {_WHOLE('t')}, false) WHEN {_LONG('t')} OR {_LONG('v')} THEN {_DIGITS('v')} = {_DIGITS('t')} ELSE {_SHARED('v', 't')} END, false) THEN 'right' ELSE 'incorrect' END AS state FROM l)
    SELECT doc, count(*) AS fields, count(*) FILTER (state = 'right') AS "right", round(count(*) FILTER (state = 'right') / count(*)::DOUBLE, 6) AS accuracy, coalesce(string_agg(field, ',' ORDER BY field) FILTER (state = 'missing'), '') AS missing, coalesce(string_agg(field, ',' ORDER BY field) FILTER (state = 'incorrect'), '') AS incorrect FROM s GROUP BY doc""")
def evl8_simple_evaluation(spark, sf_dir):
    d, f, got, want = (F.col(c) for c in ("doc", "row.field", "row.got", "row.want"))
    kind = F.struct(F.lit("DOCUMENT_TYPE").alias("field"), F.lit("BANK_STATEMENT").alias("want"), F.when(d % 2 == 0, "Account Statement").otherwise("memo").alias("got"))
    docs = doc_cases(spark, sf_dir).filter("doc IS NOT NULL").withColumn("fields", F.when(d >= 0, F.concat("fields", F.array(kind))).otherwise(F.col("fields")))
    k = -d - 1
    rows = each(docs.select("case_id", F.when(d < 0, k).otherwise(d).alias("key"), "doc", "fields"), "fields", "n", "row")
    value = F.when((d < 0) & (k % 9 == 0) & (f == "SUPPLIER_NAME"), " ").when((d < 0) & (f == "BUSINESS_ABN"), F.replace(got, F.lit("53"), F.lit("5 3"))).otherwise(got)
    truth = F.when((d < 0) & (k % 8 == 1) & (f == "PAYER_NAME"), "").otherwise(want)
    return scoring.simple_evaluation(rows.select("case_id", F.col("key").alias("doc"), f.alias("field"), value.alias("value"), truth.alias("truth")), "case_id").drop("case_id")


@query("SELECT o_orderkey AS doc, row_number() OVER (ORDER BY CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '3-MEDIUM' THEN 2 ELSE 3 END, CASE WHEN o_orderkey % 5 <> 0 THEN floor(o_totalprice / 1000) END DESC NULLS LAST, o_orderkey) AS place FROM orders ORDER BY place LIMIT 500")
def srt1_extraction_order(spark, sf_dir):
    """The first 500 documents in the order in which they are read: a top-k report, so no task sorts the whole table."""
    docs = spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.col("o_orderkey").alias("doc"), F.col("o_orderpriority").alias("kind"), F.when(F.col("o_orderkey") % 5 != 0, F.floor(F.col("o_totalprice") / 1000)).alias("area"))
    order = [*routing.extraction_order(("1-URGENT", "3-MEDIUM"), F.col("kind"), F.col("area"), largest_first=True), F.col("doc")]
    first = docs.orderBy(*order).limit(500)
    return first.agg(F.array_sort(F.collect_list(F.struct(F.when(F.col("kind") == "1-URGENT", 1).when(F.col("kind") == "3-MEDIUM", 2).otherwise(3).alias("t"), F.coalesce(-F.col("area"), F.lit(1)).alias("a"), "doc"))).alias("x")).select(F.posexplode("x.doc").alias("place", "doc")).select("doc", (F.col("place") + 1).cast("long").alias("place"))
