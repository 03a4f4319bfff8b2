"""Cases that only larger tables hold."""

import os

import duckdb
import pytest
from pyspark.sql import functions as F
from test_oracle import rows_of

from ledgerloom.functions import cleaning, dates, matching, similarity, text
from ledgerloom.functions.arrays import each
from ledgerloom.llm import rp_forest
from ledgerloom.operators import blocks, documents, projection, quality, scoring, statement_maths, statements
from ledgerloom.plans import registry
from ledgerloom.plans.views import TABLES

SF = "/root/testdata/sf0.001"


@pytest.fixture
def same(spark, tmp_path):
    """A comparison of a query with its SQL on the smallest tables, some of them replaced by a query over them."""

    def run(name, **tables):
        con = duckdb.connect()
        for t in TABLES:
            own = f"{tmp_path}/{t}.parquet"
            if t in tables:
                con.execute(f"COPY ({tables[t].replace('FROM ' + t, f"FROM '{SF}/{t}.parquet'")}) TO '{own}' (FORMAT parquet)")
            elif not os.path.exists(own):
                os.symlink(f"{SF}/{t}.parquet", own)
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{own}')")
        want = con.execute(registry.oracle_sql()[name])
        columns, rows = [d[0] for d in want.description], want.fetchall()
        got = registry.queries()[name](spark, str(tmp_path))
        assert rows_of(got.columns, [tuple(r) for r in got.collect()]) == rows_of(columns, rows)

    return run


@pytest.mark.parametrize("name", ["tru2_par15_trust_checks", "tru3_clean_trust"])
def test_half_cents_of_trust_cases(same, name):
    same(name, customer="SELECT * REPLACE (3696.65::DOUBLE + c_custkey * 10 AS c_acctbal) FROM customer")


def test_what_the_driver_gets_of_the_forest(spark):
    n, sample = 40_000, 500
    rows = spark.range(n).repartition(16).select(F.array(F.col("id").cast("double"), F.rand(5)).alias("vec")).cache()
    chosen = rp_forest.fitting_sample(rows, n, sample)
    assert sorted(r["vec"] for r in chosen.collect()) == sorted(r["vec"] for r in rows.orderBy(F.xxhash64("vec")).limit(sample).collect())
    assert rp_forest.candidates(rows, n, sample).count() < 3 * sample
    assert rp_forest.block_size(100) == rp_forest.QUERY_BLOCK and 5000 * rp_forest.block_size(5000) <= rp_forest.PROBES and rp_forest.block_size(1 << 30) == 1


@pytest.fixture
def pairs(spark):
    return spark.sql("""SELECT * FROM VALUES (1, 'invoice', map('LINE_ITEM_DESCRIPTIONS', 'a b | c | a b', 'TOTAL_AMOUNT', '5'), map('LINE_ITEM_DESCRIPTIONS', 'c | a b | d | a b', 'TOTAL_AMOUNT', '5.00')),
        (2, 'bank_statement', map('OTHER', 'x'), map('TRANSACTION_DATES', '01/02/2024 | 02/02/2024')) AS t(doc, doc_type, got, want)""")


def test_one_pass_gives_both_agnostic_scores(pairs):
    both = {(r["doc"], r["field"]): r["agnostic"] for r in documents.evaluate_fields(pairs, "kieval").collect()}
    assert both == {(r["doc"], r["field"]): r["f1"] for r in documents.evaluate_fields(pairs, "position_agnostic").collect()}


def test_correlation_reads_documents_once(pairs):
    out = documents.correlation(pairs)
    assert "Join" not in out._jdf.queryExecution().executedPlan().toString()
    assert {(r["doc"], r["standard_f1"], r["alignment"]) for r in out.collect()} == {(1, 0.428571, 0.0), (2, 0.0, 1.0)}


@pytest.mark.parametrize("name", ["bnk1_rul16_rul17_rows", "flt7_srt1_aligned_registers", "evl7_evl6_document_fields", "evl7_document_summary"])
def test_no_second_reading_in_a_filter(spark, name):
    plan = registry.queries()[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in plan.split("\n") if "Filter (size(" in line]


def test_each_gives_what_explode_gives(spark):
    df = spark.sql("SELECT * FROM VALUES (1, array('a', NULL), map('k', 'v')), (2, array(), map()), (3, NULL, NULL) AS t(id, xs, m)")
    assert sorted(map(tuple, each(df.drop("m"), "xs", "n", "x").collect())) == [(1, 0, "a"), (1, 1, None)]
    assert [tuple(r) for r in each(df.drop("xs"), "m", "k", "v").collect()] == [(1, "k", "v")]


@pytest.mark.parametrize(
    "made, part, most",
    [
        (lambda c: statement_maths.reclassify(F.col("p"), F.col("r"), c), "upper(", 1), (lambda c: dates.ladder(c, dates.STATEMENT_LADDER), "trim(", 1), (lambda c: statement_maths.statement_balances(c), "coalesce(c", 1),
        (blocks.receipt_blocks, "substring_index(", 1), (blocks.repair_json, "regexp_extract_all(", 1), (cleaning.clean_money, "AUD?", 1), (lambda c: cleaning.clean_list(F.lit("LINE_ITEM_PRICES"), c), "AUD?", 1),
        (lambda c: quality.business_flags(c)["items_off"], "LINE_ITEM_QUANTITIES", 2), (lambda c: scoring.scalar_score(F.col("f"), c, F.lit("x")), "nullif(trim(c", 1), (lambda c: scoring.simple_match(c, F.lit("x")), "lower(c)", 1),
    ],
)
def test_what_is_used_often_is_worked_out_once(spark, made, part, most):
    assert str(made(F.col("c"))).count(part) <= most


def test_dates_are_read_before_they_are_paired(spark):
    plan = registry.queries()["dat4_set5_date_scores"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" in plan and "regexp_extract_all" not in plan[: plan.index("Join")]


def test_strip_without_a_pattern(spark):
    assert "regexp" not in str(statements.strip(F.col("c")))
    texts = [f"{w}a{w} b{w}{w}" for w in [*map(chr, range(1, 0x3100)), "", " \n"]]
    df = spark.createDataFrame([(t,) for t in texts], "c string")
    assert df.filter(statements.strip(F.col("c")) != F.regexp_replace("c", r"(?U)^\s+|\s+$", "")).count() == 0


def test_short_texts_are_compared_without_rows_of_numbers(monkeypatch):
    pairs = [("forest lamp", "lamp forest x"), ("", "a"), ("abab", "baba"), ("same", "same")]
    want = [2.0 * similarity.matching_characters(a, b) / len(a + b) for a, b in pairs]
    monkeypatch.setattr(similarity, "matching_characters", None)
    assert [similarity._ratio(a, b) for a, b in pairs] == want


@pytest.mark.parametrize("form", ["balance", "amount"])
def test_lines_begin_as_their_patterns_do(spark, form):
    heads = ["", "1.", "12. ", "**", "*", "-", "- ", "1. **", "1.[", "1. Date: ", "**date:** ", "Date ", "7 Date", "* Date", "x", "1"]
    tails = ["01/02/2024", "01/02/2024**", "1 Feb 2024", "Thu 1 Feb 2024", "[1 Feb]", "1 Feb", "1 Feb 24", "Amount: 3", "Debit:** 4", "**Debit Amount:** 4", "Details", ""]
    df = spark.createDataFrame([(h + t,) for h in heads for t in tails], "c string")
    dated = df.select("c", *[statements.strip(F.regexp_extract("c", p, 1)).alias(f"d{k}") for k, p in enumerate((statements._LABEL, *statements.DATE_LINES[form]))])
    assert dated.filter(F.greatest(*[F.length(c) for c in dated.columns[1:]]) > 0).filter(~F.col("c").rlike(statements._DATE_START)).count() == 0
    for start, pattern in zip(statements._FIELD_START[form], statements.FIELD_LINES[form], strict=True):
        assert df.filter((F.regexp_extract("c", pattern, 1) != "") & ~F.col("c").rlike(start)).count() == 0
    assert "CASE WHEN" in str(statements.read_line(F.col("c"), form))


def test_means_that_are_exact_halves_go_up(spark):
    f1 = [4 / 5, 3 / 5, 14 / 15, 11 / 12, 9 / 10, 7 / 10, 15 / 16, 1 / 10]  # the mean is 0.7359375, its sum in this order a little less
    df = spark.createDataFrame([(1, "invoice", f"f{i}", "x", "x", x, x, x) for i, x in enumerate(f1)], "doc long, doc_type string, field string, value string, truth string, f1 double, precision double, recall double").coalesce(1)
    assert documents.summarise(df).select("accuracy", "precision", "recall").first() == (0.735938, 0.735938, 0.735938)


def test_lists_are_misread_once(spark):
    plan = projection.perturbed(spark.sql("SELECT id AS doc, 'f' AS field, concat('a|', id) AS value FROM range(3)"), 0.3, 0.4, seed=7)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("|drop") == 1 and plan.count("concat_ws(") == 1


def test_no_item_is_compared_after_one_is_found(spark):
    match = lambda a, b: F.when(b == "never", F.raise_error(F.lit("compared")).cast("boolean")).otherwise(a == b)
    df = spark.sql("SELECT array('a', 'b') AS got, array('b', 'a', 'never') AS want, CAST(NULL AS array<string>) AS none")
    assert df.select(scoring.greedy_matches(F.col("got"), F.col("want"), match), scoring.greedy_matches(F.col("none"), F.col("want"), match), scoring.greedy_matches(F.col("got"), F.col("none"), match)).first() == (2, 0, 0)


def test_read_texts_are_compared_as_texts_are(spark):
    texts = ["", " ", "a", "A b", "a  b ", "b a", "large red lamp 12", "large red lamp 13", "LARGE red lamp 1", "small red lamp 12", "red lamp large 12 x", "abcdefghij", "abcdefghiX", "abcdefghXX", None]
    df = spark.createDataFrame([(a, b) for a in texts for b in texts], "a string, b string")
    both = df.select("a", "b", text.fuzzy_equal(F.col("a"), F.col("b")).alias("x"), text.reads_equal(text.read_text(F.col("a")), text.read_text(F.col("b"))).alias("y")).collect()
    assert [(r.a, r.b) for r in both if bool(r.x) != bool(r.y)] == [] and any(r.y and r.a != r.b for r in both)


def test_statement_dates_are_read_once(spark):
    plan = registry.queries()["bnk6_bnk7_statement_fields"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("gettimestamp(") == len(dates.REGISTER_LADDER) and plan.count("Aggregate [") == 1


@pytest.mark.parametrize("name", ["str20_business_flags", "evl8_simple_evaluation", "evl5_methods", "evl7_evl6_document_fields", "evl7_document_summary"])
def test_documents_come_from_one_shuffle(spark, name):
    plan = registry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_correlation_shuffles_lines_once_and_then_sums(spark):
    plan = registry.queries()["evl4_correlation"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2 and "partial_avg" in plan[: plan.rindex("Exchange hashpartitioning")]
    assert plan.count("ArrowEvalPython") == 2 and "aggregate(" not in plan


def test_batches_compare_items_as_expressions_do(spark):
    texts = """|a|a b c d|d c b a|a b c e|a  b c\td|\t|\x0b|\u00a0|abcdefghij|ABCDEFGHIJ|abcdefghiX|abcdefgXiX|bcdefghij|1|1.00|$1.009|-1|0|0.01|0.011|1-2|1.2.3|.5|5.|-.5|1e5|--1|100|101|99|101.01|1/2/2024|01/02/2024|1 Feb 2024|1 feb 24
        |Feb 2024|1 Feb|1/2|1 2 51|1 2 50|feb|NOT_FOUND|ß|SS|İ|ΑΣ|ας|large red lamp 12|large red lamp 13|1 mar apr 2024|\u0663|3|a\nb|kitten sitting on a mat|kitten sittin on a mat|kitten sittin on mat""".split("|")
    df = spark.createDataFrame([(k, a, b) for k in matching.KINDS for a in texts for b in texts], "k string, a string, b string")
    same = documents.items_match(F.col("k"), F.col("a"), F.col("b"))
    for r in df.select("k", "a", "b", same.alias("same")).collect():
        read, equal = matching.KINDS[r.k]
        assert bool(equal(read(r.a), read(r.b))) == r.same, r
    lists = ["", "a", "a | b", "b | a | c", "12 | 12.05 | NOT_FOUND | 12", "12.1 | 12", "red lamp 1 | red lamp 2 | red lamp", "red lamp 2 | lamp | red lamp 1", "1 Feb 2024 | 01/02/24 | soon", "01/02/2024 | 1 feb 24"]
    df = spark.createDataFrame([(k, a, b) for k in matching.KINDS for a in [*lists, None] for b in lists], "k string, a string, b string")
    k, a, b = F.col("k"), documents.items(F.col("a")), documents.items(F.col("b"))
    want = scoring.greedy_matches(documents.read_items(k, a), documents.read_items(k, b), lambda x, y: documents.reads_match(k, x, y))
    rows = df.select("a", matching.greedy_hits(k, F.col("a"), F.col("b")).alias("x"), want.alias("y")).collect()
    assert [r for r in rows if r.x != (None if r.a is None else r.y)] == [] and max(r.y for r in rows) > 1


def test_rows_of_lists_that_belong_together():
    of = lambda got, want: matching.whole(["date", "text", "money"], got, want)
    assert of([None] * 3, ["x"] * 3) is None and of([None, "a", None], [None, "|", None]) == 0.0
    assert of(["1/2/24 | 3/2/24", "a | b", "5"], ["1 Feb 2024 | 4 Feb 2024 | x", "a | b", "5.04 | 6"]) == 0.5
    assert of(["1/2/24", "a | c", None], ["1 Feb 2024", "a | b", "7"]) == 1.0


def test_flags_of_orders_that_are_there_twice_or_have_a_statements_key(same):
    moved = "SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey + 100000000 ELSE o_orderkey END AS o_orderkey) FROM orders"
    same("str20_business_flags", orders=f"{moved} UNION ALL SELECT * REPLACE (o_orderkey - o_orderkey % 2 AS o_orderkey) FROM orders WHERE o_orderkey < 40")


def test_evaluation_of_orders_that_are_there_twice_or_not_at_all(same):
    same("evl8_simple_evaluation", orders="SELECT * FROM orders WHERE o_orderkey % 5 <> 0 UNION ALL SELECT * REPLACE (o_totalprice + 1 AS o_totalprice) FROM orders WHERE o_orderkey BETWEEN 10 AND 40")
