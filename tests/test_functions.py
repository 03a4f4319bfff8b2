"""Literal vectors of the scalar library."""

import datetime

from pyspark.sql import functions as F

from ledgerloom.functions import dates, money, text
from ledgerloom.operators import bank, linking, parsers, rules, scoring


def one(spark, column, *values):
    names = "abcd"[: max(1, len(values))]
    df = spark.createDataFrame([tuple(values) or (0.0,)], ", ".join(f"{n} {'string' if isinstance(v, str) or v is None else 'double'}" for n, v in zip(names, values or (0.0,), strict=True)))
    return df.select(column.alias("x")).first()["x"]


def test_amounts(spark):
    a = F.col("a")
    for t, want in (("$127.35", 127.35), ("-$127.35", -127.35), ("1,234.56", 1234.56), ("(5)", -5.0), ("NOT_FOUND", None), (None, None), ("", None), ("abc", None), ("NaN", None)):
        assert one(spark, money.parse_signed(a), t) == want
    assert one(spark, money.parse_bracketed(a), "(1,234.00)") == -1234.0
    assert one(spark, money.parse_plain(a), "(1,234.00)") is None
    assert one(spark, money.parse_ledger(a), "$45.00 CR") == 45.0
    assert one(spark, money.abn_valid(a), "51 824 753 556") is True
    assert one(spark, money.abn_valid(a), "51824753557") is False
    assert one(spark, money.debit_text(a), "(9.72)") == "-$9.72"


def test_canonical_abn(spark):
    f = money.canonical_abn(F.col("a"), F.col("b"), F.col("c"))
    assert one(spark, f, "", "51824753556", "51824753556") == "51824753556"
    assert one(spark, f, "1", "2", "") == "1"
    assert one(spark, f, None, None, None) == ""


def test_dates(spark):
    d = dates.parse_date(F.col("a"))
    for t in ("18 Mar 2024", "18/03/2024", "2024-03-18", "18 March 24", "18-3-24"):
        assert one(spark, d, t) == datetime.date(2024, 3, 18)
    assert one(spark, d, "22 Dec 69") == datetime.date(1969, 12, 22)
    assert one(spark, d, "31/02/2024") is None and one(spark, d, "NOT_FOUND") is None
    p = dates.date_parts(F.col("a"))
    assert tuple(one(spark, p, "Tue 18 Mar 24")) == (18, 3, 2024)
    assert tuple(one(spark, p, "2024-03-18")) == (2024, 3, 2018)  # read by position
    day = lambda c: F.to_date(F.col(c))
    assert one(spark, dates.business_days(day("a"), day("b")), "2024-03-15", "2024-03-18") == 1
    assert one(spark, dates.business_days(day("a"), day("b")), "2024-03-18", "2024-03-16") == 1
    assert one(spark, dates.date_score(day("a"), day("b")), "2024-03-15", "2024-03-15") == 1.0


def test_text(spark):
    a, b = F.col("a"), F.col("b")
    assert abs(one(spark, text.anls(a, b), "2x USB Hub 4-port", "USB Hub 4-port") - 0.8235) < 1e-3
    assert one(spark, text.jaccard(a, b), "2x USB Hub 4-port", "USB Hub 4-port") == 0.75
    assert one(spark, text.fuzzy_equal(a, b), "BPAY VERRALL REF30033", "BPAY VERRALL REF74032") is False
    assert one(spark, text.containment(a, b), "A & B", "A AND B LTD") == 1.0
    for t, want in (("3x", "3"), ("x3", "3"), ("3 EACH", "3"), ("BOX", "BOX"), ("EACH", "EACH")):
        assert one(spark, text.strip_quantity(a), t) == want
    assert one(spark, text.case_id(a), "case12_page1.png") == "CASE12"


def test_scalar_scores(spark):
    f = lambda field: scoring.scalar_score(F.lit(field), F.col("a"), F.col("b"))
    assert one(spark, f("TOTAL_AMOUNT"), "$9.72", "9.72") == 1.0
    assert one(spark, f("SUPPLIER_NAME"), "NOT_FOUND", "Acme") == 0.0
    assert one(spark, f("SUPPLIER_NAME"), "NOT_FOUND", "NOT_FOUND") == 1.0
    assert one(spark, f("IS_GST_INCLUDED"), "yes", "TRUE") == 1.0
    assert one(spark, f("BUSINESS_ABN"), "ABN: 51 824", "51824") == 1.0


def test_list_scores_count_a_wrong_item_once(spark):
    rows = lambda items: spark.createDataFrame([(1, i, x) for i, x in enumerate(items)], "doc long, pos long, item string")
    r = scoring.score_lists(rows(["2", "1", "3"]), rows(["1", "2", "3"])).first()
    assert (r.tp, r.fp, r.fn, r.precision, r.f1) == (1, 0, 2, 1.0, 0.5)
    assert scoring.position_agnostic(rows(["2", "1", "3"]), rows(["1", "2", "3"])).first().f1 == 1.0


def test_rules(spark):
    kind = lambda roles, paid, travel: one(spark, rules.first_type(F.array(*map(F.lit, roles)) if roles else F.array().cast("array<string>"), F.lit(paid), F.lit(travel)))
    assert kind(["balance"], True, False) == "BANK_STATEMENT"
    assert kind(["gst"], True, False) == "RECEIPT"
    assert kind([], True, True) == "TRAVEL"
    assert kind([], False, False) == "INVOICE"


def test_parsers(spark):
    m = one(spark, parsers.key_values(F.col("a")), "x: 1\nnothing\nX: 2\ny:\nz: a: b")
    assert m == {"X": "2", "Z": "a: b"}
    df = spark.createDataFrame([("**Items:**\n- one\n- two\n\nTotal: $5\n",), (None,), ("",)], "raw string")
    got = [r.fields for r in parsers.field_lines(df, "raw", ("ITEMS", "TOTAL"), ("ITEMS",)).collect()]
    assert got == [{"ITEMS": "one | two", "TOTAL": "$5"}, {"ITEMS": "NOT_FOUND", "TOTAL": "NOT_FOUND"}, {"ITEMS": "NOT_FOUND", "TOTAL": "NOT_FOUND"}]


def test_links_are_one_to_one(spark):
    d = datetime.date(2024, 3, 18)
    receipts = spark.createDataFrame([(1, 1, "acme", d, 10.0), (1, 2, "acme", d, 10.0), (1, 3, "other", None, 10.0), (2, 1, "x", None, None)], "case_id long, rid long, supplier string, receipt_date date, total double")
    rows = spark.createDataFrame([(1, 1, d, "ACME SHOP", 10.0), (1, 2, None, "SHOP", 10.0)], "case_id long, pos long, txn_date date, description string, amount double")
    got = {(r.case_id, r.rid): (r.pos, r.confidence) for r in linking.assign(receipts, rows).collect()}
    assert got == {(1, 1): (1, "HIGH"), (1, 2): (2, "LOW"), (1, 3): (None, "NONE"), (2, 1): (None, "NONE")}


def test_register_correction(spark):
    t = spark.createDataFrame([(1, 1, "opening balance", 0.0, 0.0, 50.0), (1, 2, "a", 0.0, 0.0, 100.0), (1, 3, "b", 0.0, 10.0, 90.0), (1, 4, "c", 5.0, 0.0, None), (1, 5, "d", 1.0, 0.0, 110.0)], "case_id long, pos long, description string, debit double, credit double, balance double")
    got = [(r.pos, r.action, r.new_debit, r.new_credit) for r in bank.correct(t).orderBy("pos").collect()]
    assert got == [(2, "kept", 0.0, 0.0), (3, "swapped", 10.0, 0.0), (4, "kept", 5.0, 0.0), (5, "derived", 0.0, 20.0)]
