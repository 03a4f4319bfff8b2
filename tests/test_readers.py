"""Readers, statement maths, document scores and links on literal vectors and against plain Python."""

import json
import random
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions.similarity import matching_characters, matching_ratio
from ledgerloom.operators import answers, blocks, documents, linking, nodes, parsers, quality, scoring, statement_maths, statements
from ledgerloom.streaming.header_cache import cached_batch, cached_stream

TRANSCRIPT = """intro
1. **Date:** 03/05/2025
   - Description: Card Purchase K MART
     - Perth WA
   - Debit: $12.00
   - Balance: $100.00
   - Transaction: second
2. **Thu 04 Sep 2025**
**Description:** bold one
**Debit Amount:** 5.00
  - Mystery: x
3. **20 May**
 - Amount: 7"""


def one(spark, text, column):
    return spark.createDataFrame([(text,)], "t string").select(column(F.col("t")).alias("x")).first().x


def test_statement_rows(spark):
    got = [tuple(r) for r in one(spark, TRANSCRIPT, statements.statement_rows)]
    assert got == [
        ("03/05/2025", "Card Purchase K MART Perth WA", "$12.00", None, None, "$100.00"), ("03/05/2025", "second", None, None, None, None),
        ("Thu 04 Sep 2025", "bold one", "5.00", None, None, None), ("20 May", None, "7", None, None, None),
    ]
    amount = lambda c: statements.statement_rows(c, "amount")
    assert [tuple(r) for r in one(spark, "1. 03/06/23\n - SHOP NSW \n - Card xx1\n - Value Date: 2\n - not this\n - Amount: -4", amount)] == [("03/06/23", "SHOP NSW Card xx1", None, None, "-4", None)]
    for empty in (None, "", "\n \n"):
        assert one(spark, empty, statements.statement_rows) == [] and one(spark, empty, amount) == []
    long = "\n".join(f"{i}. 01/02/2024\n - Description: row {i}\n - Debit: {i}" for i in range(1, 400))
    assert len(one(spark, long, statements.statement_rows)) == 399


FIELDS = ("DOCUMENT_TYPE", "SUPPLIER_NAME", "BUSINESS_ADDRESS", "INVOICE_DATE", "LINE_ITEM_DESCRIPTIONS", "LINE_ITEM_QUANTITIES", "TOTAL_AMOUNT")


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("* **SUPPLIER_NAME:** Ace\nKEY: TOTAL_AMOUNT: $5\nsupplier_name: Bee", {"SUPPLIER_NAME": "Bee", "TOTAL_AMOUNT": "$5"}),
        ("LINE_ITEM_DESCRIPTION:\n\n* apple: red\n- pear\n\nTOTAL_AMOUNT: 7", {"LINE_ITEM_DESCRIPTIONS": "apple: red | pear", "TOTAL_AMOUNT": "7"}),
        ("LINE_ITEM_DESCRIPTIONS:\nnot a bullet\nLINE_ITEM_QUANTITIES: 3x, 2 EACH", {"LINE_ITEM_QUANTITIES": "3 | 2"}),
        ("**SUPPLIER NAME:**\n\nAce\nHardware\n**BUSINESS_ADDRESS:**\n1 High Street: rear, VIC\n**TOTAL_AMOUNT:** $8", {"SUPPLIER_NAME": "Ace Hardware", "BUSINESS_ADDRESS": "1 High Street: rear  VIC", "TOTAL_AMOUNT": "$8"}),
        ("**LINE_ITEM_DESCRIPTIONS:**\n* a\n* b", {"LINE_ITEM_DESCRIPTIONS": "a | b"}),
        ('```json\n{"SUPPLIER_NAME": "Ace", "TOTAL_AMOUNT": "8", "INVOICE_DATE": "cut he', {"SUPPLIER_NAME": "Ace", "TOTAL_AMOUNT": "8", "INVOICE_DATE": "cut he"}),
        ("INVOICE_DATE: 2024-03-18\nLINE_ITEM_DESCRIPTIONS: a  b c   d", {"INVOICE_DATE": "18/03/2024", "LINE_ITEM_DESCRIPTIONS": "a | b c | d"}),
        ("I'll extract SUPPLIER_NAME: no\nHere is the\nassistant\n\nSUPPLIER_NAME: yes", {"SUPPLIER_NAME": "yes"}),
        ("", {}), (None, {}), ("no fields", {}), ("SUPPLIER_NAME:\n", {}),
    ],
)
def test_fields_of_responses(spark, text, want):
    df = spark.createDataFrame([(text, 1)], "t string, fields int")
    got = parsers.field_lines(df.drop("fields"), "t", FIELDS, artifacts=True).first().fields
    assert got == dict.fromkeys(FIELDS, "NOT_FOUND") | want


def test_repair_json_at_every_cut(spark):
    text = '{"a": "x\\"y", "b": [1, {"c": null}, "z"], "d": {"e": {}, "f": -2.5e1}, "g": true}'
    cuts = [(i, text[:i]) for i in range(len(text) + 1)]
    df = spark.createDataFrame(cuts, "n int, t string").select("n", blocks.repair_json(F.col("t")).alias("kept"), blocks.repair_json(F.col("t"), keep_cut=False).alias("whole"))
    whole = json.loads(text)

    def part_of(x, y, cut):
        """x is a beginning of y; with ``cut`` a last text or number may be a part."""
        if isinstance(x, dict):
            return isinstance(y, dict) and list(x) == list(y)[: len(x)] and all(part_of(v, y[k], cut and i == len(x) - 1) for i, (k, v) in enumerate(x.items()))
        if isinstance(x, list):
            return isinstance(y, list) and len(x) <= len(y) and all(part_of(v, w, cut and i == len(x) - 1) for i, (v, w) in enumerate(zip(x, y)))
        return x == y or cut and (isinstance(x, str) and isinstance(y, str) and y.startswith(x) or type(x) in (int, float) and type(y) in (int, float))

    before = ["", ""]
    for r in df.orderBy("n").collect():
        for k, (value, cut) in enumerate(((r.kept, True), (r.whole, False))):
            assert (value is None) == (r.n == 0)
            if value is not None:
                assert part_of(json.loads(value), whole, cut), (r.n, value)
                assert k == 0 or len(json.dumps(json.loads(value))) >= len(before[k]) - 1  # never less than a shorter cut gives
                before[k] = json.dumps(json.loads(value))
    assert json.loads(df.filter(F.col("n") == len(text)).first().whole) == whole
    assert one(spark, 'so:\n```json\n{"a": "b"\n"c": [1,],}\n``` {"x"', blocks.repair_json) == '{"a":"b","c":[1]}'
    assert one(spark, "nothing", blocks.repair_json) is None and one(spark, None, blocks.repair_json) is None
    long = '{"a": "' + "x" * 200_000
    assert one(spark, long, blocks.repair_json) == '{"a":"' + "x" * 200_000 + '"}'


def test_blocks_out_of_order_and_without_end(spark):
    text = "STORE: early\n--- RECEIPT 2 ---\nSTORE: b\nstore: c\nTOTAL: 1:2\nRECEIPT 1\nnothing\nreceipt 7\nDATE:"
    assert one(spark, text, blocks.receipt_blocks) == [{"STORE": "c", "TOTAL": "1:2"}, {"DATE": ""}]
    link = '{"matched_transaction": "FOUND", "Receipt_Store": "Shop", "x": 1}'
    assert one(spark, f"RECEIPT 1\n{link}", blocks.link_answers) == [{"MATCHED_TRANSACTION": "FOUND", "RECEIPT_STORE": "Shop"}]
    assert one(spark, "RECEIPT 1\nRECEIPT_STORE: [Next]\nRECEIPT 2\nRECEIPT_STORE: Shop\nCONFIDENCE", blocks.link_answers) == [{"RECEIPT_STORE": "Shop", "CONFIDENCE": ""}]
    assert one(spark, None, blocks.link_answers) == [] and one(spark, "", blocks.receipt_blocks) == []


def test_statement_maths_keeps_lists(spark):
    rows = [
        ("a", {"TRANSACTION_DATES": "03/02/2024 | 01/02/2024 | 01/02/2024", "ACCOUNT_BALANCE": "$5.00 | $10.00 | $8.00", "LINE_ITEM_DESCRIPTIONS": "x | salary | y", "TRANSACTION_AMOUNTS_PAID": "NOT_FOUND | 7 | NOT_FOUND", "OTHER": "o"}),
        ("b", {"TRANSACTION_DATES": "soon", "ACCOUNT_BALANCE": "$1", "TRANSACTION_AMOUNTS_PAID": "9"}), ("c", None), ("d", {}),
    ]
    got = {r.doc: r for r in statement_maths.enhance(spark.createDataFrame(rows, "doc string, fields map<string,string>")).collect()}
    assert got["a"].fields == {"TRANSACTION_DATES": rows[0][1]["TRANSACTION_DATES"], "ACCOUNT_BALANCE": rows[0][1]["ACCOUNT_BALANCE"], "LINE_ITEM_DESCRIPTIONS": "x | salary | y", "OTHER": "o", "TRANSACTION_AMOUNTS_PAID": "$3.00 | NOT_FOUND | $2.00", "TRANSACTION_AMOUNTS_RECEIVED": "NOT_FOUND | $7.00 | NOT_FOUND"}
    assert tuple(got["a"].analysis) == (True, 5.0, 7.0, 3)
    assert got["b"].fields == rows[1][1] and not got["b"].analysis.success and not got["c"].analysis.success and not got["d"].analysis.success


def test_document_methods(spark):
    df = spark.createDataFrame([("LINE_ITEM_DESCRIPTIONS", "banana | apple | cherry", "apple | banana | cherry"), ("LINE_ITEM_TOTAL_PRICES", "9.72 | 111.69", "$9.72 | $111.69"), ("TOTAL_AMOUNT", "NOT_FOUND", "NOT_FOUND"), ("TRANSACTION_DATES", "3 Feb 24", "03/02/2024"), ("SUPPLIER_NAME", None, "a | b")], "field string, value string, truth string")
    f1 = lambda m: {r.field: round(r.f1, 4) for r in documents.score_values(df, m).collect()}
    assert f1("order_aware") == {"LINE_ITEM_DESCRIPTIONS": 0.5, "LINE_ITEM_TOTAL_PRICES": 1.0, "TOTAL_AMOUNT": 1.0, "TRANSACTION_DATES": 1.0, "SUPPLIER_NAME": 0.0}
    assert f1("position_agnostic")["LINE_ITEM_DESCRIPTIONS"] == 1.0 and f1("kieval")["TOTAL_AMOUNT"] == 0.0
    with pytest.raises(ValueError, match="none of"):
        documents.score_values(df, "other")


def test_pairs_by_amount(spark):
    rnd = random.Random(3)
    total = lambda: rnd.choice([None, 1.0, 1.005, 2.0, 2.5, 7.0])
    cases = [([total() for _ in range(rnd.randint(0, 6))], [total() for _ in range(rnd.randint(0, 6))]) for _ in range(120)]
    s = "array<struct<total:double>>"
    df = spark.createDataFrame([(i, [(x,) for x in a], [(x,) for x in b]) for i, (a, b) in enumerate(cases)], f"i int, a {s}, b {s}")
    got = {r.i: [(p.l, p.g) for p in r.p] for r in df.select("i", linking.pair_by_amount(F.col("a"), F.col("b"), 0.01).alias("p")).collect()}
    for i, (a, b) in enumerate(cases):
        used, want = set(), []
        for g, y in enumerate(b):
            hit = next((k for k, x in enumerate(a) if k not in used and x is not None and y is not None and abs(x - y) <= 0.01), None)
            if hit is not None:
                used.add(hit)
                want.append((hit, g))
        left, right = [k for k in range(len(a)) if k not in used], [g for g in range(len(b)) if g not in {x[1] for x in want}]
        n = max(len(left), len(right))
        want += [(left[k] if k < len(left) else None, right[k] if k < len(right) else None) for k in range(n)]
        assert got[i] == want


def test_matching_blocks(spark):
    rnd = random.Random(5)
    pairs = [("", ""), ("a", ""), ("abcd", "bcde"), ("aaaa", "aa"), ("été 日本", "ete 日本")]
    pairs += [("".join(rnd.choice("ab c") for _ in range(rnd.randint(0, 40))), "".join(rnd.choice("ab c") for _ in range(rnd.randint(0, 40)))) for _ in range(300)]
    pairs += [("".join(rnd.choice("abcdefgh" * k + "xyz") for _ in range(300)), "".join(rnd.choice("abcdefgh" * k + "xyz") for _ in range(260))) for k in (1, 9)]
    for a, b in pairs:
        assert matching_characters(a, b) == sum(m.size for m in SequenceMatcher(None, a, b).get_matching_blocks()), (a, b)
    df = spark.createDataFrame([*pairs, (None, "a")], "a string, b string")
    got = [r.r for r in df.select(matching_ratio(F.col("a"), F.col("b")).alias("r")).collect()]
    assert got[-1] is None and got[:5] == [SequenceMatcher(None, a, b).ratio() for a, b in pairs[:5]]


def test_answers(spark):
    roles = {"date": ("date",), "debit": ("debit",), "balance": ("balance",)}
    read = lambda t: answers.classification(spark.createDataFrame([(t,)], "t string"), "t", roles).first()
    assert read("<think>COLUMNS: Debit</think>1. COLUMNS: Date | Debit | Balance\nROWS: 9").kind == "BANK_STATEMENT"
    half = read("### 1. COLUMNS\n```\nDate | Debit | Balance\n```\n### 4. TRAVEL\nAnswer YES or NO.\nYES")
    assert (half.kind, half.headers, half.travel) == ("BANK_STATEMENT", ["Date", "Debit", "Balance"], True)
    assert read("COLUMNS in prose, Debit and Balance").headers == [] and read("<think>COLUMNS: Debit").source is None and read(None).kind is None
    assert one(spark, "1. HEADER: What is it?\n - **Trust Return**\n2. HAS_ABN: Answer YES or NO.\n - **NO**\nHAS_TFN: yes it has", answers.trust_evidence) == {"HEADER": "Trust Return", "HAS_ABN": "NO", "HAS_TFN": "YES"}
    assert one(spark, None, answers.trust_evidence) == {}


def test_nodes_and_flags(spark):
    df = spark.createDataFrame([([("extract_a", "K: 1"), ("extract_a", "no field"), ("extract_b", None), ("x", "K: 2")],), (None,)], "n array<struct<key:string,raw_response:string>>")
    assert [r.s for r in df.select(nodes.node_state(F.col("n"), ("extract_a", "extract_b")).alias("s")).collect()] == [{"extract_a": {}, "extract_b": {}}, {}]
    fields = {"LINE_ITEM_PRICES": "2 | 3", "LINE_ITEM_QUANTITIES": "2 | 2", "LINE_ITEM_TOTAL_PRICES": "4 | 7", "GST_AMOUNT": "10", "SUBTOTAL_AMOUNT": "100", "TOTAL_AMOUNT": "110", "IS_GST_INCLUDED": "true"}
    docs = spark.createDataFrame([(fields,), ({},), (None,)], "f map<string,string>")
    got = docs.select(*[c.alias(k) for k, c in quality.business_flags(F.col("f")).items()]).collect()
    assert tuple(got[0]) == ([2], False, False, None) and tuple(got[1]) == (None, None, None, None)


def test_header_cache_lives_with_the_run(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    schema = "position long, image_path string, mapping string"

    def add(name, *rows):
        (source / name).write_text("\n".join(json.dumps(dict(zip(("position", "image_path", "mapping"), r))) for r in rows))

    def run(checkpoint):
        out = str(tmp_path / f"out-{checkpoint}")
        rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(source))
        cached_stream(rows, r"^(\w+)_").writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / checkpoint)).trigger(availableNow=True).start().awaitTermination()
        return {r.position: (r.institution, r.mapping, r.cached) for r in spark.read.parquet(out).collect()}

    add("1.json", (1, "d/anz_1.png", None), (2, "d/anz_2.png", "A"), (3, "d/anz_3.png", "B"), (4, "d/plain.png", "C"))
    first = run("one")
    assert first == {1: ("anz", None, False), 2: ("anz", "A", False), 3: ("anz", "A", True), 4: (None, "C", False)}
    add("2.json", (5, "d/anz_5.png", "D"), (6, "d/nab_1.png", "E"))
    assert run("one") == first | {5: ("anz", "A", True), 6: ("nab", "E", False)}  # the next batch of the same run
    (source / "1.json").unlink()
    assert run("two") == {5: ("anz", "D", False), 6: ("nab", "E", False)}  # a new run knows nothing
    table = spark.read.schema(schema).json(str(source))
    more = table.unionByName(spark.createDataFrame([(7, "x/anz_9.png", "F"), (8, "plain.png", "G"), (9, None, None)], schema))
    got = {r.position: (r.institution, r.mapping, r.cached) for r in cached_batch(more, r"^(\w+)_").collect()}
    assert got == {5: ("anz", "D", False), 6: ("nab", "E", False), 7: ("anz", "D", True), 8: (None, "G", False), 9: (None, None, False)}


def test_simple_match_and_strict_lists(spark):
    cases = [
        ('"Ace"', "ace", True), ("statement", "BANK_STATEMENT", True), ("$10.40", "10", True), ("10.60", "$10.40", False), ("12 345 678 901", "ABN 12345678901", True), ("12 345 678 901", "12345678901", True),
        ("a | NOT_FOUND", "b | not_found", True), ("a | b", "a", False), ("$1.20 | pear", "1.4|pears", False), ("$1.20 | oranges", "1.4|orange", True), ("abc", "abd", False), ("1.2.3", "1", False), ("hardware", "hardwar", True),
    ]
    df = spark.createDataFrame(cases, "v string, t string, want boolean").select("v", "t", "want", scoring.simple_match(F.col("v"), F.col("t")).alias("got"))
    assert [(r.v, r.t) for r in df.collect() if r.got != r.want] == []
    lists = spark.createDataFrame([("1 | NOT_FOUND", "a | b")], "paid string, names string")
    kept = parsers.debit_rows({"paid": F.col("paid"), "names": F.col("names")}, "paid", strict=True)
    assert tuple(lists.select(kept["paid"], kept["names"]).first()) == ("1", "a")
    short = spark.createDataFrame([("1 | NOT_FOUND", "a")], "paid string, names string")
    with pytest.raises(Exception, match="different lengths"):
        short.select(parsers.debit_rows({"paid": F.col("paid"), "names": F.col("names")}, "paid", strict=True)["names"]).collect()
