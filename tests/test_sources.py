"""Readers, writers and incremental runs on small files."""

import json

from pyspark.sql import functions as F

from ledgerloom.functions import money
from ledgerloom.sources import records
from ledgerloom.streaming import incremental


def test_resume_ignores_a_torn_line(spark, tmp_path):
    path = tmp_path / "out.jsonl"
    path.write_text('{"image_name": "a"}\n\n{"image_name": "b"}\n{"image_na')
    done = records.completed(spark, str(path))
    assert sorted(r.image_name for r in done.collect()) == ["a", "b"]
    todo = spark.createDataFrame([("a",), ("c",)], "image_name string")
    assert [r.image_name for r in records.remaining(todo, done).collect()] == ["c"]
    assert records.completed(spark, str(tmp_path / "none.jsonl")).count() == 0


def test_truth_csv(spark, tmp_path):
    path = tmp_path / "gt.csv"
    path.write_text("filename,TOTAL\na.png,1\n,2\na.png,3\nb.png,\n")
    got = {r.image: r.TOTAL for r in records.read_truth(spark, str(path)).collect()}
    assert got == {"a.png": "3", "b.png": None}


def test_linking_truth(spark, tmp_path):
    path = tmp_path / "links.jsonl"
    path.write_text(json.dumps({"image_file": "x", "EXPECTED_MATCH_STATUS": "FOUND | NOT_FOUND", "RECEIPT_TOTAL": "1 | 2 | 3"}) + "\n" + json.dumps({"image_file": "y"}) + "\n")
    got = sorted((r.image, r.receipt_index, r.expected_match_status, r.receipt_total) for r in records.read_linking_truth(spark, str(path)).collect())
    assert got == [("x", 0, "FOUND", "1"), ("x", 1, "NOT_FOUND", "2"), ("x", 2, "FOUND", "3"), ("y", 0, "FOUND", None)]


def test_upsert_and_round_trip(spark, tmp_path):
    old = spark.createDataFrame([("a", 1), ("b", 2)], "stage string, n int")
    new = records.upsert(old, spark.createDataFrame([("b", 3)], "stage string, n int"), "stage")
    assert sorted(map(tuple, new.collect())) == [("a", 1), ("b", 3)]
    records.write_jsonl(new, str(tmp_path / "t"))
    again = records.read_jsonl(spark, str(tmp_path / "t"), "stage string, n int")
    assert records.verify_round_trip(new, again).count() == 0


def test_incremental_run_takes_each_file_once(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    step = lambda df: incremental.with_errors(df, money.parse_signed(F.col("amount")), "value", "unreadable amount")
    run = lambda: incremental.process_new(spark, str(src), "image_name string, amount string", str(tmp_path / "out"), str(tmp_path / "cp"), step).awaitTermination()
    (src / "1.json").write_text('{"image_name": "a", "amount": "$1.50"}\n')
    run()
    (src / "2.json").write_text('{"image_name": "b", "amount": "?"}\n')
    run()
    run()
    got = sorted((r.image_name, r.value, r.error) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == [("a", 1.5, None), ("b", None, "unreadable amount")]


def test_latest_by_key(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    run = lambda: incremental.latest_by_key(spark, str(src), "k string, n int", "k", "n", str(tmp_path / "t"), str(tmp_path / "cp")).awaitTermination()
    (src / "1.json").write_text('{"k": "a", "n": 1}\n{"k": "b", "n": 5}\n')
    run()
    (src / "2.json").write_text('{"k": "a", "n": 2}\n')
    run()
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "t" / "v1")).collect())) == [("a", 2), ("b", 5)]


def test_yaml_truth(spark, tmp_path):
    links = tmp_path / "links.yml"
    links.write_text("CASE001_receipt.png:\n  - {supplier: A, receipt_total: 83.48, match_status: found, bank_amount: ''}\n  - {receipt_total: null}\n")
    got = [(r.image, r.receipt_index, r.expected_match, r.receipt_total, r.bank_amount) for r in records.read_linking_yaml(spark, str(links)).orderBy("receipt_index").collect()]
    assert got == [("CASE001_receipt.png", 0, "FOUND", 83.48, None), ("CASE001_receipt.png", 1, "FOUND", None, None)]
    trust = tmp_path / "trust.yml"
    trust.write_text("CASE7_dist.png:\n  linking_fields: {trust_abn: 51824753556}\n  compliance_status: compliant\nother:\n  linking_fields: {}\n  compliance_status: x\n")
    assert [(r.case_id, r.linking_fields) for r in records.read_trust_yaml(spark, str(trust)).collect()] == [("CASE7", {"trust_abn": "51824753556"})]
    types = tmp_path / "types.yml"
    types.write_text("a.png: receipt\nb.png: invoice\na.png: bank\n")
    assert [k for k, _ in records.yaml_blocks(spark, str(types))] == ["a.png", "b.png", "a.png"]
    assert records.read_type_yaml(spark, str(types)).count() == 3


def test_tables_and_runs(spark, tmp_path):
    import pytest

    path = tmp_path / "t.csv"
    path.write_text("case_id, F1 Score ,processing_time\na,0.5,x\nb,bad,2\n")
    assert records.read_table(spark, str(path), ("case_id",)).count() == 2
    with pytest.raises(ValueError, match="missing columns quad"):
        records.read_table(spark, str(path), ("case_id", "quad"))
    run = records.read_model_run(spark, str(path), "m").orderBy("case_id").collect()
    assert [(r.overall_accuracy, r.processing_time, r.document_type, r.model) for r in run] == [(0.0, None, "unknown", "m"), (0.0, 2.0, "unknown", "m")]
    scores = records.read_field_scores(spark, str(path), {"field": ("CASE_ID",), "f1": ("f1 score",), "recall": ()}).orderBy("field").collect()
    assert [tuple(r) for r in scores] == [("a", 0.5, None), ("b", None, None)]


def test_summaries_timings_and_reports(spark, tmp_path):
    path = tmp_path / "r.jsonl"
    path.write_text('{"case_id": "a"}\n{"_summary": {"n": "1"}}\n')
    rows, summary = records.split_summary(spark, str(path), "case_id string")
    assert [r.case_id for r in rows.collect()] == ["a"] and summary.first()._summary == {"n": "1"}
    assert records.count_jsonl(spark, str(path)) == 2
    (tmp_path / "t.jsonl").write_text('{"stage": "x", "images": 3}\n{"stage": \n')
    assert [(r.stage, r.images) for r in records.read_timings(spark, str(tmp_path / "t.jsonl")).collect()] == [("x", 3)]
    quads = spark.createDataFrame([("a", True), ("b", False)], "case_id string, complete boolean")
    records.write_quads(quads, str(tmp_path / "q"))
    assert [r.case_id for r in records.read_table(spark, str(tmp_path / "q/incomplete"), ("case_id",)).collect()] == ["b"]
    records.write_report({"cases": quads, "none": quads.limit(0)}, str(tmp_path / "report"))
    assert json.loads(spark.read.text(str(tmp_path / "report")).first().value) == {"cases": [{"case_id": "a", "complete": True}, {"case_id": "b", "complete": False}], "none": []}


def test_record_frames(spark):
    df = spark.createDataFrame([("i", {"A": "1", "B": "NOT_FOUND"}, 0.5)], "image_name string, extracted_data map<string,string>, processing_time double")
    main, meta = records.record_and_metadata(df, ("A", "C"))
    assert main.first().asDict() == {"image_name": "i", "A": "1", "C": "NOT_FOUND"} and meta.first().found_fields == 1
    assert records.widened(df, "extracted_data", ("A",)).columns == ["image_name", "processing_time", "extracted_data.A"]


def test_traces_and_runs(spark, tmp_path):
    traces = spark.createDataFrame([("i", "p", "ü", None)], "image_name string, prompt string, raw_response string, prompt_tokens int")
    for _ in range(2):
        records.append_traces(traces, str(tmp_path / "traces"))
    lines = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "traces")).collect()]
    assert len(lines) == 2 and lines[0] == {"image_name": "i", "pipeline": None, "label": None, "model": None, "prompt": "p", "raw_response": "ü", "prompt_tokens": None, "completion_tokens": None}
    records.write_runs(spark.createDataFrame([("a", 1.5)], "model string, f1 double"), str(tmp_path / "runs"))
    assert records.read_table(spark, str(tmp_path / "runs"), ("model", "f1")).count() == 1
