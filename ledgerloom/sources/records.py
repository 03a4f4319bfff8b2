"""Readers of record files and ground truth, and the writers that go with them.

Schemas are explicit: a record's field bag is a map of strings, and absence is ``NOT_FOUND``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

ID_COLUMNS = ("image_file", "filename", "image_name", "file")
EXTRACTION = "image_name string, image_path string, document_type string, raw_response string, processing_time double, error string"
CLEANED = "image_name string, image_path string, document_type string, extracted_data map<string,string>, field_count int, extracted_fields_count int, processing_time double, error string"


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One record a line; blank lines are skipped, a bad line fails the read."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def completed(spark: SparkSession, path: str, key: str = "image_name") -> DataFrame:
    """Distinct keys of an output that may end in a torn line; no file, no keys."""
    from pyspark.errors import AnalysisException

    try:
        rows = spark.read.schema(f"{key} string, _corrupt string").option("columnNameOfCorruptRecord", "_corrupt").json(path)
    except AnalysisException:
        return spark.createDataFrame([], f"{key} string")
    return rows.filter(F.col("_corrupt").isNull() & F.col(key).isNotNull()).select(key).distinct()


def remaining(todo: DataFrame, done: DataFrame, key: str = "image_name") -> DataFrame:
    """What an earlier run has not done."""
    return todo.join(done.select(key), key, "left_anti")


def read_truth_csv(spark: SparkSession, path: str) -> DataFrame:
    """Ground truth as strings with an ``image`` column from whichever id column there is; rows without an id go, of
    repeated ids the last stays."""
    raw = spark.read.option("header", True).option("inferSchema", False).csv(path)
    have = [c for c in ID_COLUMNS if c in raw.columns]
    if not have:
        raise ValueError(f"{path}: one of the columns {', '.join(ID_COLUMNS)} is needed")
    rows = raw.withColumn("image", F.coalesce(*[F.nullif(F.trim(c), F.lit("")) for c in have])).filter(F.col("image").isNotNull())
    # files are one after another by name, and an id grows along each file
    last = Window.partitionBy("image").orderBy(F.desc("_file"), F.desc("_at"))
    numbered = rows.withColumns({"_file": F.input_file_name(), "_at": F.monotonically_increasing_id()})
    return numbered.withColumn("_r", F.row_number().over(last)).filter("_r = 1").drop("_file", "_at", "_r")


def read_truth_jsonl(spark: SparkSession, path: str, fields: tuple[str, ...]) -> DataFrame:
    """Ground truth of one type: ``filename`` or ``image_name`` and exactly the fields named."""
    schema = ", ".join(f"`{c}` string" for c in ("filename", "image_name", *fields))
    return read_jsonl(spark, path, schema).withColumn("image", F.coalesce("filename", "image_name")).select("image", *fields)


def read_truth(spark: SparkSession, path: str, fields: tuple[str, ...] = ()) -> DataFrame:
    """By the file's suffix."""
    return read_truth_jsonl(spark, path, fields) if path.endswith(".jsonl") else read_truth_csv(spark, path)


def read_linking_truth(spark: SparkSession, path: str) -> DataFrame:
    """Expected links, one row a receipt: pipe lists are exploded, a list that is too short gives its default."""
    columns = {"EXPECTED_MATCH_STATUS": "FOUND", "RECEIPT_TOTAL": None, "BANK_TRANSACTION_DATE": None, "BANK_TRANSACTION_DESCRIPTION": None, "BANK_TRANSACTION_DEBIT": None}
    rows = read_truth_csv(spark, path) if not path.endswith(".jsonl") else read_jsonl(spark, path, "image_file string, " + ", ".join(f"{c} string" for c in columns)).withColumn("image", F.col("image_file"))
    for c in columns:
        if c not in rows.columns:
            rows = rows.withColumn(c, F.lit(None).cast("string"))
    split = {c: F.transform(F.split(F.coalesce(c, F.lit("")), r"\|"), lambda x: F.nullif(F.trim(x), F.lit(""))) for c in columns}
    lists = rows.select("image", *[a.alias(c) for c, a in split.items()])
    n = F.greatest(F.size("EXPECTED_MATCH_STATUS"), F.size("RECEIPT_TOTAL"), F.lit(1))
    each = lists.withColumn("receipt_index", F.explode(F.sequence(F.lit(0), n - 1)))
    return each.select("image", "receipt_index", *[F.coalesce(F.get(c, "receipt_index"), F.lit(d)).alias(c.lower()) for c, d in columns.items()])


def write_jsonl(df: DataFrame, path: str, append: bool = False) -> None:
    df.write.mode("append" if append else "overwrite").json(path)


def write_csv(df: DataFrame, path: str) -> None:
    """A small report with a header."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def upsert(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Old rows whose key is not renewed, and the new ones."""
    return old.join(new.select(key), key, "left_anti").unionByName(new, allowMissingColumns=True)


def verify_round_trip(written: DataFrame, reread: DataFrame) -> DataFrame:
    """Rows that only one side has; empty if the write was faithful."""
    return written.exceptAll(reread).withColumn("side", F.lit("written")).unionByName(reread.exceptAll(written).withColumn("side", F.lit("reread")))


def count_jsonl(spark: SparkSession, path: str) -> int:
    """How many records a file has."""
    return spark.read.text(path).filter(F.trim("value") != "").count()


def _yaml(spark: SparkSession, path: str):
    """A small configuration file, read through Spark so that any store will do; duplicate keys are kept by ``yaml_blocks``."""
    import yaml

    return yaml.compose("\n".join(r.value for r in spark.read.text(path, wholetext=True).collect()), Loader=yaml.SafeLoader)


def yaml_blocks(spark: SparkSession, path: str) -> list[tuple[str, object]]:
    """The top-level entries of a YAML mapping in order; a key may occur more than once."""
    import yaml

    root = _yaml(spark, path)
    if not isinstance(root, yaml.MappingNode):
        raise ValueError(f"{path}: a YAML mapping with at least one entry is needed")
    loader = yaml.SafeLoader("")
    return [(str(loader.construct_object(key, deep=True)), loader.construct_object(value, deep=True)) for key, value in root.value]


def read_linking_yaml(spark: SparkSession, path: str) -> DataFrame:
    """Expected links of a YAML file: a list of receipts for each image."""
    number = lambda v: None if v in (None, "") else float(v)
    rows = [
        (image, i, str(e.get("match_status", "FOUND")).upper(), number(e.get("receipt_total")), str(e.get("bank_date", "")), str(e.get("bank_description", "")), number(e.get("bank_amount")), str(e.get("mismatch_type", "NONE")).upper())
        for image, entries in yaml_blocks(spark, path) for i, e in enumerate(entries)
    ]
    return spark.createDataFrame(rows, "image string, receipt_index int, expected_match string, receipt_total double, bank_date string, bank_description string, bank_amount double, mismatch_type string")


def read_trust_yaml(spark: SparkSession, path: str) -> DataFrame:
    """Expected trust values of a YAML file by case; files whose name begins with no case are left out."""
    rows = [(name, {k: str(v) for k, v in e["linking_fields"].items()}, e["compliance_status"], e.get("discrepancy_type")) for name, e in yaml_blocks(spark, path)]
    out = spark.createDataFrame(rows, "file string, linking_fields map<string,string>, compliance_status string, discrepancy_type string")
    return out.withColumn("case_id", F.regexp_extract("file", r"^(CASE\d+)", 1)).filter("case_id <> ''").orderBy("file")


def read_type_yaml(spark: SparkSession, path: str) -> DataFrame:
    """Expected document types by file name."""
    return spark.createDataFrame([(k, str(v)) for k, v in yaml_blocks(spark, path)], "file string, document_type string")


def read_table(spark: SparkSession, path: str, required: tuple[str, ...]) -> DataFrame:
    """A CSV of strings that must have these columns (quads of a case, pairs of files)."""
    out = spark.read.option("header", True).option("inferSchema", False).csv(path)
    if missing := [c for c in required if c not in out.columns]:
        raise ValueError(f"{path}: missing columns {', '.join(missing)}; it has {', '.join(out.columns)}")
    return out


def read_model_run(spark: SparkSession, path: str, model: str) -> DataFrame:
    """A model's results; absent columns get their defaults (accuracy 0, one second, type unknown)."""
    out = spark.read.option("header", True).option("inferSchema", False).csv(path)
    for name, default, kind in (("overall_accuracy", "0", "double"), ("processing_time", "1", "double"), ("document_type", "unknown", "string")):
        out = out.withColumn(name, (F.col(name) if name in out.columns else F.lit(default)).try_cast(kind))
    return out.withColumn("model", F.lit(model))


def read_field_scores(spark: SparkSession, path: str, aliases: dict[str, tuple[str, ...]]) -> DataFrame:
    """The columns that ``aliases`` name, found by any of their names in any case; unreadable numbers are null."""
    raw = spark.read.option("header", True).option("inferSchema", False).csv(path)
    have = {c.strip().lower(): c for c in raw.columns}
    found = {name: next((have[a.lower()] for a in (name, *others) if a.lower() in have), None) for name, others in aliases.items()}
    first = next(iter(aliases))
    if found[first] is None:
        raise ValueError(f"{path}: no column for {first}")
    columns = [(F.col(f"`{c}`") if c else F.lit(None).cast("string")) for c in found.values()]
    return raw.select(*[(c if name == first else c.try_cast("double")).alias(name) for name, c in zip(found, columns, strict=True)])


def split_summary(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """(records, summaries) of a file whose last record may be ``{"_summary": ...}``."""
    every = spark.read.schema(f"{schema}, _summary map<string,string>").json(path)
    return every.filter("_summary is null").drop("_summary"), every.filter("_summary is not null").select("_summary")


def read_timings(spark: SparkSession, path: str) -> DataFrame:
    """Stage timings; rows that cannot be read are skipped."""
    rows = spark.read.schema("stage string, wall_clock double, inference_seconds double, execution_mode string, images int, _corrupt string").option("columnNameOfCorruptRecord", "_corrupt").json(path)
    return rows.filter("_corrupt is null and stage is not null").drop("_corrupt")


def write_quads(quads: DataFrame, folder: str, complete: str = "complete") -> None:
    """Complete and incomplete cases as CSV in two folders."""
    for name, part in (("complete", F.col(complete)), ("incomplete", ~F.col(complete))):
        quads.filter(part).drop(complete).write.mode("overwrite").option("header", True).csv(f"{folder}/{name}")


def write_report(parts: dict[str, DataFrame], path: str) -> None:
    """Aggregates (few rows each) as one JSON object with a list for each name."""
    spark = next(iter(parts.values())).sparkSession
    out = spark.range(1).select()
    for name, df in parts.items():
        out = out.crossJoin(df.agg(F.collect_list(F.struct(*df.columns)).alias(name)))  # one row each
    out.select(F.to_json(F.struct(*parts)).alias("value")).write.mode("overwrite").text(path)


def record_and_metadata(df: DataFrame, fields: tuple[str, ...], bag: str = "extracted_data") -> tuple[DataFrame, DataFrame]:
    """(one column a field, what is known about the response) of records with a field bag."""
    main = df.select("image_name", *[F.coalesce(F.try_element_at(bag, F.lit(f)), F.lit("NOT_FOUND")).alias(f) for f in fields])
    return main, df.select(*[c for c in df.columns if c != bag], F.size(F.map_filter(bag, lambda k, v: v != "NOT_FOUND")).alias("found_fields"))


def widened(df: DataFrame, column: str, names: tuple[str, ...]) -> DataFrame:
    """A map column as one column for each name."""
    return df.select(*[c for c in df.columns if c != column], *[F.try_element_at(column, F.lit(n)).alias(f"{column}.{n}") for n in names])


TRACE = ("image_name", "pipeline", "label", "model", "prompt", "raw_response", "prompt_tokens", "completion_tokens")


def append_traces(df: DataFrame, path: str) -> None:
    """Prompt traces appended as JSON lines; columns that ``df`` lacks are null and null ones are written too."""
    whole = df.select(*[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in TRACE])
    whole.write.mode("append").option("ignoreNullFields", "false").json(path)


def write_runs(df: DataFrame, path: str) -> None:
    """Model runs as CSV with a header, one file a partition."""
    df.write.mode("overwrite").option("header", True).csv(path)
