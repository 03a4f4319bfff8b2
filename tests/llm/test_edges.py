"""Empty tables and columns with clashing names for the operators not covered elsewhere."""

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import byte_bpe, katz, lang_id, licenses, pii, simhash, substring_dedup

SCHEMA = "doc_id long, text string, lang string, score double, hash long, rid long, bucket int, place int, fp long, words int, n_words long"


@pytest.mark.parametrize("run", [pii.detect, byte_bpe.digest, licenses.scan, simhash.near_duplicates, substring_dedup.remove_repeats, katz.score, lang_id.identify])
def test_empty_and_clashing(spark, run):
    empty = spark.createDataFrame([], SCHEMA)
    assert run(empty).count() == 0
    some = spark.createDataFrame([(1, "one two three", "en", 0.5, 1, 1, 1, 1, 1, 1, 1), (2, None, None, None, None, None, None, None, None, None, None)], SCHEMA)
    out = run(some)
    assert out.count() == 2 and len(set(out.columns)) == len(out.columns)
    assert out.filter(F.col("doc_id") == 2).count() == 1


def test_redact_keeps_other_columns(spark):
    some = spark.createDataFrame([(1, "a@b.cd", "en", 0.5, 1, 1, 1, 1, 1, 1, 1)], SCHEMA)
    assert pii.redact(some).columns == some.columns and pii.redact(some).first().text == "<EMAIL>"
    assert pii.redact(some.limit(0)).count() == 0
