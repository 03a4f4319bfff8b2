"""A response from text to checked record: parsed, cleaned field by field, with business flags."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.arrays import bound
from ledgerloom.functions.cleaning import clean_value
from ledgerloom.operators.parsers import field_lines
from ledgerloom.operators.quality import business_flags


def handle(responses: DataFrame, raw: str, fields: tuple[str, ...], artifacts: bool = True) -> DataFrame:
    """Adds ``fields`` (every expected field, cleaned by its kind) and the flags of ``quality.business_flags``."""
    parsed = field_lines(responses, raw, fields, artifacts=artifacts)
    own = lambda f: bound(F.element_at("fields", f), lambda v: clean_value(F.lit(f), v))
    cleaned = F.map_from_arrays(F.array(*map(F.lit, fields)), F.array(*map(own, fields)))
    out = parsed.withColumn("fields", cleaned)
    return out.withColumns(business_flags(F.col("fields")))
