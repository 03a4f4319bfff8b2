"""Arrays and maps whose values are worked out once, however often they are used."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bound(value: Column, body) -> Column:
    """``body(value)`` with the value worked out once, however often the body mentions it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def each(df: DataFrame, column: str, *names: str) -> DataFrame:
    """A row for each item of an array (place, item) or of a map (key, value) in place of the column; none for empty and null ones.

    A plain explode lets Spark filter empty ones beneath it, by a filter that holds the whole expression of the column and all that it is
    made of, so that everything is worked out a second time.  The outer form has no such filter; the rows that it adds go here."""
    spread = F.explode_outer(column) if dict(df.dtypes)[column].startswith("map") else F.posexplode_outer(column)
    return df.select(*[c for c in df.columns if c != column], spread.alias(*names)).filter(F.col(names[0]).isNotNull())
