"""Column mappings by institution within one run: the first document of an institution is read, later ones use its mapping.

As a stream the state is keyed by institution and lives with the run's checkpoint: micro-batches of a run share it, a
run with a new checkpoint starts empty.  As a batch it is one aggregation and a join.  Documents whose path names no institution, or
whose own mapping is missing while nothing is known yet, keep what they have.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

_OUT = "position long, image_path string, institution string, mapping string, cached boolean"


def institution_key(path: Column, pattern: str) -> Column:
    """What the pattern's first group finds in the file name; null without."""
    return F.nullif(F.regexp_extract(F.substring_index(path, "/", -1), pattern, 1), F.lit(""))


def _reuse(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    known = state.get[0] if state.exists else None
    for part in [pd.concat(list(parts)).sort_values(["position", "image_path"])]:
        mappings, cached = [], []
        for own in part["mapping"]:
            cached.append(known is not None)
            mappings.append(known if known is not None else own)
            known = known if known is not None else own
        if known is not None:
            state.update((known,))
        yield pd.DataFrame({"position": part["position"].to_numpy(), "image_path": part["image_path"].to_numpy(), "institution": key[0], "mapping": mappings, "cached": cached})


def cached_stream(docs: DataFrame, pattern: str) -> DataFrame:
    """(position, image_path, institution, mapping, cached) of a stream of (position, image_path, mapping: text or null)."""
    keyed = docs.select("position", "image_path", institution_key(F.col("image_path"), pattern).alias("institution"), "mapping")
    apart = keyed.filter("institution IS NULL").withColumn("cached", F.lit(False))
    shared = keyed.filter("institution IS NOT NULL").groupBy("institution").applyInPandasWithState(_reuse, _OUT, "mapping string", "append", GroupStateTimeout.NoTimeout)
    return shared.unionByName(apart)


def cached_batch(docs: DataFrame, pattern: str) -> DataFrame:
    """The same over a table, in the order of ``position`` (ties by path)."""
    keyed = docs.select("position", "image_path", institution_key(F.col("image_path"), pattern).alias("institution"), "mapping")
    first = F.min(F.when(F.col("mapping").isNotNull(), F.struct("position", "image_path", "mapping"))).alias("first")
    known = keyed.filter("institution IS NOT NULL").groupBy("institution").agg(first)
    cached = F.col("first").isNotNull() & (F.struct("position", "image_path") > F.struct("first.position", "first.image_path"))
    return keyed.join(known, "institution", "left").select("position", "image_path", "institution", F.when(cached, F.col("first.mapping")).otherwise(F.col("mapping")).alias("mapping"), cached.alias("cached"))
