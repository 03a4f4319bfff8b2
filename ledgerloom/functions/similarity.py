"""The matching-blocks ratio of two texts: twice the length of all matching blocks over both lengths.

The longest common block is found (of equally long ones the first in the one text, then in the other), then the same left and
right of it.  In texts of 200 characters or more, characters that make up over a hundredth of the second one do not begin a block.
Work is the product of both lengths in the worst case, so this is for fields, not for documents; there is no cap.  Spark has no
expression for it: the kernel runs in Arrow batches, once for each different pair of a batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from difflib import SequenceMatcher

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_OFTEN, _SHORT = 200, 100


def matching_characters(a: str, b: str) -> int:
    """The length of all matching blocks."""
    x, y = (np.frombuffer(t.encode("utf-32-le"), dtype=np.uint32) for t in (a, b))
    begins = np.ones(len(y), dtype=bool)
    if len(y) >= _OFTEN:
        _, kind, count = np.unique(y, return_inverse=True, return_counts=True)
        begins = count[kind] <= len(y) // 100 + 1
    total, open_ = 0, [(0, len(x), 0, len(y))]
    while open_:
        i0, i1, j0, j1 = open_.pop()
        best, end_i, end_j = 0, i0, j0
        row = np.zeros(j1 - j0 + 1, dtype=np.int64)  # length of the block that ends before each place
        for i in range(i0, i1):
            hit = (y[j0:j1] == x[i]) & begins[j0:j1]
            row[1:] = np.where(hit, row[:-1] + 1, 0)
            k = int(row.argmax())
            if row[k] > best:
                best, end_i, end_j = int(row[k]), i + 1, j0 + k
        i, j = end_i - best, end_j - best
        while i > i0 and j > j0 and x[i - 1] == y[j - 1]:
            i, j, best = i - 1, j - 1, best + 1
        while i + best < i1 and j + best < j1 and x[i + best] == y[j + best]:
            best += 1
        if best:
            total += best
            open_ += [(i0, i, j0, j), (i + best, i1, j + best, j1)]
    return total


def _ratio(a: str, b: str) -> float:
    n = len(a) + len(b)
    if a == b and len(b) < _OFTEN:
        return 1.0
    # rows of numbers pay off for long texts only
    matching = matching_characters(a, b) if len(a) > _SHORT or len(b) > _SHORT else sum(m.size for m in SequenceMatcher(None, a, b).get_matching_blocks())
    return 2.0 * matching / n if n else 1.0


@F.pandas_udf(T.DoubleType())
def _ratios(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for a, b in parts:
        known: dict[tuple, float | None] = {}
        for pair in set(zip(a, b, strict=True)):
            known[pair] = None if pair[0] is None or pair[1] is None else _ratio(*pair)
        yield pd.Series([known[p] for p in zip(a, b, strict=True)], dtype="float64")


def matching_ratio(a: Column, b: Column) -> Column:
    """From 0 to 1; 1 for two empty texts, null for null."""
    return _ratios(a, b)


def nearly_equal(a: Column, b: Column, least: float = 0.85) -> Column:
    """Equal but for case and white space, or with a matching-blocks ratio of ``least``."""
    plain = lambda c: F.regexp_replace(F.lower(F.trim(c)), r"\s+", " ")
    return (plain(a) == plain(b)) | (matching_ratio(plain(a), plain(b)) >= least)
