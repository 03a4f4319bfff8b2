"""Hard negatives of anchor rows: candidates of another label whose score lies in a window under a positive's.

Vectors become integers (``floor(256 * x)``), so a block of anchors against a block of candidates is one matrix
product in float64, exact while |a| |c| stays below 2^53 (no partial sum can pass it); rows beyond that bound are
multiplied as Python integers.  Anchors go in blocks of ``BLOCK``, ``GROUP`` blocks in one Spark job; a block is all
that a task receives, and the table streams past it.  Two passes: the first keeps each anchor's best rows of its own
label, the second, for each (anchor, positive), the best rows of other labels inside the positive's window.  Both keep
running lists a task, at most ``CHUNKS`` tasks a block, and lists are merged by rank, so what is shuffled depends on
the anchors and not on the candidates.  A group's results are checkpointed before the next group starts.

Defined cases: rows with a null id, label or vector, or with any null or non-finite component, take no part; shorter
vectors count as padded with zeros; a repeated id counts once, with its smallest (label, vector); ties go to the
smaller id; fewer rows than asked for give all of them; a score outside 64 bits counts as the nearest 64-bit
number; an empty table, or one without anchors, gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.kernels import shared_dir

SCALE = 256
BLOCK = 4096
GROUP = 8
CHUNKS = 64
SLICE = 1024
_EXACT = 2.0**53
_LONG = (-(2**63), 2**63 - 1)
_ROWS = "anchor_id long, positive_id long, positive_score long, other_id long, other_score long"


def usable(rows: DataFrame) -> DataFrame:
    """(vec_id, label, x): one row an id, labels as long, components as double."""
    x = F.col("embedding").cast("array<double>")
    kept = rows.select("vec_id", F.col("label").cast("long").alias("label"), x.alias("x")).filter(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.forall("x", lambda v: v.isNotNull() & (F.abs(v) < F.lit(float("inf"))))
    )
    best = F.min(F.struct("label", "x"))
    return kept.groupBy("vec_id").agg(best.alias("b")).select(F.col("vec_id").cast("long").alias("vec_id"), "b.label", F.col("b.x").alias("x"))


def _matrix(lists: pa.Array, dim: int) -> np.ndarray:
    """Rows of ``floor(SCALE * x)``, cut or padded to ``dim``."""
    flat, offs = lists.flatten().to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
    offs = offs - offs[0]
    n, sizes = len(lists), np.diff(offs)
    if (sizes == dim).all():
        return np.floor(SCALE * flat.reshape(n, dim))
    out = np.zeros((n, dim))
    row = np.repeat(np.arange(n), sizes)
    col = np.arange(len(flat)) - offs[row]
    own = col < dim
    out[row[own], col[own]] = np.floor(SCALE * flat[own])
    return out


def exact_scores(a: np.ndarray, c: np.ndarray) -> np.ndarray:
    """All inner products; float64 where that is exact, else 64-bit integers."""
    na, nc = np.linalg.norm(a, axis=1), np.linalg.norm(c, axis=1)
    if not len(a) or not len(c) or na.max() * nc.max() < _EXACT / 2:
        return a @ c.T
    wide_a, wide_c = na >= 2.0**26, nc >= 2.0**26
    out = np.empty((len(a), len(c)), dtype=np.int64)
    out[np.ix_(~wide_a, ~wide_c)] = (a[~wide_a] @ c[~wide_c].T).astype(np.int64)
    whole = np.frompyfunc(int, 1, 1)
    for i, j in ((wide_a, np.ones(len(c), bool)), (~wide_a, wide_c)):
        if i.any() and j.any():
            out[np.ix_(i, j)] = np.clip(whole(a[i]).dot(whole(c[j]).T), *_LONG).astype(np.int64)
    return out


class Best:
    """Running lists: for each of ``n`` lists the ``k`` best (score, id), ties to the smaller id."""

    def __init__(self, n: int, k: int):
        self.k, self.who = k, np.zeros(0, np.int64)
        self.score, self.id = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.bar = np.full(n, _LONG[0], dtype=np.int64)

    def add(self, who: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(who):
            return
        who, score, ids = (np.concatenate(x) for x in ((self.who, who), (self.score, score.astype(np.int64)), (self.id, ids)))
        order = np.lexsort((ids, ~score, who))  # ~score reverses the order without overflow
        who, score, ids = who[order], score[order], ids[order]
        place = np.arange(len(who)) - np.searchsorted(who, who)
        keep = place < self.k
        full = place == self.k - 1
        self.bar[who[full]] = score[full]
        self.who, self.score, self.id = who[keep], score[keep], ids[keep]


def _slices(batches: Iterable[pa.RecordBatch], dim: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, labels, matrix) of growing slices, so that the bars of the lists rise before the large ones come."""
    size = 64
    for batch in batches:
        start = 0
        while start < batch.num_rows:
            part = batch.slice(start, size)
            start += size
            size = min(2 * size, SLICE)
            yield part.column("vec_id").to_numpy(), part.column("label").to_numpy(), _matrix(part.column("x"), dim)


def _batch(anchor: np.ndarray, pid: np.ndarray, pscore: np.ndarray, best: Best) -> pa.RecordBatch:
    w = best.who
    return pa.RecordBatch.from_arrays([pa.array(v) for v in (anchor[w], pid[w], pscore[w], best.id, best.score)], names=[c.split()[0] for c in _ROWS.split(", ")])


def _positives(batches: Iterable[pa.RecordBatch], ids: np.ndarray, labels: np.ndarray, a: np.ndarray, k: int) -> Iterator[pa.RecordBatch]:
    """Each anchor's best rows of its label; the positive columns stay zero."""
    best, of = Best(len(ids), k), {v: np.flatnonzero(labels == v) for v in np.unique(labels).tolist()}
    for cid, clabel, c in _slices(batches, a.shape[1]):
        for v in np.unique(clabel).tolist():
            mine, own = of.get(v), np.flatnonzero(clabel == v)
            if mine is None:
                continue
            s = exact_scores(a[mine], c[own])
            i, j = np.nonzero((s >= best.bar[mine][:, None]) & (ids[mine][:, None] != cid[own][None, :]))
            best.add(mine[i], s[i, j], cid[own[j]])
    zero = np.zeros(len(ids), np.int64)
    yield _batch(ids, zero, zero, best)


def _negatives(batches: Iterable[pa.RecordBatch], ids: np.ndarray, labels: np.ndarray, a: np.ndarray, pos: np.ndarray, k: int) -> Iterator[pa.RecordBatch]:
    """``pos`` has (anchor index, positive id, its score, least and greatest score of a negative), sorted by anchor."""
    best, who = Best(len(pos), k), pos[:, 0]
    slot = np.arange(len(who)) - np.searchsorted(who, who)
    rounds = [np.flatnonzero(slot == r) for r in range(slot.max() + 1)] if len(who) else []
    for cid, clabel, c in _slices(batches, a.shape[1]):
        s, other = exact_scores(a, c), labels[:, None] != clabel[None, :]
        for own in rounds:  # one window of each anchor at a time
            x = who[own]
            least = np.maximum(pos[own, 3], best.bar[own])
            part, kind = (s, other) if len(x) == len(a) else (s[x], other[x])
            i, j = np.nonzero((part >= least[:, None]) & (part <= pos[own, 4][:, None]) & kind)
            best.add(own[i], part[i, j], cid[j])
    yield _batch(ids[who], pos[:, 1], pos[:, 2], best)


def _first(rows: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The merged lists: the best ``k`` of each key with their ``rank``."""
    w = Window.partitionBy(*keys).orderBy(F.desc("other_score"), "other_id")
    return rows.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def _window(score: int, low: int, high: int) -> tuple[int, int]:
    """The least and greatest whole score n with low * score <= 100 * n <= high * score."""
    return max(-((-low * score) // 100), _LONG[0]), min(high * score // 100, _LONG[1])


def mine(rows: DataFrame, anchors: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) over ``vec_id``, ``label``, ``embedding``.

    ``anchors`` is a condition on vec_id.  A negative of a positive scores from ``low`` to ``high`` hundredths of it.
    """
    spark = rows.sparkSession
    shared_dir(spark)
    table = usable(rows).checkpoint()
    count, dim = table.filter(anchors).agg(F.count("*"), F.max(F.size("x"))).first()
    blocks = -(-count // (BLOCK * 3 // 4)) if count else 0  # hashed blocks differ in size; a large one is cut below
    chunks, found = table.coalesce(CHUNKS), []
    for first in range(0, blocks, GROUP):
        numbered = table.filter(anchors).withColumn("b", F.pmod(F.xxhash64("vec_id"), F.lit(blocks))).filter(F.col("b").between(first, first + GROUP - 1))
        group = numbered.drop("b").toArrow().combine_chunks()
        cut = []
        for start in range(0, group.num_rows, BLOCK):
            part = group.slice(start, BLOCK)
            cut.append((part["vec_id"].to_numpy(), part["label"].to_numpy(), _matrix(part["x"].combine_chunks(), dim)))
        if not cut:
            continue
        one = [chunks.mapInArrow(partial(_positives, ids=i, labels=v, a=a, k=positives), _ROWS) for i, v, a in cut]
        best = _first(reduce(DataFrame.unionByName, one), ["anchor_id"], positives).select("anchor_id", "other_id", "other_score").collect()  # GROUP * BLOCK * positives rows at most
        two = []
        for ids, labels, a in cut:
            at = {v: n for n, v in enumerate(ids.tolist())}
            windows = sorted((at[r[0]], r[1], r[2], *_window(r[2], low, high)) for r in best if r[0] in at)
            if windows:
                two.append(chunks.mapInArrow(partial(_negatives, ids=ids, labels=labels, a=a, pos=np.array(windows, dtype=np.int64), k=negatives), _ROWS))
        if two:
            found.append(_first(reduce(DataFrame.unionByName, two), ["anchor_id", "positive_id"], negatives).checkpoint())
    every = reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], _ROWS + ", rank int")
    return every.select("anchor_id", "positive_id", "rank", F.col("other_id").alias("negative_id"), "positive_score", F.col("other_score").alias("negative_score"))


ORACLE = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS a, c.vec_id AS c, a.label = c.label AS same, list_inner_product(a.q, c.q)::BIGINT AS score
  FROM v a JOIN v c ON a.vec_id % 100 = 0 AND a.vec_id <> c.vec_id),
p AS (SELECT a, c, score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, c) <= 5)
SELECT p.a AS anchor_id, p.c AS positive_id, row_number() OVER (PARTITION BY p.a, p.c ORDER BY s.score DESC, s.c) AS "rank",
  s.c AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM p JOIN s ON s.a = p.a AND NOT s.same AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score
QUALIFY row_number() OVER (PARTITION BY p.a, p.c ORDER BY s.score DESC, s.c) <= 10
"""
