"""Nearest neighbours by a forest of random-projection trees with one priority queue for all trees.

The split planes are fitted on a sample of at most ``SAMPLE`` rows.  Every row is then indexed: each
tree routes it to a leaf.  Where the table is larger than the fitted leaves hold at ``LEAF`` rows,
the route goes on below them by the side of shared random directions through the leaf's centre, so
leaves stay small at any size while the planes stay bounded.  A query pops the most promising
branches of all trees from one queue; the rows in its leaves are reranked by exact distance in double
precision.  How many leaves a query takes is measured, not guessed: ``CALIBRATION`` queries are compared
with every row, and the number is the smallest with which they find ``RECALL`` of their true neighbours.

Equal vectors are one class with its smallest ids, so a vector that a third of the rows share costs
one comparison.  Queries go in blocks of ``QUERY_BLOCK`` distinct vectors, each block against all rows;
a block and the planes are all that tasks receive.  A block asks for ``PROBES`` leaves at most, and reaches
the driver as Arrow columns, so what it holds does not grow with the table.

Defined cases: vectors that are null, zero or of another length than the first id's, or that hold null
or non-finite components, take no part, as rows with a null id; repeated ids count once with their
smallest vector; fewer candidates than asked for give all of them; ties go to the smaller id; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import partial
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.kernels import shared_dir

TREES = 16
SAMPLE = 16_384
LEAF = 48
RECALL = 0.95
CALIBRATION = 96
QUERY_BLOCK = 16_384
PROBES = 1 << 23
_PAIRS = 1 << 17
_CROWD = 1 << 21


class Forest:
    """Planes of all trees in one array; leaves have negative child numbers."""

    def __init__(self, sample: np.ndarray, rows: int, trees: int = TREES, leaf: int = LEAF, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.planes: list[np.ndarray] = []
        self.offset: list[float] = []
        self.child: list[list[int]] = []
        self.centre: list[np.ndarray] = []
        size = max(4, round(leaf * min(1.0, len(sample) / max(rows, 1))))
        self.roots = [self._grow(sample, np.arange(len(sample)), rng, size) for _ in range(trees)]
        dim = sample.shape[1]
        leaves = max(1, len(self.centre) // trees)
        self.extra = max(0, int(np.ceil(np.log2(max(rows, 1) / (leaves * leaf * 1.5))))) if rows > len(sample) else 0
        self.planes = np.array(self.planes, dtype=np.float64).reshape(-1, dim)
        self.offset, self.child = np.array(self.offset), np.array(self.child, dtype=np.int64).reshape(-1, 2)
        self.centre = np.array(self.centre).reshape(-1, dim)
        self.below = rng.standard_normal((self.extra, dim)) / np.sqrt(dim)
        self.middle = self.centre @ self.below.T  # (leaf, level)

    def _grow(self, x: np.ndarray, own: np.ndarray, rng, size: int) -> int:
        """The number of a new node over these sample rows: >= 0 a split, < 0 a leaf."""
        if len(own) > size:
            for _ in range(4):
                a, b = x[rng.choice(own, 2, replace=False)]
                plane = (a - b) / (np.linalg.norm(a - b) or 1.0)
                side = x[own] @ plane
                cut = float(np.median(side))
                left = side < cut
                if 0 < left.sum() < len(own):
                    me = len(self.planes)
                    self.planes.append(plane)
                    self.offset.append(cut)
                    self.child.append([0, 0])
                    self.child[me] = [self._grow(x, own[left], rng, size), self._grow(x, own[~left], rng, size)]
                    return me
        self.centre.append(x[own].mean(axis=0))
        return -len(self.centre)

    def route(self, x: np.ndarray) -> np.ndarray:
        """The leaf code of each row in each tree."""
        out = np.empty((len(x), len(self.roots)), dtype=np.int64)
        deep = x @ self.below.T
        for t, root in enumerate(self.roots):
            node = np.full(len(x), root, dtype=np.int64)
            while (open_ := np.flatnonzero(node >= 0)).size:
                at = node[open_]
                right = np.einsum("ij,ij->i", x[open_], self.planes[at]) >= self.offset[at]
                node[open_] = self.child[at, right.astype(np.int64)]
            leaf = -node - 1
            code = leaf
            for e in range(self.extra):
                code = code * 2 + (deep[:, e] >= self.middle[leaf, e])
            out[:, t] = code
        return out

    def search(self, q: np.ndarray, leaves: int) -> list[int]:
        """Codes of the most promising leaves of all trees."""
        return list(islice(self.promising(q), leaves))

    def promising(self, q: np.ndarray) -> Iterator[int]:
        """All leaf codes, the most promising first."""
        margin = (self.planes @ q - self.offset).tolist()
        deep = (self.below @ q).tolist()
        # (minus priority, node, level below the leaf, code)
        heap = [(-float("inf"), root, 0, 0) for root in self.roots]
        while heap:
            cost, node, level, code = heapq.heappop(heap)
            if node >= 0:
                m, kids = margin[node], self.child[node]
                heapq.heappush(heap, (max(cost, -m), int(kids[1]), 0, 0))
                heapq.heappush(heap, (max(cost, m), int(kids[0]), 0, 0))
                continue
            leaf = -node - 1
            code = code if level else leaf
            if level == self.extra:
                yield code
                continue
            m = deep[level] - self.middle[leaf, level]
            heapq.heappush(heap, (max(cost, -m), node, level + 1, code * 2 + 1))
            heapq.heappush(heap, (max(cost, m), node, level + 1, code * 2))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _indexed(forest: Forest, batches):
    for b in batches:
        if b.num_rows:
            codes = forest.route(_matrix(b.column("vec")))
            yield pa.RecordBatch.from_arrays([b.column("ids"), b.column("vec"), pa.ListArray.from_arrays(pa.array(np.arange(len(codes) + 1, dtype=np.int32) * codes.shape[1]), pa.array(codes.ravel()))], ["ids", "vec", "codes"])


def _probed(forest: Forest, leaves: int, batches):
    for b in batches:
        if b.num_rows:
            yield pa.RecordBatch.from_arrays([b.column("qid"), b.column("vec"), pa.array([forest.search(q, leaves) for q in _matrix(b.column("vec"))], pa.list_(pa.int64()))], ["qid", "vec", "leaves"])


def _nearest(qid: np.ndarray, queries: np.ndarray, leaf: np.ndarray, asking: np.ndarray, k: int, batches):
    """Rows (qid, vec_id, distance): the k nearest of a batch for each query that probes a leaf of theirs.
    ``leaf`` (sorted) and ``asking``: the leaf codes that queries probe."""
    for b in batches:
        if not b.num_rows:
            continue
        codes = _matrix(b.column("codes")).astype(np.int64)
        low, high = np.searchsorted(leaf, codes, "left"), np.searchsorted(leaf, codes, "right")
        crowd = np.cumsum((high - low).sum(axis=1))
        at = 0
        while at < len(codes):  # as many rows at a time as have a bounded number of probes
            end = max(at + 1, int(np.searchsorted(crowd, (crowd[at - 1] if at else 0) + _CROWD, "right")))
            yield _reranked(qid, queries, asking, low[at:end], high[at:end], k, b.slice(at, end - at))
            at = end


def _reranked(qid, queries, asking, low, high, k: int, b: pa.RecordBatch) -> pa.RecordBatch:
    x, pairs = _matrix(b.column("vec")), []
    for t in range(low.shape[1]):
        n = high[:, t] - low[:, t]
        row = np.repeat(np.arange(len(x)), n)
        pairs.append(asking[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low[:, t], n)] * len(x) + row)
    pair = np.unique(np.concatenate(pairs))
    q, row = pair // len(x), pair % len(x)
    dist = np.empty(len(pair))
    for s in range(0, len(pair), _PAIRS):
        dist[s : s + _PAIRS] = np.sqrt(((queries[q[s : s + _PAIRS]] - x[row[s : s + _PAIRS]]) ** 2).sum(axis=1))
    ids = b.column("ids")
    flat, n = ids.flatten().to_numpy(), ids.value_lengths().to_numpy()
    first, m = np.cumsum(n) - n, n[row]
    member = flat[np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m) + np.repeat(first[row], m)]
    q, dist = np.repeat(q, m), np.repeat(dist, m)
    order = np.lexsort((member, dist, q))
    q, dist, member = q[order], dist[order], member[order]
    start = np.flatnonzero(np.concatenate(([True], q[1:] != q[:-1]))) if len(q) else np.zeros(0, np.int64)
    keep = np.arange(len(q)) - np.repeat(start, np.diff(np.concatenate((start, [len(q)])))) < k
    return pa.RecordBatch.from_arrays([pa.array(qid[q[keep]]), pa.array(member[keep]), pa.array(dist[keep])], ["qid", "vec_id", "score"])


def _compared(queries: np.ndarray, k: int, batches):
    """Rows (q, distance, codes): the k rows of each batch nearest to each query by comparing all; equal vectors aside."""
    for b in batches:
        if not b.num_rows:
            continue
        x, codes = _matrix(b.column("vec")), b.column("codes")
        for i, q in enumerate(queries):
            d = ((x - q) ** 2).sum(axis=1)
            d[d == 0] = np.inf
            near = np.argsort(d, kind="stable")[:k]
            near = near[np.isfinite(d[near])]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(near), i)), pa.array(d[near]), codes.take(pa.array(near))], ["q", "distance", "codes"])


def leaves_needed(forest: Forest, queries: np.ndarray, truth: list[list[list[int]]], recall: float) -> int:
    """The smallest number of leaves with which the queries meet this share of their true neighbours, given those neighbours' codes."""
    ranks = []
    for q, codes in zip(queries, truth, strict=True):
        waiting = {i: set(c) for i, c in enumerate(codes)}
        for rank, code in enumerate(forest.promising(q), 1):
            if not waiting:
                break
            for i in [i for i, c in waiting.items() if code in c]:
                ranks.append(rank)
                del waiting[i]
    ranks.sort()
    return ranks[min(len(ranks) - 1, int(np.ceil(recall * len(ranks))) - 1)] if ranks else 1


def usable(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, vec) of the rows that take part."""
    v = F.col(vec_col)
    rows = df.filter(F.col(id_col).isNotNull() & v.isNotNull()).select(F.col(id_col).cast("long").alias("vec_id"), v.alias("vec"))
    good = F.expr("size(vec) > 0 AND forall(vec, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity')) AND exists(vec, x -> x <> 0)")
    rows = rows.filter(good)
    first = rows.agg(F.min_by(F.size("vec"), "vec_id").alias("n")).first()["n"]
    return rows.filter(F.size("vec") == (first or 0))


def top_ids(rows: DataFrame, k: int) -> DataFrame:
    """(vec, ids): each distinct vector with its k smallest ids; combined in two steps for vectors that very many rows share."""
    part = Window.partitionBy("vec", "salt").orderBy("vec_id")
    whole = Window.partitionBy("vec").orderBy("vec_id")
    some = rows.withColumn("salt", F.pmod(F.xxhash64("vec_id"), F.lit(64))).withColumn("r", F.row_number().over(part)).filter(F.col("r") <= k)
    few = some.withColumn("r", F.row_number().over(whole)).filter(F.col("r") <= k)
    return few.groupBy("vec").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))


def candidates(classes: DataFrame, n: int, sample: int) -> DataFrame:
    """The vectors whose hashes are within twice the share of ``sample`` among ``n``: a sorted limit sends the
    driver up to that many rows of every partition, so it must not see them all."""
    return classes if n <= 2 * sample else classes.filter(F.xxhash64("vec") < F.lit((1 << 65) * sample // n - (1 << 63)))


def fitting_sample(classes: DataFrame, n: int, sample: int) -> DataFrame:
    """The ``sample`` vectors with the smallest hashes."""
    return candidates(classes, n, sample).select("vec").orderBy(F.xxhash64("vec")).limit(sample)


def block_size(leaves: int, query_block: int = QUERY_BLOCK) -> int:
    """How many queries go at a time: ``query_block``, fewer where they ask for more than ``PROBES`` leaves."""
    return max(1, min(query_block, PROBES // leaves))


def nearest(df: DataFrame, k: int = 10, every: int = 100, id_col: str = "vec_id", vec_col: str = "embedding", trees: int = TREES, recall: float = RECALL, sample: int = SAMPLE, leaf: int = LEAF, query_block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest of every row whose id is divisible by ``every``."""
    spark = df.sparkSession
    shared_dir(spark)
    schema = "query_id long, rank int, vec_id long, score double"
    rows = usable(df, id_col, vec_col)
    # a repeated id keeps its smallest vector
    rows = rows.groupBy("vec_id").agg(F.min("vec").alias("vec"))
    classes = top_ids(rows, k + 1).checkpoint()
    n = classes.count()
    if not n:
        return spark.createDataFrame([], schema)
    forest = Forest(_matrix(fitting_sample(classes, n, sample).toArrow().column("vec").combine_chunks()), n, trees, leaf)
    element = classes.schema["vec"].dataType.simpleString()
    index = classes.mapInArrow(partial(_indexed, forest), f"ids array<long>, vec {element}, codes array<long>").checkpoint()
    members = rows.filter(F.col("vec_id") % every == 0)
    asked = members.groupBy("vec").agg(F.min("vec_id").alias("qid")).checkpoint()
    known = np.array([r["vec"] for r in asked.orderBy(F.xxhash64("qid")).limit(CALIBRATION).collect()], dtype=np.float64)
    near = Window.partitionBy("q").orderBy("distance")
    truth: list[list] = [[] for _ in known]
    for r in index.select("vec", "codes").mapInArrow(partial(_compared, known, k), "q long, distance double, codes array<long>").withColumn("r", F.row_number().over(near)).filter(F.col("r") <= k).select("q", "codes").collect():
        truth[r["q"]].append(r["codes"])
    leaves = leaves_needed(forest, known, truth, recall)
    query_block = block_size(leaves, query_block)
    n_blocks = -(-asked.count() // query_block)
    best, by_class = None, Window.partitionBy("qid").orderBy("score", "vec_id")
    for block in range(n_blocks):
        mine = asked.filter(F.pmod(F.xxhash64("qid"), F.lit(n_blocks)) == block).repartition(max(1, min(64, query_block // 64)))
        probes = mine.mapInArrow(partial(_probed, forest, leaves), f"qid long, vec {element}, leaves array<long>").toArrow()
        if not probes.num_rows:
            continue
        asks = probes.column("leaves").combine_chunks()
        codes = asks.flatten().to_numpy()
        order = np.argsort(codes, kind="stable")
        ask = np.repeat(np.arange(probes.num_rows), asks.value_lengths().to_numpy())[order]
        near = partial(_nearest, probes.column("qid").to_numpy(), _matrix(probes.column("vec").combine_chunks()), codes[order], ask, k + 1)
        found = index.mapInArrow(near, "qid long, vec_id long, score double").withColumn("r", F.row_number().over(by_class)).filter(F.col("r") <= k + 1)
        found = found.select("qid", "vec_id", "score").checkpoint()  # what the next block needs is these rows, not this block
        best = found if best is None else best.unionByName(found)
    if best is None:
        return spark.createDataFrame([], schema)
    queries = members.join(asked, "vec").select(F.col("vec_id").alias("query_id"), "qid")
    by_query = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return queries.join(best, "qid").filter("vec_id <> query_id").withColumn("rank", F.row_number().over(by_query)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
