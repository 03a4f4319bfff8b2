"""Near copies by SimHash at a low similarity, for stages that thin a corpus out.

Texts whose word shingles are 0.8 similar differ in about every seventh bit of a fingerprint, far
beyond what one search radius over 64 bits can cover.  So the fingerprint is ``BITS`` long, over the set
of five-word shingles, and many short codes are drawn from it: each takes some groups of seven bits, and
each group goes to its nearest code word of the [7,4] Hamming code, the anchor whose covering radius is
one.  Texts that share all anchors of a code meet in a bucket.  The number of codes follows from the wanted
recall at the wanted similarity, and the number of groups from the number of texts, so that a bucket holds
about ``CHANCE`` texts by chance at any size.

First each text is linked to the nearest of its bucket that is not linked to it yet, in two rounds of ``NEAREST``
codes: a large group of copies grows together with links in proportion to its size.  Then, in all codes, every two
texts of a bucket that are still in different parts are compared, without a cap: large buckets are cut into tiles,
and texts of one part cost nothing.  The differing bits only leave out what is clearly different (four deviations
beyond the expected share on 128 bits, then ``DEVIATIONS`` on all); the pairs that are left are linked if the
Jaccard similarity of their sets of shingles, counted exactly, is high enough.

Defined cases: a null text counts as empty; texts of fewer than five words are one shingle; texts without
words are alike; repeated rows give a row each; rows with a null id are left out; very long texts are one
set of shingles like any other; of texts with equal fingerprints the smallest id stands for all; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.components import connected_components
from ledgerloom.llm.kernels import Words, blocks, gram_hashes, long_array, lowered, mix, shared_dir, word_hashes

BITS = 512
RECALL = 0.97
DEVIATIONS = 3
CHANCE = 64
NEAREST = 8  # codes of each round that links every text to its nearest
TILE = 1024  # texts of a bucket
BLOCK_PAIRS = 100_000
BLOCK_LONGS = 1 << 22  # hashes, 8 bytes each, of the sets of a block
FEW = 2_000_000  # ids, 8 bytes each, that may be broadcast
_CHUNK = 1 << 14
_CELLS = 1 << 18
_PAIRS = 1 << 20
_NONE = np.iinfo(np.int64).max


def _nearest() -> np.ndarray:
    """The number (0 to 15) of the [7,4] code word nearest to each 7-bit value."""
    words = [w for w in range(128) if not _syndrome(w)]
    return np.array([words.index(v ^ (1 << (_syndrome(v) - 1)) if _syndrome(v) else v) for v in range(128)], dtype=np.int64)


def _syndrome(value: int) -> int:
    s = 0
    for place in range(1, 8):
        if value >> (place - 1) & 1:
            s ^= place
    return s


def differing(similarity: float) -> float:
    """The expected share of differing bits of two sets of this Jaccard similarity."""
    return math.acos(2 * similarity / (1 + similarity)) / math.pi


def block_hit(p: float) -> float:
    """Chance that two 7-bit groups whose bits differ with probability p have the same anchor."""
    q = 1 - p
    centre = q**7 + 7 * p * q**6
    off = q**7 + p * q**6 + 6 * p**2 * q**5
    return (centre + 7 * off) / 8


def plan(n: int, similarity: float, recall: float = RECALL) -> tuple[int, int]:
    """(blocks, codes) for n texts: chance alone puts at most about ``CHANCE`` of them into a bucket."""
    k = max(2, math.ceil(math.log2(max(n, 2) / CHANCE) / 4))
    return k, math.ceil(math.log(1 - recall) / math.log(1 - block_hit(differing(similarity)) ** k))


def wide_fingerprint(shingles: np.ndarray) -> bytes:
    """BITS bits of a set of 64-bit shingle hashes: each is set if most hashes set it."""
    out = []
    for seed in range(BITS // 64):
        h = mix(shingles + np.uint64(seed * 0xD1342543DE82EF95 % 2**64))
        ones = np.zeros(64, dtype=np.int64)
        for at in range(0, len(h), _CHUNK):
            ones += np.unpackbits(h[at : at + _CHUNK].view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
        out.append(np.packbits(ones * 2 > len(h)).tobytes())
    return b"".join(out)


def _sets(batches, shingle: int, extra: tuple[str, ...] = ()):
    """(block, sets) of each block: the sorted hashes of each text's shingles."""
    for block in blocks(batches, extra):
        words = Words(block)
        h = word_hashes(lowered(block.buf), words)
        g, ok = gram_hashes(h, words, shingle)
        made = []
        for i in range(len(block)):
            a, b = words.first[i], words.first[i + 1]
            if b - a >= shingle:
                made.append(np.unique(g[a:b][ok[a:b]]))
            elif b > a:
                one = np.uint64(b - a)
                for x in h[a:b]:
                    one = mix(np.array([one]) ^ x)[0]
                made.append(np.array([one]))
            else:
                made.append(np.zeros(0, np.uint64))
        yield block, made


def _texts(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return df.filter(F.col(id_col).isNotNull()).select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))


def fingerprints(df: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """(doc_id, fp): BITS bits as binary."""

    def run(batches):
        for block, sets in _sets(batches, shingle):
            made = [wide_fingerprint(s) if len(s) else bytes(BITS // 8) for s in sets]
            yield pa.RecordBatch.from_arrays([block.ids, pa.array(made, pa.binary())], ["doc_id", "fp"])

    return _texts(df, id_col, text_col).mapInArrow(run, f"doc_id {df.schema[id_col].dataType.simpleString()}, fp binary")


def shingle_sets(texts: DataFrame, shingle: int) -> DataFrame:
    """(doc_id, fp, grams): the set of each text's shingles, of a table (doc_id, text, fp)."""

    def run(batches):
        for block, sets in _sets(batches, shingle, ("fp",)):
            grams = long_array(np.concatenate(sets).view(np.int64), np.array([len(s) for s in sets]))
            yield pa.RecordBatch.from_arrays([block.ids, block.columns["fp"], grams], ["doc_id", "fp", "grams"])

    return texts.mapInArrow(run, f"doc_id {texts.schema['doc_id'].dataType.simpleString()}, fp binary, grams array<long>")


def _coded(k: int, codes: range, batches):
    """Rows (key, node, part, head, tail): the anchors of these codes, and the fingerprint's first and second 64 bits."""
    rng = np.random.default_rng(99)
    places = np.stack([rng.choice(BITS, 7 * k, replace=False) for _ in range(codes.stop)]).reshape(-1, k, 7)[codes.start :]
    anchor, power, rows = _nearest(), 1 << np.arange(7), max(1, _CELLS // (len(codes) * k))
    for b in batches:
        for at in range(0, b.num_rows, rows):
            part = b.slice(at, rows)
            raw = np.frombuffer(b"".join(part.column("fp").to_pylist()), np.uint8).reshape(part.num_rows, BITS // 8)
            bits = np.unpackbits(raw, axis=1)
            value = bits[:, places] @ power  # (text, code, block)
            key = (anchor[value] << (4 * np.arange(k))).sum(axis=2) | np.arange(codes.start, codes.stop, dtype=np.int64) << (4 * k)
            head, tail = np.ascontiguousarray(raw[:, :16]).view(">i8").astype(np.int64).T
            row = pa.array(np.repeat(np.arange(part.num_rows), len(codes)))
            yield pa.RecordBatch.from_arrays([pa.array(key.ravel()), part.column("node").take(row), part.column("part").take(row), pa.array(head).take(row), pa.array(tail).take(row)], ["key", "node", "part", "head", "tail"])


def bit_limit(bits: int, similarity: float, deviations: float) -> int:
    """So many of these bits may differ: the expected number at this similarity and some deviations more."""
    p = differing(similarity)
    return int(bits * p + deviations * math.sqrt(bits * p * (1 - p)))


def _listed(nodes: pa.Array, x: np.ndarray, y: np.ndarray) -> pa.RecordBatch:
    """Pairs of places (x in ascending order) as one row for each x."""
    start = np.flatnonzero(np.concatenate(([True], x[1:] != x[:-1]))) if len(x) else np.zeros(0, np.int64)
    ends = np.concatenate((start, [len(x)])).astype(np.int32)
    return pa.RecordBatch.from_arrays([nodes.take(pa.array(x[start])), pa.ListArray.from_arrays(pa.array(ends), nodes.take(pa.array(y)))], ["node", "others"])


def _met(limit: int, nearest: bool, batches):
    """Rows (node, others) of the members of each bucket whose parts differ and whose first 128 bits are close: all such
    pairs, once each, or each member with its nearest.  A row is a bucket, or two tiles of one, as lists of its members'
    columns; ``apart`` says that only pairs across tiles count."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lists = [batch.column(c) for c in ("part", "head", "tail", "tile")]
        size = lists[0].value_lengths().to_numpy()
        group = np.repeat(np.arange(len(size)), size)
        raw, head, tail, tile = (x.flatten().to_numpy(zero_copy_only=False) for x in lists)
        part = np.unique(raw, return_inverse=True)[1]
        order = np.lexsort((part, group))
        part, head, tail, tile = part[order], head[order].view(np.uint64), tail[order].view(np.uint64), tile[order]
        nodes = batch.column("node").flatten().take(pa.array(order))
        apart = np.asarray(batch.column("apart").to_numpy(zero_copy_only=False), dtype=bool)[group]
        last = np.concatenate((np.flatnonzero((group[1:] != group[:-1]) | (part[1:] != part[:-1])) + 1, [len(group)]))
        stop = last[np.searchsorted(last, np.arange(len(group)), "right")]  # where the next part begins
        many = np.cumsum(size)[group] - stop
        total, at = np.cumsum(many), 0
        best = np.full(len(group), _NONE)
        while at < len(many):
            end = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + _PAIRS, "right")))
            n = many[at:end]
            x = np.repeat(np.arange(at, end), n)
            y = stop[x] + np.arange(len(x)) - np.repeat(np.cumsum(n) - n, n)
            bits = np.bitwise_count(head[x] ^ head[y]).astype(np.int64) + np.bitwise_count(tail[x] ^ tail[y])
            near = (bits <= limit) & (~apart[x] | (tile[x] != tile[y]))
            x, y, bits = x[near], y[near], bits[near]
            if nearest:
                np.minimum.at(best, x, bits << 40 | y)
                np.minimum.at(best, y, bits << 40 | x)
            else:
                yield _listed(nodes, x, y)
            at = end
        if nearest:
            x = np.flatnonzero(best < _NONE)
            yield _listed(nodes, x, best[x] & (1 << 40) - 1)


def bucket_pairs(coded: DataFrame, similarity: float, nearest: bool, tile: int = TILE) -> DataFrame:
    """(node, others): nodes of a bucket that are not in one part yet and whose first bits are close; every two, or each
    with its nearest.  A bucket of more than ``tile`` nodes is cut into tiles, and each two of them are compared by a task
    of their own."""
    kind = coded.schema["node"].dataType.simpleString()
    mixed = coded.groupBy("key").agg(F.min("part").alias("low"), F.max("part").alias("high"), F.count("*").alias("n")).filter("low < high")
    tiles = F.ceil(F.col("n") / tile).cast("int")
    rows = coded.join(mixed.select("key", tiles.alias("tiles")), "key").withColumn("tile", F.pmod(F.xxhash64("node", "head"), F.col("tiles")).cast("int"))
    dealt = rows.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))).withColumns({"i": F.least("tile", "with"), "j": F.greatest("tile", "with")})
    columns = ["node", "part", "head", "tail", "tile"]
    lists = dealt.groupBy("key", "i", "j").agg(*(F.collect_list(c).alias(c) for c in columns))  # two tiles at most
    asked = lists.filter(F.size("node") > 1).select(*columns, (F.col("i") < F.col("j")).alias("apart"))
    return asked.mapInArrow(partial(_met, bit_limit(128, similarity, 4), nearest), f"node {kind}, others array<{kind}>").distinct()


def _places(table: pa.Table, nodes: pa.ChunkedArray) -> np.ndarray:
    """Where each node stands in a table of distinct nodes."""
    own = table.column("node").to_numpy()
    order = np.argsort(own)
    return order[np.searchsorted(own[order], nodes.to_numpy())]


def _judge(limit: int, similarity: float, lists: pa.Table, cells: pa.Table) -> pa.Table:
    """The pairs (a, b) of a block whose fingerprints differ in at most ``limit`` bits and whose sets (sorted lists of
    distinct hashes) have this Jaccard similarity or more."""
    others = lists.column("others").combine_chunks()
    a = lists.column("node").combine_chunks().take(pa.array(np.repeat(np.arange(len(lists)), others.value_lengths().to_numpy())))
    place = _places(cells, pa.chunked_array([pa.concat_arrays([a, others.flatten()])]))
    i, j = np.unique(np.sort(place.reshape(2, -1), axis=0), axis=1)
    fp = np.frombuffer(b"".join(cells.column("fp").to_pylist()), np.uint8).reshape(-1, BITS // 8)
    near = [np.bitwise_count(fp[i[at : at + _CHUNK]] ^ fp[j[at : at + _CHUNK]]).sum(axis=1, dtype=np.int64) <= limit for at in range(0, len(i), _CHUNK)]
    near = np.concatenate(near) if near else np.zeros(0, bool)
    i, j = i[near], j[near]
    grams = cells.column("grams").combine_chunks()
    flat, ends = grams.flatten().to_numpy().view(np.uint64), np.concatenate(([0], np.cumsum(grams.value_lengths().to_numpy())))
    good = np.zeros(len(i), dtype=bool)
    for k, (p, q) in enumerate(zip(i.tolist(), j.tolist(), strict=True)):
        x, y = flat[ends[p] : ends[p + 1]], flat[ends[q] : ends[q + 1]]
        if len(x) > len(y):
            x, y = y, x
        if len(x) and len(x) >= similarity * len(y) - 1e-9:
            common = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())
            good[k] = common >= similarity * (len(x) + len(y) - common) - 1e-9
    node = cells.column("node").combine_chunks()
    return pa.table([node.take(pa.array(i[good])), node.take(pa.array(j[good]))], names=["a", "b"])


def _links(lists: DataFrame, classes: DataFrame, texts: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """The pairs (a, b) of (node, others) whose sets of shingles are similar enough.  Pairs are judged in blocks of about
    ``BLOCK_PAIRS``, and a text's fingerprint and set go to a block once, however many of its pairs have it: a dense group
    sends texts, not pairs of texts."""
    kind = classes.schema["node"].dataType.simpleString()
    lists = lists.checkpoint()

    def dealt(blocks: int) -> tuple[DataFrame, DataFrame]:
        """The lists with their blocks, and the nodes of each block."""
        placed = lists.withColumn("block", F.pmod(F.xxhash64("node", F.get("others", F.lit(0))), F.lit(blocks)).cast("int"))
        nodes = F.array_distinct(F.concat(F.collect_set("node"), F.flatten(F.collect_list("others"))))
        return placed, placed.groupBy("block").agg(nodes.alias("nodes")).select("block", F.explode("nodes").alias("node"))

    blocks = max((lists.agg(F.sum(F.size("others"))).first()[0] or 0) // BLOCK_PAIRS, 1)
    asked = dealt(blocks)[1].select(F.col("node").alias("doc_id")).distinct().checkpoint()
    count = asked.count()
    some = F.broadcast(asked) if count <= FEW else asked  # otherwise the texts are shuffled
    own = texts.join(some, "doc_id", "left_semi").dropDuplicates(["doc_id"]).join(classes.select(F.col("node").alias("doc_id"), "fp"), "doc_id")
    sets = shingle_sets(own.select("doc_id", "text", "fp"), shingle).withColumnRenamed("doc_id", "node").checkpoint()
    longs = sets.agg(F.avg(F.size("grams"))).first()[0] or 0
    placed, members = dealt(max(blocks, int(2 * count * longs / BLOCK_LONGS)))
    cells = members.join(sets, "node").select(F.col("block").alias("of"), "node", "fp", "grams")
    judge = partial(_judge, bit_limit(BITS, similarity, DEVIATIONS), similarity)
    return placed.groupBy("block").cogroup(cells.groupBy("of")).applyInArrow(lambda x, y: judge(x, y), f"a {kind}, b {kind}")


def groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, similarity: float = 0.8, recall: float = RECALL) -> DataFrame:
    """(doc_id, component_id) of every row: the smallest id that a chain of near copies leads to."""
    shared_dir(df.sparkSession)
    prints = fingerprints(df, id_col, text_col, shingle).checkpoint()
    classes = prints.groupBy("fp").agg(F.min("doc_id").alias("node")).checkpoint()
    k, codes = plan(classes.count(), similarity, recall)
    kind, texts = df.schema[id_col].dataType.simpleString(), _texts(df, id_col, text_col)

    def pairs(parts: DataFrame, codes: range, nearest: bool) -> DataFrame:
        rows = parts.select("fp", "node", "part").mapInArrow(partial(_coded, k, codes), f"key long, node {kind}, part {kind}, head long, tail long")
        return _links(bucket_pairs(rows, similarity, nearest), classes, texts, shingle, similarity)

    parts, links = classes.withColumn("part", F.col("node")), None
    for codes_of in (range(0, min(codes, NEAREST)), range(min(codes, NEAREST), min(codes, 2 * NEAREST))):
        if len(codes_of):
            found = pairs(parts, codes_of, True)
            links = connected_components(found if links is None else found.unionByName(links)).select(F.col("component").alias("a"), F.col("node").alias("b")).checkpoint()
            parts = classes.join(links.select(F.col("b").alias("node"), F.col("a").alias("part")), "node", "left").select("fp", "node", F.coalesce("part", "node").alias("part")).checkpoint()
    links = pairs(parts, range(codes), False).unionByName(links)
    named = classes.join(connected_components(links), "node", "left").select("fp", F.coalesce("component", "node").alias("component_id"))
    return prints.join(named, "fp").select("doc_id", "component_id")


def keep_representatives(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """The rows of ``df`` with the smallest id of their group; of rows that share an id one stays, rows with a null id all do."""
    found = groups(df, id_col, text_col, **kw)
    first = found.groupBy("doc_id").agg(F.min("component_id").alias("c")).filter("doc_id = c").select(F.col("doc_id").alias(id_col))
    return df.join(first, id_col, "left_semi").dropDuplicates([id_col]).unionByName(df.filter(F.col(id_col).isNull()))
