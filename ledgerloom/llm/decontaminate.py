"""Benchmark decontamination by the CGK embedding.

The CGK random walk maps edit distance to Hamming distance: the output repeats the symbol under a
pointer that advances by a random bit of (step, symbol).  Symbols are words.  Each repetition draws
a walk and ``SAMPLES`` of its steps; item and window agree on the key if they agree on those steps.
The walks of long items and of items padded to their class part too early for ``REPEATS`` repetitions to
find them all, so each item is also searched by pieces: cut into ``d + 1`` runs of words, at most ``d``
edits leave one of them whole, at most ``d`` words from its place.  No passage within ``d`` edits is missed.

Windows are as long as the item, at every word.  Before the walk a lossless test leaves out the
windows that cannot be near an item: with at most ``d`` edits, an item of ``n`` words keeps at least
``n - 1 - 2d`` of its word pairs.  The keys of the remaining windows are joined to those of the
items, and each candidate is verified by the exact edit distance over words against the best
ending of the window.

The benchmark is the stated query set: it is read in blocks of ``BLOCK_ITEMS`` items, so what the
tasks receive has a fixed bound, and every block goes over all texts.

Items of fewer than ``MIN_WORDS`` words allow no edit at this similarity and are looked up as they are.

Defined cases: null texts count as empty; A-Z are lower-cased; items without words give no row; equal
texts under several items give a row for each; equal document rows count once, different texts of one id
give the best place of either; of equally near places the first counts; rows with a null id are left out;
empty tables give no rows; very long texts are searched block by block; other columns are ignored.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.kernels import Words, blocks, long_array, lowered, mix, word_hashes

SIMILARITY = 0.8
REPEATS = 24
SAMPLES = 2
MIN_WORDS = 4
BLOCK_ITEMS = 20_000
CLASSES = 60
_PAD = np.uint64(0x5851F42D4C957F2D)
_SLOTS = 1 << 22
_SHORT = 1000  # a length class of its own for short items


def allowed(longest: int, similarity: float) -> int:
    """The largest edit distance of two word sequences of which the longer one has this length."""
    return int((1 - similarity) * longest + 1e-9)


def edits(n: int, similarity: float) -> int:
    """The largest edit distance that an item of n words allows: a passage may be longer than the item, by its edits at
    most, so it has at most n / similarity words."""
    return allowed(int(n / similarity + 1e-9), similarity)


def least_pairs(n: int, similarity: float) -> int:
    return max(1, n - 1 - 2 * edits(n, similarity))


def walk(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For items of n words: the steps (REPEATS, SAMPLES) that each repetition looks at, the odd factors
    (REPEATS, 2n) whose products' top bits advance the pointer, and the repetitions' first keys."""
    rng = np.random.default_rng(n)
    steps = np.stack([rng.choice(2 * n, SAMPLES, replace=False) for _ in range(REPEATS)])
    factors = rng.integers(0, 2**63, (REPEATS, 2 * n), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return steps, factors, mix(np.arange(REPEATS, dtype=np.uint64) + np.uint64(n * 1000003))


def walk_keys(words: np.ndarray, n: int) -> np.ndarray:
    """Keys (REPEATS, rows) of rows of n word hashes (ended by padding)."""
    rows = np.concatenate((words, np.full((len(words), 1), _PAD, np.uint64)), axis=1)
    steps, factors, first = walk(n)
    pointer = np.zeros((REPEATS, len(rows)), dtype=np.int64)
    line = np.arange(len(rows))[None, :]
    key = np.repeat(first[:, None], len(rows), axis=1)
    for step in range(int(steps.max()) + 1):
        symbol = rows[line, pointer]
        looking = np.flatnonzero((steps == step).any(axis=1))
        if len(looking):
            key[looking] = mix(key[looking] ^ symbol[looking])
        pointer += ((symbol * factors[:, step : step + 1]) >> np.uint64(63)).astype(np.int64)
        np.minimum(pointer, n, out=pointer)
    return key


def pieces(n: int, d: int) -> list[tuple[int, int]]:
    """(place, length) of the runs into which an item of n words is cut: one more than its edits."""
    cuts = [p * n // (d + 1) for p in range(d + 2)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:]) if b > a]


def run_hashes(h: np.ndarray, k: int, c: int, at: np.ndarray) -> np.ndarray:
    """A hash of the k words from each of these places on, for length class c."""
    acc = np.full(len(at), c * 1000 + k, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for j in range(k):
            acc = mix((acc * np.uint64(3)) ^ h[at + j])
    return acc


def distance(item: np.ndarray, window: np.ndarray) -> tuple[int, int]:
    """(edit distance, length) of the beginning of ``window`` that is nearest to ``item``: a column of the table
    is two numbers, whose bits are its steps up and down."""
    n, places = len(item), {}
    for i, symbol in enumerate(item.tolist()):
        places[symbol] = places.get(symbol, 0) | 1 << i
    full, top = (1 << n) - 1, 1 << (n - 1)
    up, down, score = full, 0, n
    best = (n, n, 0)  # distance, difference of lengths, length
    for end, symbol in enumerate(window.tolist(), 1):
        same = places.get(symbol, 0)
        across = ((same & up) + up ^ up) | same
        more, less = down | full & ~(across | up), up & across
        score += bool(more & top) - bool(less & top)
        more, less, kept = more << 1 | 1, less << 1, same | down
        up, down = (less | ~(kept | more)) & full, more & kept & full
        best = min(best, (score, abs(end - n), end))
    return best[0], best[2]


class Index:
    """What the tasks need of one block of items: word pairs by length class, and the items' keys."""

    def __init__(self, ids: pa.Array, texts: list[str | None], similarity: float):
        data = pa.RecordBatch.from_arrays([ids, pa.array(texts, pa.string())], ["doc_id", "text"])
        self.similarity, self.items = similarity, []
        for block in blocks([data]):
            words = Words(block)
            h = word_hashes(lowered(block.buf), words)
            for i in range(len(block)):
                if words.count[i]:
                    self.items.append((block.ids[i].as_py(), h[words.first[i] : words.first[i + 1]]))
        self.items.sort(key=lambda x: len(x[1]) < MIN_WORDS)  # short ones, which allow no edit, last
        whole = sum(len(h) >= MIN_WORDS for _, h in self.items)
        self.short_rows = [(len(h), int(run_hashes(h, len(h), _SHORT, np.zeros(1, np.int64))[0]), whole + k) for k, (_, h) in enumerate(self.items[whole:])]
        self.short = {n: np.unique(np.array([key for m, key, _ in self.short_rows if m == n], np.uint64)) for n in {x[0] for x in self.short_rows}}
        every, self.items = self.items, self.items[:whole]
        lengths = sorted({len(h) for _, h in self.items})
        step = -(-len(lengths) // CLASSES) if lengths else 1
        self.sizes = [lengths[min(i + step, len(lengths)) - 1] for i in range(0, len(lengths), step)]  # the longest of a class
        self.least = [min(least_pairs(n, similarity) for n in lengths[i : i + step]) for i in range(0, len(lengths), step)]
        pairs: dict[int, int] = {}
        for _, h in self.items:
            for g in mix(h[:-1] * np.uint64(3) ^ h[1:]).tolist():
                pairs[g] = pairs.get(g, 0) | 1 << self.class_of(len(h))
        self.pair = np.array(sorted(pairs), dtype=np.uint64)
        self.often = np.isin(self.pair, [g for _, h in self.items for g, n in zip(*np.unique(mix(h[:-1] * np.uint64(3) ^ h[1:]), return_counts=True), strict=True) if n > 1])
        self.mask = np.array([pairs[g] for g in self.pair.tolist()], dtype=np.uint64)
        self.slot = np.zeros(_SLOTS, dtype=bool)
        self.slot[(self.pair & np.uint64(_SLOTS - 1)).astype(np.int64)] = True
        self.stacks = [self.padded(c) for c in range(len(self.sizes))]
        self.item_keys = [walk_keys(np.stack([h for _, h in mine]), n) for mine, n in zip(self.stacks, self.sizes, strict=True)]
        self.keys = [np.unique(k) for k in self.item_keys]
        self.piece_rows: list[tuple] = []
        reach: list[dict] = [{} for _ in self.sizes]  # class: (length, key): where a window can have the piece
        for number, (_, h) in enumerate(self.items):
            c, d = self.class_of(len(h)), edits(len(h), similarity)
            for at, k in pieces(len(h), d):
                key = int(run_hashes(h, k, c, np.array([at]))[0])
                low, high = reach[c].get((k, key), (at - d, at + d))
                reach[c][k, key] = min(low, at - d), max(high, at + d)
                self.piece_rows.append((int(np.uint64(key).view(np.int64)), number))
        self.pieces = []  # by class: (length, keys, first places, last places)
        for found in reach:
            by_length: dict[int, list] = {}
            for (k, key), (low, high) in sorted(found.items()):
                by_length.setdefault(k, []).append((key, max(low, 0), high))
            self.pieces.append([(k, np.array([x[0] for x in v], np.uint64), np.array([x[1] for x in v]), np.array([x[2] for x in v])) for k, v in by_length.items()])
        self.items = every
        self.piece_rows += [(int(np.uint64(key).view(np.int64)), number) for _, key, number in self.short_rows]

    def class_of(self, n: int) -> int:
        return int(np.searchsorted(self.sizes, n))

    def padded(self, c: int) -> list[tuple[int, np.ndarray]]:
        n = self.sizes[c]
        return [(k, np.concatenate((h, np.full(n - len(h), _PAD, np.uint64)))) for k, (_, h) in enumerate(self.items) if len(h) >= MIN_WORDS and self.class_of(len(h)) == c]

    def rows(self) -> list[tuple]:
        """(key, item number) of every item's repetitions and pieces, the SQL side of the join."""
        return self.piece_rows + [(int(k), number) for mine, keys in zip(self.stacks, self.item_keys, strict=True) for row in keys.view(np.int64) for k, (number, _) in zip(row, mine, strict=True)]


def _piece_hits(index: Index, c: int, h: np.ndarray, words: Words, start: np.ndarray, cover: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of the start, key) of the pieces that the windows from these starts have near their places."""
    last = words.first[words.doc + 1]
    out_i, out_key = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    for k, keys, low, high in index.pieces[c]:
        if len(h) < k:
            continue
        place = cover[cover + k <= last[np.minimum(cover, len(h) - 1)]]
        if not len(place):
            continue
        key = run_hashes(h, k, c, place)
        at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
        same = keys[at] == key
        place, key, at = place[same], key[same], at[same]
        first = np.searchsorted(start, np.maximum(place - high[at], words.first[words.doc[place]]))
        size = np.maximum(np.searchsorted(start, place - low[at], "right") - first, 0)
        out_i.append(np.repeat(first - np.cumsum(size) + size, size) + np.arange(size.sum()))
        out_key.append(np.repeat(key, size))
    return np.concatenate(out_i), np.concatenate(out_key)


def _short_windows(index: Index, block, h: np.ndarray, words: Words):
    """Rows of the first place in each document of each short item's words."""
    for n, keys in index.short.items():
        at = np.flatnonzero(words.place + n <= words.count[words.doc])
        key = run_hashes(h, n, _SHORT, at)
        same = keys[np.minimum(np.searchsorted(keys, key), len(keys) - 1)] == key
        at, key = at[same], key[same]
        order = np.lexsort((at, key, words.doc[at]))
        at, key = at[order], key[order]
        first = np.ones(len(at), dtype=bool)
        first[1:] = (key[1:] != key[:-1]) | (words.doc[at][1:] != words.doc[at][:-1])
        at, key = at[first], key[first]
        yield pa.RecordBatch.from_arrays(
            [long_array(key.view(np.int64), np.ones(len(at), np.int64)), block.ids.take(pa.array(words.doc[at])), pa.array(words.place[at]), long_array(h[at[:, None] + np.arange(n)].ravel().view(np.int64), np.full(len(at), n))],
            ["keys", "doc_id", "start", "window"],
        )


def _windows(index: Index, batches):
    """Rows (keys, doc_id, start, window) of the windows that share a key with some item."""
    for block in blocks(batches):
        words = Words(block)
        if not len(words):
            continue
        h = word_hashes(lowered(block.buf), words)
        yield from _short_windows(index, block, h, words)
        if not index.sizes:
            continue
        pair = np.zeros(len(h), dtype=np.uint64)
        pair[:-1] = mix(h[:-1] * np.uint64(3) ^ h[1:])
        hit = np.flatnonzero(index.slot[(pair & np.uint64(_SLOTS - 1)).astype(np.int64)])
        at = np.minimum(np.searchsorted(index.pair, pair[hit]), len(index.pair) - 1)
        same = (index.pair[at] == pair[hit]) & (hit + 1 < words.first[words.doc[hit] + 1])
        # inside a run of one repeated pair that no item has twice, only the ends of the run can count
        inner = np.zeros(len(pair), dtype=bool)
        inner[1:-1] = (pair[1:-1] == pair[:-2]) & (pair[1:-1] == pair[2:])
        same &= ~inner[hit] | index.often[at]
        hit, mask = hit[same], index.mask[at[same]]
        for c, n in enumerate(index.sizes):
            own = hit[(mask >> np.uint64(c)) & np.uint64(1) == 1]
            least = index.least[c]
            if len(own) < least:
                continue
            # a window from s has the pairs at s to s + n - 2: it has enough if a run of `least` own pairs lies there
            last, first = own[least - 1 :], own[: len(own) - least + 1]
            begin, end = np.maximum(last - (n - 2), words.first[words.doc[last]]), np.minimum(first, words.first[words.doc[last] + 1] - 1)
            fits = (begin <= end) & (words.doc[first] == words.doc[last])
            if not fits.any():
                continue
            cover = np.zeros(len(h) + 1, dtype=np.int64)
            np.add.at(cover, begin[fits], 1)
            np.add.at(cover, end[fits] + 1, -1)
            start = np.flatnonzero(np.cumsum(cover[:-1]) > 0)
            reach = n + edits(n, index.similarity)
            grid = start[:, None] + np.arange(reach)
            inside = grid < words.first[words.doc[start] + 1][:, None]
            body = np.where(inside, h[np.minimum(grid, len(h) - 1)], _PAD)
            key = walk_keys(body[:, :n], n)
            shared = np.isin(key, index.keys[c])
            spread = np.zeros(len(h) + 1, dtype=np.int64)
            np.add.at(spread, start, 1)
            np.add.at(spread, np.minimum(start + reach, len(h)), -1)
            by_piece, piece_key = _piece_hits(index, c, h, words, start, np.flatnonzero(np.cumsum(spread[:-1]) > 0))
            repeat, by_walk = np.nonzero(shared)
            met, found = np.concatenate((by_walk, by_piece)), np.concatenate((key[repeat, by_walk], piece_key))
            order = np.argsort(met, kind="stable")
            there, many = np.unique(met, return_counts=True)
            if len(there):
                size = inside[there].sum(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [
                        long_array(found[order].view(np.int64), many),
                        block.ids.take(pa.array(words.doc[start[there]])),
                        pa.array(words.place[start[there]]),
                        long_array(body[there][inside[there]].view(np.int64), size),
                    ],
                    ["keys", "doc_id", "start", "window"],
                )


def _verified(similarity: float, batches):
    """Candidates with their exact distance.  An item word that the window lacks costs an edit, so a window that lacks
    too many is out without an alignment."""
    for b in batches:
        items, windows = b.column("item"), b.column("window")
        i_size, w_size = items.value_lengths().to_numpy(), windows.value_lengths().to_numpy()
        i_flat, w_flat = items.flatten().to_numpy().view(np.uint64), windows.flatten().to_numpy().view(np.uint64)
        i_row, w_row = np.repeat(np.arange(b.num_rows), i_size), np.repeat(np.arange(b.num_rows), w_size)
        own = lambda flat, row: mix(flat + row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))  # noqa: E731  a word of one candidate
        lacking = np.bincount(i_row, weights=~np.isin(own(i_flat, i_row), own(w_flat, w_row)), minlength=b.num_rows).astype(np.int64)
        i_end, w_end = np.cumsum(i_size), np.cumsum(w_size)
        out = []
        for i in range(b.num_rows):
            if lacking[i] > allowed(int(max(i_size[i], w_size[i])), similarity):
                out.append((int(lacking[i]), int(i_size[i]), 0.0))
                continue
            item, window = i_flat[i_end[i] - i_size[i] : i_end[i]], w_flat[w_end[i] - w_size[i] : w_end[i]]
            d, end = (0, len(item)) if np.array_equal(item, window[: len(item)]) else distance(item, window)
            out.append((d, end, 1 - d / max(len(item), end, 1)))
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), b.column("item_id"), b.column("start"), pa.array([x[1] for x in out], pa.int64()), pa.array([x[0] for x in out], pa.int64()), pa.array([x[2] for x in out], pa.float64())],
            ["doc_id", "item_id", "start_word", "n_words", "distance", "similarity"],
        )


def leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", similarity: float = SIMILARITY, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """(doc_id, item_id, start_word, n_words, distance, similarity): the best place of each item in each document that has it."""
    spark: SparkSession = docs.sparkSession
    kind, item_kind = docs.schema[id_col].dataType.simpleString(), items.schema[item_col].dataType.simpleString()
    texts = docs.filter(F.col(id_col).isNotNull()).select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    asked = items.filter(F.col(item_col).isNotNull() & F.col(item_text).isNotNull()).select(F.col(item_col).alias("item_id"), F.col(item_text).alias("text"))
    n_blocks = max(1, -(-asked.count() // block_items))
    out = None
    for k in range(n_blocks):
        part = asked.filter(F.pmod(F.xxhash64("item_id"), F.lit(n_blocks)) == k).orderBy("item_id").collect()
        index = Index(pa.array([r["item_id"] for r in part]), [r["text"] for r in part], similarity)
        keys = spark.createDataFrame(index.rows(), "key long, number int").distinct()
        known = spark.createDataFrame([(i, item_id, h.view(np.int64).tolist()) for i, (item_id, h) in enumerate(index.items)], f"number int, item_id {item_kind}, item array<long>")
        windows = texts.mapInArrow(partial(_windows, index), f"keys array<long>, doc_id {kind}, start long, window array<long>")
        candidates = windows.withColumn("key", F.explode("keys")).join(keys, "key").select("doc_id", "start", "number", "window", F.xxhash64("window").alias("content")).dropDuplicates(["doc_id", "start", "number", "content"])
        checked = candidates.join(known, "number").select("doc_id", "item_id", "start", "item", "window").mapInArrow(partial(_verified, similarity), f"doc_id {kind}, item_id {item_kind}, start_word long, n_words long, distance long, similarity double")
        found = checked.filter(F.col("similarity") >= similarity)
        best = found.groupBy("doc_id", "item_id").agg(F.max_by(F.struct("start_word", "n_words", "distance", "similarity"), F.struct("similarity", -F.col("start_word"))).alias("x")).select("doc_id", "item_id", "x.*")
        out = best if out is None else out.unionByName(best)
    return out


def decontaminate(docs: DataFrame, items: DataFrame, **kw) -> DataFrame:
    """The rows of ``docs`` without those in which an item was found; rows with a null id stay."""
    id_col = kw.get("id_col", "doc_id")
    return docs.join(leaks(docs, items, **kw).select(F.col("doc_id").alias(id_col)).distinct(), id_col, "left_anti").select(*docs.columns)
