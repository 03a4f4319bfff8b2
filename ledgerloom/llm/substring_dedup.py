"""Removal of passages that an earlier document also has: seed and extend.

Seeds are winnowed anchors: of every ``WINDOW`` consecutive words, the ``SEED`` consecutive
words with the smallest hash.  Equal windows choose equal anchors, so a window that two
documents share has a seed that both emit.  Seeds are joined across documents on their hash;
those of two or more documents are extended both ways, to all windows of the full length that
contain them, and a window is a repeat if a smaller document has the same one, by two independent
hashes of its words (96 bits, which no corpus is large enough to confuse by chance).  Overlapping
repeats merge into the maximal ones, whose words go.

Volumes stay in proportion to the words: pairs of documents are never formed, only the smallest
document of a seed or window is compared with.  Exact copies of a text are settled first.  A task
settles what its own block of documents shows: of a seed or window that several of its documents
have, one row per block goes to the shuffle under the common key, so a passage in a third of the
documents makes a group of a row per block, and the others' rows spread evenly.  A document that has
a seed or window several times sends it once, with its other places in a list.

Ids are integers.  Defined cases: a null text counts as empty; texts with fewer words than a window lose nothing;
a row with a null id loses nothing and takes nothing from others; an empty table gives no rows; very long texts
are read whole; equal rows, and different texts under one id, give a row each
and never count as earlier for one another; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.kernels import Words, blocks, gram_hashes, mix, tasks, word_hashes

WINDOW = 13
SEED = 5
_MAX = np.uint64(2**64 - 1)


def _sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """pick over each ``width`` consecutive values; the result is ``width - 1`` shorter."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out, have = pick(out[: len(out) - step], out[step:]), have + step
    return out


def anchors(h: np.ndarray, words: Words, seed: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(indexes, hashes) of the words that begin a winnowed seed."""
    span = window - seed + 1
    g, ok = gram_hashes(h, words, seed)
    if len(h) < window:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    whole = np.zeros(len(h), dtype=bool)
    whole[: len(h) - window + 1] = words.doc[: len(h) - window + 1] == words.doc[window - 1 :]
    least = np.zeros(len(h), dtype=np.uint64)
    least[: len(h) - span + 1] = _sliding(g, span, np.minimum)
    least[~whole] = 0
    # a seed is chosen if it is the smallest of one of the windows that contain it
    padded = np.concatenate((np.zeros(span - 1, np.uint64), least))
    chosen = ok & (_sliding(padded, span, np.maximum) == g) & (g > 0)
    at = np.flatnonzero(chosen)
    return at, g[at]


def _settled(g: np.ndarray, doc: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For the rows of a block: the smallest and largest id that has the row's hash."""
    order = np.lexsort((ids[doc], g))
    sorted_g, sorted_id = g[order], ids[doc][order]
    new = np.concatenate(([True], sorted_g[1:] != sorted_g[:-1])) if len(g) else np.zeros(0, bool)
    group = np.cumsum(new) - 1
    start = np.flatnonzero(new)
    last = np.concatenate((start[1:], [len(g)])) - 1 if len(g) else start
    least, most = np.empty(len(g), ids.dtype), np.empty(len(g), ids.dtype)
    least[order], most[order] = sorted_id[start][group], sorted_id[last][group]
    return least, most


def _labels(g: np.ndarray, check: np.ndarray) -> np.ndarray:
    """The same number for places that agree in both hashes."""
    order = np.lexsort((check, g))
    new = np.ones(len(g), dtype=np.int64)
    new[1:] = (g[order][1:] != g[order][:-1]) | (check[order][1:] != check[order][:-1])
    out = np.empty(len(g), dtype=np.int64)
    out[order] = np.cumsum(new)
    return out


def _rows(block, words: Words, at: np.ndarray, g: np.ndarray, check: np.ndarray, alone: np.ndarray, known: np.ndarray) -> pa.RecordBatch:
    """Rows (hash, check, doc_id, rid, place, more, known), one for each document and pair of hashes, with its first
    place and the others; rows that are ``alone`` get a hash of their own."""
    doc, place = words.doc[at], words.place[at].astype(np.int32)
    order = np.lexsort((place, check, g, doc))
    g, check, doc, place = g[order], check[order], doc[order], place[order]
    new = np.ones(len(g), dtype=bool)
    new[1:] = (g[1:] != g[:-1]) | (check[1:] != check[:-1]) | (doc[1:] != doc[:-1])
    start = np.flatnonzero(new)
    extra = np.diff(np.concatenate((start, [len(g)]))) - 1
    offsets = np.concatenate(([0], np.cumsum(extra))).astype(np.int32)
    more = pa.ListArray.from_arrays(pa.array(offsets), pa.array(place[~new]), mask=pa.array(extra == 0)) if len(start) else pa.array([], pa.list_(pa.int32()))
    row = pa.array(doc[start])
    rid = block.columns["rid"].take(row)
    own = mix(rid.to_numpy().view(np.uint64) + place[start].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    key = np.where(alone[order][start], own, g[start])
    return pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(check[start]), block.ids.take(row), rid, pa.array(place[start]), more, pa.array(known[order][start])], ["hash", "check", "doc_id", "rid", "place", "more", "known"])


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, seed: int = SEED, keep_text: bool = False) -> DataFrame:
    """Per row: doc_id, n_words, n_removed, kept_sha256 and, if asked for, the kept text."""
    kind = df.schema[id_col].dataType.simpleString()
    n = tasks(df.sparkSession)
    docs = df.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    keyed = docs.withColumn("rid", F.xxhash64("doc_id", "text"))
    by_row = keyed.repartition(n, "rid")  # read three times below, shuffled once

    hashed = keyed.filter("doc_id is not null").select("doc_id", "rid", F.unhex(F.md5("text")).alias("whole"))
    least = hashed.groupBy("whole").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).filter("least <> most")
    copies = hashed.join(least, "whole").filter("doc_id > least").select("rid").distinct().withColumn("copy", F.lit(True))
    marked = by_row.join(copies.hint("shuffle_hash"), "rid", "left")

    def emit_seeds(batches):
        # null ids go here: as a filter of the plan it would reach below by_row and have the texts shuffled once more
        for block in blocks((b.filter(b.column("doc_id").is_valid()) for b in batches), ("rid",)):
            words = Words(block)
            at, g = anchors(word_hashes(block.buf, words), words, seed, window)
            ids = block.ids.to_numpy()
            least, most = _settled(g, words.doc[at], ids)
            yield _rows(block, words, at, g, np.zeros(len(g), np.int32), ids[words.doc[at]] > least, least != most)

    schema = f"hash long, check int, doc_id {kind}, rid long, place int, more array<int>, known boolean"
    same = Window.partitionBy("hash", "check")
    every = F.flatten(F.collect_list(F.concat(F.array("place"), F.coalesce("more", F.array().cast("array<int>")))))
    seeds = marked.filter("copy is null").select("doc_id", "rid", "text").mapInArrow(emit_seeds, schema)
    shared = seeds.withColumns({"least": F.min("doc_id").over(same), "most": F.max("doc_id").over(same)}).filter("known or least <> most")
    hit = shared.groupBy("rid").agg(every.alias("places"))

    def extend(batches):
        for block in blocks(batches, ("rid", "places")):
            words = Words(block)
            h = word_hashes(block.buf, words)
            g, ok = gram_hashes(h, words, window, seed=1)
            check = gram_hashes(h, words, window, seed=2)[0].view(np.uint32)[::2].view(np.int32)
            places = block.columns["places"]
            at = places.flatten().to_numpy() + np.repeat(words.first[:-1], places.value_lengths().to_numpy())
            near = np.zeros(len(words) + 1, dtype=np.int64)
            low = np.maximum(at - (window - seed), words.first[words.doc[at]])
            np.add.at(near, low, 1)
            np.add.at(near, at + 1, -1)
            start = np.flatnonzero(ok & (np.cumsum(near[:-1]) > 0))
            ids = block.ids.to_numpy()
            least, _ = _settled(_labels(g[start], check[start]), words.doc[start], ids)
            later = ids[words.doc[start]] > least
            yield _rows(block, words, start, g[start], check[start], later, later)

    passages = by_row.join(hit.hint("shuffle_hash"), "rid").select("doc_id", "rid", "text", "places").mapInArrow(extend, schema)
    later = passages.withColumn("least", F.min("doc_id").over(same)).filter("known or doc_id > least")
    repeats = later.groupBy("rid").agg(every.alias("starts"))

    def cut(batches):
        for block in blocks(batches, ("copy", "starts")):
            words = Words(block)
            covered = np.zeros(len(words) + 1, dtype=np.int64)
            starts = block.columns["starts"]
            if len(starts) != starts.null_count:
                at = starts.flatten().to_numpy() + np.repeat(words.first[:-1], starts.value_lengths().fill_null(0).to_numpy())
                np.add.at(covered, at, 1)
                np.add.at(covered, at + window, -1)
            gone = np.cumsum(covered[:-1]) > 0
            out: dict[str, list] = {"n_words": [], "n_removed": [], "kept_sha256": [], "kept": []}
            for i, copy in enumerate(block.columns["copy"].to_pylist()):
                a, b = words.first[i], words.first[i + 1]
                every = block.bytes_of(i).split()
                lost = gone[a:b] | (copy is True and b - a >= window)
                left = b" ".join([w for w, x in zip(every, lost.tolist(), strict=True) if not x] if lost.any() else every)
                for k, v in zip(out, (int(b - a), int(lost.sum()), hashlib.sha256(left).hexdigest(), left.decode("utf-8", "replace") if keep_text else None), strict=True):
                    out[k].append(v)
            cols = [pa.array(out["n_words"], pa.int64()), pa.array(out["n_removed"], pa.int64()), pa.array(out["kept_sha256"], pa.string())] + [pa.array(out["kept"], pa.string())] * keep_text
            yield pa.RecordBatch.from_arrays([block.ids, *cols], ["doc_id", "n_words", "n_removed", "kept_sha256"] + ["kept_text"] * keep_text)

    result = f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * keep_text
    return marked.join(repeats.hint("shuffle_hash"), "rid", "left").select("doc_id", "text", "copy", "starts").mapInArrow(cut, result)
