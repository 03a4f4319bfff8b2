"""Collocations by suffix counting: the words from each place on, ``max_n`` at most, are shuffled by language and
first word, sorted in reverse order, and all their prefixes are counted in one pass that keeps one open prefix for
each length (the stack).  Phrases of ``least`` occurrences then meet the counts of their parts in joins.

A block of texts counts its equal suffixes before the shuffle.  A first word may hold a third of all suffixes, so a
prefix that holds over 1/``HOT`` of a sample of ``SAMPLE`` texts is split: suffixes under a hot word are dealt by the
word after it, under a hot pair by the one after that, and so on; hot whole suffixes are dealt by task.  The counts
of hot prefixes (at most ``HOT`` of each length) come in parts and are summed afterwards; every other prefix lies in one
place and is dropped there if it is rare.  The sample decides where rows go and no count.  In the joins, parts that
are hot meet a broadcast of the hot counts, all others a shuffle.

A suffix is language and words, joined by tabs; bytes below the tab are written as a blank and the byte plus 32 there
(no word holds a blank), so the tab is the smallest byte and equal words stay together in the order.  Long texts are cut into
runs of ``RUN`` bytes that look ``max_n - 1`` words ahead.  All counts are exact: words are compared as bytes, scores
are decimals.

Defined cases: null texts are empty, a null language is ``und``; empty texts and texts of separators count nothing;
repeated rows count each; ties in score and count go to the smaller phrase by UTF-8 bytes; an empty table gives no rows;
other columns are ignored.  Counts must stay below 10^15.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.kernels import Block, blocks, lowered, mix, shared_dir

HOT = 512
SAMPLE = 4_000
SAMPLE_TASKS = 4
RUN = 4 << 20
_PIECE = b".,;:!?\n\x0b\x0c\r"
_BLANK = b" \t"
_KIND = np.zeros(256, dtype=np.uint8)  # 0 part of a word, 1 between words, 2 between pieces
_KIND[list(_BLANK)], _KIND[list(_PIECE)] = 1, 2
_TAB = 9


def _runs(block: Block, ahead: int) -> Iterator[tuple[Block, np.ndarray]]:
    """The block, or runs of its one long text, with the ends of what each counts; what follows is only looked at."""
    if len(block) > 1 or len(block.buf) <= RUN:
        if len(block.buf):
            yield block, block.offs[1:]
        return
    data = block.buf.tobytes()
    word, more = re.compile(rb"[^ \t.,;:!?\n-\r]*"), re.compile(rb"(?:[ \t]+[^ \t.,;:!?\n-\r]+){0,%d}" % ahead)
    start = 0
    while start < len(data):
        cut = word.match(data, min(start + RUN, len(data))).end()
        end = more.match(data, cut).end()
        yield Block(block.ids, block.buf[start:end], np.array([0, end - start]), block.columns), np.array([cut - start])
        start = cut


def _escaped(words: pa.Array) -> pa.Array:
    """Bytes below the tab, tabs and blanks (in languages) written as two bytes above it."""
    return pa.array([re.sub(rb"[\x00-\x09 ]", lambda m: bytes((32, m[0][0] + 32)), w) for w in words.to_pylist()], pa.binary())


def _unescaped(word: bytes) -> bytes:
    return re.sub(rb" (.)", lambda m: bytes((m[1][0] - 32,)), word, flags=re.S) if b" " in word else word


def suffixes(block: Block, ends: np.ndarray, max_n: int) -> Iterator[tuple[bytes, pa.Array, np.ndarray, np.ndarray]]:
    """For each language: (language, its distinct words, their numbers from 1 in each distinct suffix with 0 behind its end, counts)."""
    buf = lowered(block.buf)
    kind = _KIND[buf]
    solid = kind == 0
    edge = np.zeros(len(buf) + 1, dtype=bool)
    edge[block.offs] = True
    before, after = np.zeros(len(buf), bool), np.zeros(len(buf), bool)
    before[1:], after[:-1] = solid[:-1], solid[1:]
    start = np.flatnonzero(solid & (~before | edge[:-1]))
    if not len(start):
        return
    end = np.flatnonzero(solid & (~after | edge[1:])) + 1
    doc = np.searchsorted(block.offs, start, "right") - 1
    piece = np.cumsum(kind == 2)[start]
    offs = np.zeros(len(start) + 1, dtype=np.int64)
    np.cumsum(end - start, out=offs[1:])
    words = pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(offs), pa.py_buffer(np.ascontiguousarray(buf[solid]))]).dictionary_encode()
    own, number = words.dictionary.cast(pa.binary()), words.indices.to_numpy(zero_copy_only=False).astype(np.int64) + 1
    if len(buf) and (buf < _TAB).any():
        own = _escaped(own)
    places = np.zeros((max_n, len(start)), dtype=np.int64)
    places[0] = number
    for k in range(1, max_n):
        same = (doc[k:] == doc[:-k]) & (piece[k:] == piece[:-k])
        places[k, : len(same)] = np.where(same, number[k:], 0)
    counted = start < ends[doc]
    langs = block.columns["lang"].fill_null("und").cast(pa.binary()).dictionary_encode()
    of_doc, names = langs.indices.to_numpy(zero_copy_only=False), _escaped(langs.dictionary).to_pylist()
    of_word, size = of_doc[doc], len(own) + 1
    for g in np.unique(of_doc).tolist():
        mine = places[:, counted & (of_word == g)]
        if not mine.shape[1]:
            continue
        key, most = mine[0], size
        for k in range(1, max_n):
            if most * size >= 2**63:
                values, key = np.unique(key, return_inverse=True)
                most = len(values)
            key, most = key * size + mine[k], most * size
        _, first, count = np.unique(key, return_index=True, return_counts=True)
        yield names[g], own, mine[:, first], count


def _joined(lang: bytes, words: pa.Array, numbers: np.ndarray) -> pa.Array:
    parts = [words.take(pa.array(n - 1, mask=n == 0)) for n in numbers]
    first = pc.binary_join_element_wise(pa.scalar(lang, pa.binary()), parts[0], pa.scalar(b"\t", pa.binary()))
    return pc.binary_join_element_wise(first, *parts[1:], pa.scalar(b"\t", pa.binary()), null_handling="skip") if len(parts) > 1 else first


def _deal(lang: bytes, words: pa.Array, numbers: np.ndarray, hot: list[set[bytes]], task: int) -> tuple[np.ndarray, np.ndarray]:
    """Where each suffix goes, by language and first word and under hot prefixes by the words behind them too; and the
    number of its leading words that are a hot prefix."""
    own, n = words.to_pylist(), numbers.shape[1]
    crc = np.array([task, *(zlib.crc32(w) for w in own)], dtype=np.uint64)  # what ends with a hot prefix goes by task
    level, parent = np.zeros(n, dtype=np.int32), np.ones(n, dtype=np.int64)
    numbered, at = {(): 1}, {w: i + 1 for i, w in enumerate(own)} if any(hot) else {}
    with np.errstate(over="ignore"):
        place = mix(crc[numbers[0]] + np.uint64(zlib.crc32(lang)) * np.uint64(0x9E3779B97F4A7C15))
        for k, known in enumerate(hot):
            keys = {}
            for prefix in known:
                first, *rest = prefix.split(b"\t")
                if first == lang and tuple(rest[:-1]) in numbered and rest[-1] in at:
                    numbered[tuple(rest)] = len(numbered) + 1
                    keys[numbered[tuple(rest[:-1])] * (len(own) + 1) + at[rest[-1]]] = len(numbered)
            if not keys:
                break
            order = np.array(sorted(keys), dtype=np.int64)
            key = parent * (len(own) + 1) + numbers[k]
            found = order[np.minimum(np.searchsorted(order, key), len(order) - 1)] == key
            found &= (level == k) & (numbers[k] > 0)
            level[found] = k + 1
            parent[found] = [keys[x] for x in key[found].tolist()]
            behind = crc[numbers[k + 1]] if k + 1 < len(numbers) else np.full(n, task, dtype=np.uint64)
            place = np.where(found, mix(place * np.uint64(3) + behind), place)
    return place.view(np.int64), level


def _map(batches: Iterable[pa.RecordBatch], max_n: int, hot: list[set[bytes]]) -> Iterator[pa.RecordBatch]:
    task = TaskContext.get().partitionId()
    for whole in blocks(batches, ("lang",), RUN):
        for block, ends in _runs(whole, max_n - 1):
            for lang, words, numbers, count in suffixes(block, ends, max_n):
                h, level = _deal(lang, words, numbers, hot, task)
                yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(level), _joined(lang, words, numbers), pa.array(count)], names=["h", "hot", "suffix", "c"])


def _sampled(batches: Iterable[pa.RecordBatch], max_n: int) -> Iterator[pa.RecordBatch]:
    """All prefixes that hold over 1 / (8 HOT) of a block, with the block's number of words as the empty one."""
    for whole in blocks(batches, ("lang",), RUN):
        total, out, sizes = 0, [], []
        for block, ends in _runs(whole, max_n - 1):
            for lang, words, numbers, count in suffixes(block, ends, max_n):
                total += int(count.sum())
                live, group = np.arange(numbers.shape[1]), np.zeros(numbers.shape[1], dtype=np.int64)
                for k in range(max_n):
                    there = numbers[k, live] > 0
                    live, group = live[there], group[there]
                    if not len(live):
                        break
                    _, first, group = np.unique(group * (len(words) + 1) + numbers[k, live], return_index=True, return_inverse=True)
                    sums = np.bincount(group, weights=count[live])
                    large = sums * 8 * HOT >= count.sum()
                    out += _joined(lang, words, numbers[: k + 1, live[first[large]]]).to_pylist()
                    sizes += sums[large].astype(np.int64).tolist()
                    live, group = live[large[group]], group[large[group]]
        yield pa.RecordBatch.from_arrays([pa.array([b"", *out], pa.binary()), pa.array([total, *sizes], pa.int64())], names=["prefix", "c"])


def _hot(docs: DataFrame, max_n: int) -> list[set[bytes]]:
    """By length, the prefixes that hold over 1/HOT of a sample of texts: at most HOT of each length."""
    count = docs.count()
    some = docs if count <= SAMPLE else docs.sample(SAMPLE / count, seed=11)
    some = some.repartition(SAMPLE_TASKS)  # shares are taken of large blocks, however the table is cut
    sums = some.mapInArrow(partial(_sampled, max_n=max_n), "prefix binary, c long").groupBy("prefix").agg(F.sum("c").alias("c")).checkpoint()
    total = sums.filter(F.length("prefix") == 0).agg(F.sum("c")).first()[0] or 0
    rows = sums.filter((F.length("prefix") > 0) & (F.col("c") * HOT >= total)).collect() if total else []
    out: list[set[bytes]] = [set() for _ in range(max_n)]
    for r in rows:
        out[bytes(r[0]).count(b"\t") - 1].add(bytes(r[0]))
    return out


def _count(batches: Iterable[pa.RecordBatch], max_n: int, least: int) -> Iterator[pa.RecordBatch]:
    """Counts of the prefixes of sorted suffixes; prefix 0 is the language alone.  ``open_`` is the stack: the last
    prefix of each length, its count so far and whether it is counted in parts, closed when a suffix without it comes."""
    open_: list[tuple] = [(None, 0, False)] * (max_n + 1)

    def close(words: list[bytes], counts: list[int], prefix: bytes | None, n: int, in_parts: bool) -> None:
        if prefix is not None and (n >= least or in_parts):
            words.append(prefix)
            counts.append(n)

    def batch(words: list[bytes], counts: list[int]) -> pa.RecordBatch:
        parts = [w.split(b"\t") for w in words]
        lang = pa.array([_unescaped(p[0]) for p in parts], pa.binary()).cast(pa.string())
        phrase = pa.array([b" ".join(map(_unescaped, p[1:])) for p in parts], pa.binary()).cast(pa.string())
        return pa.RecordBatch.from_arrays([lang, phrase, pa.array([len(p) - 1 for p in parts], pa.int32()), pa.array(counts, pa.int64())], names=["lang", "phrase", "words", "c"])

    for rows in batches:
        suffix = rows.column("suffix").cast(pa.large_binary())
        c, hot, n = rows.column("c").to_numpy(), rows.column("hot").to_numpy(), rows.num_rows
        if not n:
            continue
        offs = np.frombuffer(suffix.buffers()[1], dtype=np.int64)[suffix.offset : suffix.offset + n + 1]
        buf = np.frombuffer(suffix.buffers()[2], dtype=np.uint8)[offs[0] : offs[-1]]
        offs = offs - offs[0]
        size = np.diff(offs)
        tabs = np.flatnonzero(buf == _TAB)
        first = np.searchsorted(tabs, offs)
        length = np.diff(first)  # tabs in a row: its number of words
        # bytes that a row has in common with the one before it
        shared = np.minimum(size[1:], size[:-1])
        at = np.zeros(n, dtype=np.int64)
        np.cumsum(shared, out=at[1:])
        row = np.repeat(np.arange(n - 1), shared)
        step = np.arange(at[-1]) - at[row]
        differ = np.where(buf[offs[row] + step] != buf[offs[row + 1] + step], step, 1 << 40)
        common = np.zeros(n, dtype=np.int64)
        if len(step):
            full = shared > 0
            common[1:][full] = np.minimum(np.minimum.reduceat(differ, at[:-1][full]), shared[full])
        words, counts = [], []
        for k in range(max_n + 1):
            has = np.flatnonzero(length >= k)
            if not len(has):
                continue
            stop = first[has] + k
            longer = length[has] > k
            ends = np.where(longer, tabs[np.minimum(stop, len(tabs) - 1)] - offs[has], size[has])
            # rows with a prefix of length k that share it are neighbours among all rows
            fresh = np.ones(len(has), dtype=bool)
            near = has[1:] == has[:-1] + 1
            fresh[1:] = ~(near & (ends[1:] == ends[:-1]) & (common[has[1:]] >= ends[1:]))
            runs = np.flatnonzero(fresh)
            sums, head, tail = np.add.reduceat(c[has], runs), offs[has[runs]], offs[has[runs]] + ends[runs]
            in_parts = hot[has[runs]] >= k
            at_first, at_last = (buf[head[i] : tail[i]].tobytes() for i in (0, -1))
            if at_first == open_[k][0]:
                sums[0] += open_[k][1]
            else:
                close(words, counts, *open_[k])
            for r in np.flatnonzero((sums[:-1] >= least) | in_parts[:-1]).tolist():
                close(words, counts, buf[head[r] : tail[r]].tobytes(), int(sums[r]), True)
            open_[k] = (at_last, int(sums[-1]), bool(in_parts[-1]))
        if words:
            yield batch(words, counts)
    words, counts = [], []
    for last in open_:
        close(words, counts, *last)
    if words:
        yield batch(words, counts)


def phrase_counts(docs: DataFrame, max_n: int = 3, least: int = 10) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, words, c) of all phrases of 1 to ``max_n`` words with ``least`` occurrences, and of each language
    (phrase empty, words 0: its number of words); and the part of it that may be in many phrases (HOT of a length)."""
    spark = docs.sparkSession
    shared_dir(spark)
    texts = docs.select("doc_id", "text", F.col("lang").cast("string").alias("lang"))
    hot = _hot(texts, max_n)
    rows = texts.mapInArrow(partial(_map, max_n=max_n, hot=hot), "h long, hot int, suffix binary, c long")
    ordered = rows.repartition("h").select("hot", "suffix", "c").sortWithinPartitions(F.desc("suffix"))
    parts = ordered.mapInArrow(partial(_count, max_n=max_n, least=least), "lang string, phrase string, words int, c long")
    counts = parts.groupBy("lang", "phrase", "words").agg(F.sum("c").alias("c")).filter((F.col("c") >= least) | (F.col("words") == 0)).checkpoint()
    keys = [tuple(_unescaped(w).decode() for w in p.split(b"\t")) for known in hot for p in known]
    named = spark.createDataFrame([(k[0], " ".join(k[1:])) for k in keys], "lang string, phrase string")
    return counts, counts.join(F.broadcast(named), ["lang", "phrase"], "left_semi")


def _with_count(rows: DataFrame, part: str, out: str, counts: DataFrame, hot: DataFrame) -> DataFrame:
    """``out``: the count of the phrase in column ``part``.  Many rows may share a hot part, so those meet a broadcast."""
    of = lambda table: table.select("lang", F.col("phrase").alias(part), F.col("c").alias(out))
    met = rows.join(F.broadcast(of(hot)), ["lang", part], "left")
    rest = met.filter(F.col(out).isNull()).drop(out).join(of(counts), ["lang", part])
    return met.filter(F.col(out).isNotNull()).unionByName(rest)


def _piece(first: Column, size: Column) -> Column:
    return F.array_join(F.slice(F.split("phrase", " "), first, size), " ")


def collocations(docs: DataFrame, max_n: int = 3, least: int = 10, share: int = 50, top: int = 2000) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of each language's ``top`` phrases of 2 to ``max_n`` words.

    A phrase is as strong as its weakest cut.  Phrases inside a longer one with ``share`` hundredths of their count go.
    """
    counts, hot = phrase_counts(docs, max_n, least)
    known = counts.filter("words > 1").withColumnRenamed("c", "a")
    k, size = F.col("k"), F.col("words")
    cuts = known.select("*", F.explode(F.sequence(F.lit(1), size - 1)).alias("k")).select("*", _piece(F.lit(1), k).alias("head"), _piece(k + 1, size - k).alias("tail"))
    both = _with_count(_with_count(cuts, "head", "l", counts, hot), "tail", "r", counts, hot)
    exact = "1000000BD * (cast(a AS DECIMAL(15,0)) * cast(a AS DECIMAL(15,0))) div (cast(l AS DECIMAL(15,0)) * cast(r AS DECIMAL(15,0)))"
    weakest = both.withColumn("score", F.expr(exact)).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("w"))
    inside = known.filter("words > 2").select("lang", "phrase", "words", "a", F.explode(F.sequence(F.lit(2), size - 1)).alias("m"))
    inside = inside.select("*", F.explode(F.sequence(F.lit(1), size - F.col("m") + 1)).alias("at")).select("lang", _piece(F.col("at"), F.col("m")).alias("inner"), "a")
    cover = inside.groupBy("lang", F.col("inner").alias("phrase")).agg(F.max("a").alias("cover"))
    left = weakest.join(cover, ["lang", "phrase"], "left").filter(F.col("cover").isNull() | (F.col("cover") * 100 < F.col("a") * share))
    left = left.select("lang", "phrase", "a", "w.l", "w.r", "w.score")
    best = (F.desc("score"), F.desc("a"), F.asc("phrase"))
    some = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(32))).orderBy(*best)  # a language may hold most phrases
    few = left.withColumn("rank", F.row_number().over(some)).filter(F.col("rank") <= top)
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("long")).filter(F.col("rank") <= top)
    total = counts.filter("words = 0").select("lang", F.col("c").alias("n"))
    return ranked.join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


ORACLE = r"""
WITH p AS (
  SELECT lang, pid, regexp_extract_all(piece, '[^\x20\x09]+') AS w
  FROM (SELECT lang, row_number() OVER () AS pid, piece FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents))),
g AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM p),
s AS (SELECT lang, len(q) AS m, array_to_string(q, ' ') AS phrase, count(*) AS f FROM (
  SELECT lang, w[i:i] AS q FROM g UNION ALL SELECT lang, w[i:i + 1] FROM g WHERE i < len(w) UNION ALL SELECT lang, w[i:i + 2] FROM g WHERE i + 1 < len(w)) GROUP BY ALL),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM s WHERE m = 1 GROUP BY lang),
c AS (SELECT lang, m, phrase, string_split(phrase, ' ') AS q, f AS a FROM s WHERE m > 1 AND f >= 10),
k AS (SELECT lang, phrase, q, m, a, unnest(range(1, m)) AS k FROM c),
j AS (
  SELECT k.lang, k.phrase, k.m, k.a, k.k, x.f AS l, y.f AS r, (1000000::HUGEINT * k.a * k.a // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM k JOIN s x ON x.lang = k.lang AND x.phrase = array_to_string(k.q[1:k.k], ' ') JOIN s y ON y.lang = k.lang AND y.phrase = array_to_string(k.q[k.k + 1:], ' ')),
b AS (SELECT * FROM j QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
o AS (SELECT lang, phrase, max(a) AS cover FROM (
  SELECT lang, array_to_string(q[1:2], ' ') AS phrase, a FROM c WHERE m = 3 UNION ALL SELECT lang, array_to_string(q[2:3], ' '), a FROM c WHERE m = 3) GROUP BY ALL)
SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS "rank", b.phrase, a, l, r, n, score
FROM b JOIN n USING (lang) LEFT JOIN o ON o.lang = b.lang AND o.phrase = b.phrase
WHERE o.cover IS NULL OR 100 * o.cover < 50 * a
QUALIFY row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) <= 2000
"""
