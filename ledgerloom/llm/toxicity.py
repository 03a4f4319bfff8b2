"""Toxicity by noisy-channel deobfuscation: restore hidden spellings, then score the restored text.

Spans that look obfuscated (letters mixed with look-alike signs anywhere but for closing exclamation
marks, single letters set apart, letters drawn out, of any length) become character lattices: a sign may stand for a letter it resembles, be itself or be
noise, a separator may be a gap or nothing, a long run may be one or two letters.  Viterbi decoding
under a character trigram model picks the reading.  The trigram counts come from every document that
may train, summed in Spark.  The classifier is a logistic regression on the presence of words in the
restored text; it is fitted on at most ``SAMPLE`` labelled rows, whose copies share one weight, with
the ``FEATURES`` words that tell the classes apart best.

Defined cases: a null text counts as empty and gets the score of a text without known words, as an
empty one; without usable labels every score is the share of label 1 (0.5 without any); null labels
do not train; a null id never trains and is kept; repeated rows give a row each; contradicting labels
of one id both train; ties between words go to the first by name; empty tables give no rows; very
long texts and spans are read whole, in time linear in their length; other columns are ignored.
"""

from __future__ import annotations

import re
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.kernels import Words, blocks, fold_crc, gram_hashes, lowered, shared_dir, word_hashes

SAMPLE = 12_000
FEATURES = 256
STEPS = 300
RIDGE = 2.0
CACHED = 64  # readings of longer spans are not kept

# Letters that a sign is used for.
LOOKALIKE = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t"}
SUBSTITUTE, NOISE, GAP = -1.0, -4.0, -1.5  # log-probabilities of the channel

_SIZE = 28  # 0: not a letter, 1-26: a-z, 27: part of another letter
_CODE = np.zeros(256, dtype=np.int64)
_CODE[97:123] = np.arange(1, 27)
_CODE[128:] = 27
_WORD = re.compile(r"[^\W_]+")
_MIXED = re.compile(r"(?<![a-z0-9@$!|+])(?=[0-9@$!|+]*[a-z])(?=[a-z]*[0-9@$!|+])[a-z0-9@$!|+]*[a-z0-9@$|+]")
_APART = re.compile(r"(?<![^\W_])(?:[a-z0-9@$!|][ .*_-]){2,}[a-z0-9@$!|](?![^\W_])")
_DRAWN = re.compile(r"(?<![^\W_])[a-z]*([a-z])\1\1[a-z]*(?![^\W_])")
_SIGNS = re.compile(r"[0-9@$!|+][a-z]|[a-z][0-9@$|+]")
_LETTER = re.compile(r"[a-z]")
_TRIPLE = re.compile(r"([a-z])\1\1")


class CharModel:
    """Trigram log-probabilities over letters and the end of a word."""

    def __init__(self, counts: np.ndarray):
        c = counts.reshape(_SIZE, _SIZE, _SIZE).astype(float)
        uni = c.sum(axis=(0, 1)) + 1.0
        two = c.sum(axis=0) + 5.0 * uni / uni.sum()
        two /= two.sum(axis=1, keepdims=True)
        three = c + 5.0 * two[None]
        three /= three.sum(axis=2, keepdims=True)
        self.log = np.log(three).reshape(_SIZE * _SIZE, _SIZE).tolist()


def count_chars(df: DataFrame, text_col: str = "text") -> np.ndarray:
    """Counts of the trigrams inside each row's text."""

    def run(batches):
        total = np.zeros(_SIZE**3, dtype=np.int64)
        for block in blocks(batches):
            code = _CODE[lowered(block.buf)]
            if len(code) > 2:
                inside = np.ones(len(code), dtype=bool)  # all three bytes are in one document
                border = block.offs[1:]
                inside[np.maximum(np.concatenate((border - 1, border - 2)), 0)] = False
                inside[-2:] = False
                inside[0] = block.offs[1] > 2
                at = np.flatnonzero(inside)
                total += np.bincount(code[at] * _SIZE**2 + code[at + 1] * _SIZE + code[at + 2], minlength=_SIZE**3)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["gram", "n"])

    out = np.zeros(_SIZE**3, dtype=np.int64)
    rows = df.select(F.lit(0).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    for r in rows.collect():  # at most 28 to the third rows
        out[r["gram"]] = r["n"]
    return out


def _options(span: str) -> list[list[tuple[str, float]]]:
    """The lattice: for each place, the strings it may stand for and their log-probabilities."""
    out, i = [], 0
    while i < len(span):
        ch, n = span[i], 1
        while i + n < len(span) and span[i + n] == ch:
            n += 1
        if "a" <= ch <= "z":
            out.append([(ch, 0.0)] if n == 1 else [(ch * 2, 0.0), (ch, SUBSTITUTE)] if n == 2 else [(ch, 0.0), (ch * 2, SUBSTITUTE)])
        elif ch in LOOKALIKE:
            out.append([(c * min(n, 2), SUBSTITUTE) for c in LOOKALIKE[ch]] + [("", NOISE), (" ", NOISE)])
        else:
            out.append([("", 0.0), (" ", GAP)])
        i += n
    return out


def decode(span: str, model: CharModel) -> str:
    """The likeliest reading of an obfuscated span."""
    best: dict[int, tuple[float, tuple]] = {0: (0.0, ())}  # the reading as its last piece and what stands before
    log = model.log
    for options in [*_options(span), [(" ", 0.0)]]:
        after: dict[int, tuple[float, tuple]] = {}
        for state, (score, read) in best.items():
            for piece, cost in options:
                s, total = state, score + cost
                for ch in piece:
                    k = 0 if ch == " " else ord(ch) - 96
                    total += log[s][k]
                    s = s % _SIZE * _SIZE + k
                if s not in after or total > after[s][0]:
                    after[s] = (total, (piece, read))
        best = after
    read, out = best[max(best, key=lambda s: (best[s][0], -s))][1], []
    while read:
        out.append(read[0])
        read = read[1]
    return "".join(reversed(out)).strip()


def restorer(model: CharModel):
    """A function from a text to its lower-cased, restored form."""
    cached = lru_cache(1 << 16)(lambda span: decode(span, model))

    def read(m: re.Match) -> str:
        span = m[0]
        if not _LETTER.search(span):  # a plain number
            return span
        return f"{span} {cached(span) if len(span) <= CACHED else decode(span, model)}"  # the span stays, so nothing is lost

    def restore(text: str) -> str:
        text = text.lower()
        if _TRIPLE.search(text):
            text = _DRAWN.sub(read, text)
        if _SIGNS.search(text):
            text = _MIXED.sub(read, text)
        return _APART.sub(read, text)

    return restore


def words_of(text: str | None, restore) -> set[str]:
    return set(_WORD.findall(restore(text or "")))


def _features(counts: np.ndarray, batches):
    """Rows (toxic, family, words): a family is texts that share their smallest shingle."""
    restore = restorer(CharModel(counts))
    for block in blocks(batches, ("toxic",)):
        words = Words(block)
        g, ok = gram_hashes(word_hashes(lowered(block.buf), words), words, 5)
        g[~ok] = 2**64 - 1
        family = [int(g[a:b].min()) % 2**63 if b > a else 0 for a, b in zip(words.first[:-1], words.first[1:], strict=True)]
        found = [sorted(words_of(block.bytes_of(i).decode("utf-8", "replace"), restore)) for i in range(len(block))]
        yield pa.RecordBatch.from_arrays([block.columns["toxic"], pa.array(family, pa.int64()), pa.array(found, pa.list_(pa.string()))], ["toxic", "family", "words"])


class Classifier:
    """Word weights, a bias and the character model."""

    def __init__(self, counts: np.ndarray, weights: dict[str, float], bias: float):
        self.counts, self.weights, self.bias = counts, weights, bias


def _fit(rows: list, names: list[str]) -> tuple[np.ndarray, float]:
    x = np.zeros((len(rows), len(names)), dtype=np.float32)
    place = {w: i for i, w in enumerate(names)}
    for i, r in enumerate(rows):
        x[i, [place[w] for w in r["words"]]] = 1
    y, weight = np.array([float(r["toxic"]) for r in rows]), np.array([r["weight"] for r in rows])
    w, b = np.zeros(len(names)), float(np.log((weight @ y + 1) / (weight @ (1 - y) + 1)))
    m1, m2, c1, c2 = np.zeros(len(names)), np.zeros(len(names)), 0.0, 0.0
    for step in range(1, STEPS + 1):
        p = 1 / (1 + np.exp(-np.clip(x @ w + b, -30, 30)))
        e = weight * (p - y)
        g, gb = x.T @ e + RIDGE * w * 0.1, float(e.sum())
        m1, m2, c1, c2 = 0.9 * m1 + 0.1 * g, 0.99 * m2 + 0.01 * g * g, 0.9 * c1 + 0.1 * gb, 0.99 * c2 + 0.01 * gb * gb
        f1, f2 = 1 - 0.9**step, 1 - 0.99**step
        w -= 0.1 * (m1 / f1) / (np.sqrt(m2 / f2) + 1e-8)
        b -= 0.1 * (c1 / f1) / (np.sqrt(c2 / f2) + 1e-8)
    return w, b


def train(df: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Classifier:
    """A classifier from the labelled rows whose id satisfies ``learn`` (a condition on ``doc_id``)."""
    spark = df.sparkSession
    texts = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).filter(learn & F.col("doc_id").isNotNull())
    counts = count_chars(texts)
    marks = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("toxic")).filter(learn & F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1))
    chosen = marks.orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(SAMPLE).collect()
    if not chosen:
        return Classifier(counts, {}, 0.0)
    known = spark.createDataFrame([tuple(r) for r in chosen], marks.schema)
    rows = texts.join(F.broadcast(known), "doc_id").mapInArrow(partial(_features, counts), "toxic int, family long, words array<string>")
    rows = rows.withColumn("weight", 1 / F.count("*").over(Window.partitionBy("family"))).checkpoint()
    total = rows.agg(F.sum("weight").alias("n"), F.sum(F.col("weight") * F.col("toxic")).alias("n1")).first()
    if not total["n"]:
        return Classifier(counts, {}, 0.0)
    n, n1 = total["n"], total["n1"]
    each = rows.select("toxic", "weight", F.explode("words").alias("word")).groupBy("word").agg(F.sum("weight").alias("k"), F.sum(F.col("weight") * F.col("toxic")).alias("k1"))
    cells = [("k1", "k", n1), ("(k - k1)", "k", n - n1), (f"({n1} - k1)", f"({n} - k)", n1), (f"({n - n1} - (k - k1))", f"({n} - k)", n - n1)]
    score = " + ".join(f"if({a} > 1e-9, {a} * ln({a} * {n} / ({b} * {c})), 0)" for a, b, c in cells) if 0 < n1 < n else "0"
    names = sorted(r["word"] for r in each.filter("k >= 2").withColumn("gain", F.expr(score)).orderBy(F.desc("gain"), "word").limit(FEATURES).collect())
    data = rows.select("toxic", "weight", F.array_intersect("words", F.array([F.lit(w) for w in names]).cast("array<string>")).alias("words")).collect()
    w, b = _fit(data, names)
    return Classifier(counts, dict(zip(names, w.tolist(), strict=True)), b)


def predict(df: DataFrame, model: Classifier, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score (the probability of label 1) of each row."""

    def run(model, batches):
        restore, weights, names = restorer(CharModel(model.counts)), model.weights, frozenset(model.weights)
        for batch in batches:
            scores = [1 / (1 + np.exp(-max(-30.0, min(30.0, model.bias + sum(weights[w] for w in sorted(names & words_of(t.as_py(), restore))))))) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], ["doc_id", "score"])

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(partial(run, model), f"doc_id {kind}, score double")


def classify(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """doc_id, held_out, score, predicted: rows whose crc32 of the id is 0 modulo 5 never train."""
    shared_dir(df.sparkSession)
    model = train(df, labels, fold_crc("doc_id", 5) != 0, id_col, text_col, label_col)
    return predict(df, model, id_col, text_col).select("doc_id", (fold_crc("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
