"""Language-model scores by Katz backoff over words.

Words are lower-cased; each text ends with one end token, which is also the history of a text's first
word.  Unigrams and bigrams of all words have Good-Turing discounted counts.  What the discounts free
goes to the unseen class for unigrams, and for bigrams to the unigrams that a history was not seen
with; so the vocabulary and the unseen class have a probability of one together, after every history.

Texts are dealt into batches of about ``BATCH_BYTES``.  Each batch sends its distinct words and bigrams,
with their counts in its training texts, to partitions by the n-gram's hash, once however often it has
them: a word pair that all texts share is one entry a batch.  The partitions sum the counts, give the
counts of counts, and answer each batch.  One batch of those that train a bigram counts it for its
history's free and seen mass; these sums meet in partitions by history, which answer the backoff weights.
Batches and partitions have bounded size, as their number follows the corpus, and what is sent is in
proportion to the input.  Words are told apart by 64 bits, bigrams by their partition and 40 bits more,
so that one in about 500,000 is taken for another at any corpus size; histories likewise, for their weights alone.

Defined cases: a null text counts as empty, and an empty text is one end token; a null id never trains
and is scored; equal rows train as often as they occur and give a row each; without training texts
every word is unseen; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.kernels import Words, blocks, fold_crc, lowered, mix, word_hashes

K = 5  # counts above this are not discounted
BATCH_BYTES = 14 << 20  # about so much text makes a batch, and its n-grams a partition
_WORD, _GRAM = 8, 5  # bytes of a key
_END = np.uint64(0x656E64)
_HISTORY = np.uint64(0x9E3779B97F4A7C15)


def discounts(n: np.ndarray) -> np.ndarray:
    """Factors for counts 1 to K from counts of counts n[0] (of 1) to n[K]: Good-Turing with Katz's
    correction, or absolute discounting where that is not between zero and one."""
    n = np.asarray(n, dtype=float)
    r = np.arange(1, K + 1)
    if (n[: K + 1] > 0).all():
        tail = (K + 1) * n[K] / n[0]
        d = ((r + 1) * n[1 : K + 1] / (r * n[:K]) - tail) / (1 - tail) if tail < 1 else np.zeros(K)
        if ((d > 0) & (d < 1)).all():
            return d
    gap = min(0.9, max(0.1, n[0] / (n[0] + 2 * n[1]))) if n[0] + n[1] > 0 else 0.5
    return (r - gap) / r


class Model:
    """What all partitions' counts of counts say: discounts of both orders and the unseen class's share."""

    def __init__(self, tokens: int, types: int, word_of: np.ndarray, gram_of: np.ndarray):
        self.tokens, self.types = tokens, types
        words, grams = discounts(word_of), discounts(gram_of)
        freed = float(((1 - words) * np.arange(1, K + 1) * word_of[:K]).sum())
        self.scale = 1.0 / tokens if freed else 1.0 / (tokens + 1)  # nothing freed: one count is kept back
        self.unseen = (freed or 1.0) * self.scale if tokens else 1.0
        self._words, self._grams = np.concatenate(([0.0], words, [1.0])), np.concatenate(([0.0], grams, [1.0]))

    def unigram(self, c: np.ndarray) -> np.ndarray:
        return np.where(c > 0, self._words[np.minimum(c, K + 1)] * c * self.scale, self.unseen)

    def kept(self, c: np.ndarray) -> np.ndarray:
        """Discounted counts of bigrams."""
        return self._grams[np.minimum(c, K + 1)] * c

    def bigram(self, c: np.ndarray, history: np.ndarray, word: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Probabilities from the counts of a bigram, its history and its word, and the history's backoff weight (of
        use where ``c`` is 0 or above K)."""
        bare = weight < 0
        seen = self.kept(c) / np.maximum(history + bare, 1)
        back = np.where(history > 0, np.where(bare, -weight / (history + 1), weight), 1.0)
        return np.where(c > 0, seen, back * self.unigram(word))


def backoff(free: np.ndarray, seen: np.ndarray, unseen: float) -> np.ndarray:
    """Backoff weights from the free and seen mass of histories; negative, and to be divided by the history's count and
    one, if nothing is free.  The unseen class is never among the seen."""
    return np.where(free > 0, free, -1.0) / np.maximum(1 - seen, unseen)


class Keys:
    """The distinct keys of a batch in the order of their partition (``ends``), and the place of each token's key."""

    def __init__(self, keys: np.ndarray, n: int):
        which, at = np.unique(keys, return_inverse=True)
        part = (which % np.uint64(n)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        rank = np.empty(len(which), dtype=np.int64)
        rank[order] = np.arange(len(which))
        self.which, self.at, self.part = which[order], rank[at], part[order]
        self.ends = np.searchsorted(self.part, np.arange(n), "right")

    def __len__(self) -> int:
        return len(self.which)


class Batch:
    """The tokens of a batch of texts: document, word and history (places in ``words``) and bigram (in ``grams``)."""

    def __init__(self, table: pa.Table, n: int):
        ids, doc, train, word, gram, first, rows, size = [], [], [], [], [], [], 0, 0
        for block in blocks(table.to_batches(), ("train",)):
            words = Words(block)
            length = words.count + 1
            start = np.concatenate(([0], np.cumsum(length)))
            token = np.full(start[-1], _END)
            token[words.place + start[words.doc]] = word_hashes(lowered(block.buf), words)
            before = np.concatenate(([_END], token[:-1]))  # the token before a text's first is an end
            with np.errstate(over="ignore"):
                gram.append(mix(before * _HISTORY ^ token))
            word.append(token), doc.append(np.repeat(np.arange(len(block)) + rows, length)), first.append(start[:-1] + size)
            train.append(np.repeat(np.asarray(block.columns["train"].to_numpy(zero_copy_only=False), dtype=bool), length))
            ids.append(block.ids)
            rows, size = rows + len(block), size + len(token)
        self.rows, self.ids, self.doc, self.train = rows, ids, np.concatenate(doc), np.concatenate(train)
        self.words, self.grams = Keys(np.concatenate(word), n), Keys(np.concatenate(gram), n)
        self.history = np.empty_like(self.words.at)
        self.history[1:] = self.words.at[:-1]
        self.history[np.concatenate(first)] = self.words.at[-1]

    def trained(self, keys: Keys) -> np.ndarray:
        return np.bincount(keys.at[self.train], minlength=len(keys))

    def of_grams(self) -> tuple[np.ndarray, np.ndarray]:
        """History and word of each distinct bigram."""
        one = np.empty(len(self.grams), dtype=np.int64)
        one[self.grams.at] = np.arange(len(self.grams.at))
        return self.history[one], self.words.at[one]


def _blobs(values: np.ndarray, ends: np.ndarray, width: int) -> pa.Array:
    """One binary value a row from the last ``width`` bytes of each value, each row's ending at ``ends``."""
    data = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize)
    data = np.ascontiguousarray(data[:, values.itemsize - width :])
    offsets = np.concatenate(([0], ends * width)).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data.tobytes())])


def _counts(values: np.ndarray, ends: np.ndarray) -> list[pa.Array]:
    """Counts as one byte each, and those from 255 on in full beside them."""
    large = values >= 255
    past = np.concatenate(([0], np.cumsum(large)))[ends]
    return [_blobs(np.minimum(values, 255).astype(np.uint8), ends, 1), _blobs(values[large].astype(np.int64), past, 8)]


def _column(table: pa.Table, name: str, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(entries of all rows, number of each row's) of a binary column; narrow entries are widened to eight bytes."""
    data, size = [np.zeros(0, np.uint8)], [np.zeros(0, np.int64)]
    for chunk in table.column(name).chunks:
        _, where, body = chunk.buffers()
        offs = np.frombuffer(where, np.int32)[chunk.offset : chunk.offset + len(chunk) + 1]
        data.append(np.frombuffer(body, np.uint8)[offs[0] : offs[-1]] if body is not None else np.zeros(0, np.uint8))
        size.append(np.diff(offs) // width)
    raw = np.concatenate(data)
    if width > 1:
        wide = np.zeros((len(raw) // width, 8), dtype=np.uint8)
        wide[:, 8 - width :] = raw.reshape(-1, width)
        raw = wide.reshape(-1).view(np.uint64)
    return raw, np.concatenate(size)


def _counted(table: pa.Table, name: str) -> np.ndarray:
    out = _column(table, name, 1)[0].astype(np.int64)
    out[out == 255] = _column(table, f"{name}_past", 8)[0].view(np.int64)
    return out


def _sorted(table: pa.Table, column: str) -> pa.Table:
    return table.take(pa.array(np.argsort(table.column(column).to_numpy(), kind="stable"))).combine_chunks()


_ASKED = "bucket int, batch int, words binary, word_n binary, word_n_past binary, grams binary, gram_n binary, gram_n_past binary"


def _asked(n: int, table: pa.Table) -> pa.Table:
    """A row for each partition that a batch has n-grams of: its distinct keys and how often its training texts have them."""
    batch = Batch(table, n)
    columns, used = [], np.zeros(n, dtype=bool)
    for keys in (batch.words, batch.grams):
        used[keys.part] = True
    some = np.flatnonzero(used)
    for keys, width in ((batch.words, _WORD), (batch.grams, _GRAM)):
        columns += [_blobs(keys.which, keys.ends[some], width), *_counts(batch.trained(keys), keys.ends[some])]
    who = np.full(len(some), table.column("batch")[0].as_py(), dtype=np.int32)
    return pa.table([pa.array(some.astype(np.int32)), pa.array(who), *columns], names=[c.split()[0] for c in _ASKED.split(", ")])


def _summed(table: pa.Table, keys: str, times: str, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(total count of each distinct key, place of each entry's key, entry's own count, end of each row's entries)."""
    raw, size = _column(table, keys, width)
    own = _counted(table, times)
    which, at = np.unique(raw, return_inverse=True)
    return np.bincount(at, weights=own, minlength=len(which)).astype(np.int64), at, own, np.cumsum(size)


_TOLD = "batch int, bucket int, word_c binary, word_c_past binary, gram_c binary, gram_c_past binary, weights binary, stats array<long>"
_NAMES = [c.split()[0] for c in _TOLD.split(", ")]


def _told(columns: dict[str, pa.Array]) -> pa.Table:
    rows = len(columns["batch"])
    kinds = {"stats": pa.list_(pa.int64()), "batch": pa.int32(), "bucket": pa.int32()}
    return pa.table([columns[c] if c in columns else pa.nulls(rows, kinds.get(c, pa.binary())) for c in _NAMES], names=_NAMES)


def _answered(table: pa.Table) -> pa.Table:
    """A row for each asking batch: the total training counts of its keys, in its order.  A bigram's is doubled, with one
    added for the first batch that trains it."""
    table = _sorted(table, "batch")
    total, at, _, ends = _summed(table, "words", "word_n", _WORD)
    words = _counts(total[at], ends)
    total, at, own, ends = _summed(table, "grams", "gram_n", _GRAM)
    value = 2 * total[at]
    trains = np.flatnonzero(own)
    value[trains[np.unique(at[trains], return_index=True)[1]]] += 1
    grams = _counts(value, ends)
    return _told({"batch": table.column("batch"), "bucket": table.column("bucket"), "word_c": words[0], "word_c_past": words[1], "gram_c": grams[0], "gram_c_past": grams[1]})


_STATS = ["tokens", "types", *(f"w{r}" for r in range(1, K + 2)), *(f"g{r}" for r in range(1, K + 2))]


def _stats(table: pa.Table) -> pa.Table:
    """A partition's training tokens, words, and counts of counts of both orders."""
    words, grams = (_summed(table, *x)[0] for x in (("words", "word_n", _WORD), ("grams", "gram_n", _GRAM)))
    of = [np.bincount(np.minimum(x, K + 2), minlength=K + 3)[1 : K + 2] for x in (words, grams)]
    return pa.table([pa.array([int(x)]) for x in (words.sum(), (words > 0).sum(), *of[0], *of[1])], names=_STATS)


class Answers:
    """What a batch was told: the model, the counts of its words and bigrams, which bigrams it counts for their histories."""

    def __init__(self, told: pa.Table):
        told = _sorted(told, "bucket")
        stats = told.column("stats").drop_null()[0].as_py()
        self.model = Model(stats[0], stats[1], np.array(stats[2 : K + 3]), np.array(stats[K + 3 :]))
        counts = told.filter(told.column("word_c").is_valid()).combine_chunks()
        self.word, value = _counted(counts, "word_c"), _counted(counts, "gram_c")
        self.gram, self.owned = value >> 1, (value & 1).astype(bool)
        self.weight = _column(told.filter(told.column("weights").is_valid()).combine_chunks(), "weights", 8)[0].view(np.float64)

    def wanted(self, history: np.ndarray) -> np.ndarray:
        """Which words' backoff weights the batch must know, from its bigrams' histories: those before an unseen bigram,
        and those before counts above K alone, where perhaps nothing is free."""
        low, high, back = (np.bincount(history[x], minlength=len(self.word)) > 0 for x in ((self.gram > 0) & (self.gram <= K), self.gram > K, self.gram == 0))
        return (back | (high & ~low)) & (self.word > 0)


_FREED = "bucket int, batch int, words binary, free binary, seen binary, wanted binary, unseen double"


def _freed(n: int, table: pa.Table, told: pa.Table) -> pa.Table:
    """A row for each partition that a batch has histories of: the free and seen mass of the bigrams that it counts, and
    zeros for other histories whose weight it wants to know."""
    if not table.num_rows:
        return pa.table([pa.array([], t) for t in (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary(), pa.float64())], names=[c.split()[0] for c in _FREED.split(", ")])
    batch, answers = Batch(table, n), Answers(told)
    model, (history, word) = answers.model, batch.of_grams()
    h, c = history[answers.owned], answers.gram[answers.owned]
    free = np.bincount(h, weights=(c - model.kept(c)) / answers.word[h], minlength=len(batch.words))
    seen = np.bincount(h, weights=model.unigram(answers.word[word[answers.owned]]), minlength=len(batch.words))
    wanted = answers.wanted(history)
    sent = wanted | (seen > 0)
    part = batch.words.part[sent]
    some = np.unique(part)
    ends = np.searchsorted(part, some, "right")
    who = np.full(len(some), table.column("batch")[0].as_py(), dtype=np.int32)
    columns = [_blobs(x[sent], ends, width) for x, width in ((batch.words.which, _GRAM), (free, 8), (seen, 8), (wanted.astype(np.uint8), 1))]
    return pa.table([pa.array(some.astype(np.int32)), pa.array(who), *columns, pa.array(np.full(len(some), model.unseen))], names=[c.split()[0] for c in _FREED.split(", ")])


def _weighted(table: pa.Table) -> pa.Table:
    """A row for each batch: the backoff weights of the histories that it wanted, in its order."""
    table = _sorted(table, "batch")
    raw, size = _column(table, "words", _GRAM)
    which, at = np.unique(raw, return_inverse=True)
    free, seen = (np.bincount(at, weights=_column(table, c, 8)[0].view(np.float64), minlength=len(which)) for c in ("free", "seen"))
    weight = backoff(free, seen, table.column("unseen")[0].as_py())
    wanted = _column(table, "wanted", 1)[0].astype(bool)
    ends = np.concatenate(([0], np.cumsum(wanted)))[np.cumsum(size)]
    return _told({"batch": table.column("batch"), "bucket": table.column("bucket"), "weights": _blobs(weight[at[wanted]], ends, 8)})


_RESULT = ["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"]


def _scored(n: int, table: pa.Table, told: pa.Table) -> pa.Table:
    """doc_id, n_tokens, n_known, train_tokens, base and score of a batch's texts."""
    if not table.num_rows:
        return pa.table([pa.array([], t) for t in (table.schema.field("doc_id").type, pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64())], names=_RESULT)
    batch, answers = Batch(table, n), Answers(told)
    model, (history, word) = answers.model, batch.of_grams()
    weight = np.ones(len(batch.words))
    weight[answers.wanted(history)] = answers.weight
    p = model.bigram(answers.gram, answers.word[history], answers.word[word], weight[history])
    base = np.log10(answers.word + 1.0) - np.log10(model.tokens + model.types + 1)
    total = lambda w: np.bincount(batch.doc, weights=w, minlength=batch.rows)
    known = (answers.word > 0)[batch.words.at]
    return pa.table(
        [
            pa.chunked_array(batch.ids), pa.array(np.bincount(batch.doc, minlength=batch.rows)), pa.array(total(known).astype(np.int64)),
            pa.array(np.full(batch.rows, model.tokens)), pa.array(total(base[batch.words.at])), pa.array(total(np.log10(p)[batch.grams.at])),
        ],
        names=_RESULT,
    )


def score(df: DataFrame, learn: Column | None = None, id_col: str = "doc_id", text_col: str = "text", batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score and score of each row, learning from the rows
    whose ``doc_id`` satisfies ``learn`` (all rows if not given)."""
    kind = df.schema[id_col].dataType.simpleString()
    docs = df.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    docs = docs.withColumn("train", F.coalesce(learn if learn is not None else F.lit(True), F.lit(False)) & F.col("doc_id").isNotNull())
    n = 1 + (docs.agg(F.sum(F.octet_length("text") + 1)).first()[0] or 0) // batch_bytes
    texts = docs.withColumn("batch", F.pmod(F.xxhash64("doc_id", "text"), F.lit(n)).cast("int"))

    asked = texts.groupBy("batch").applyInArrow(lambda table: _asked(n, table), _ASKED)
    sums = asked.groupBy("bucket").applyInArrow(lambda table: _stats(table), ", ".join(f"{s} long" for s in _STATS)).agg(*(F.sum(s).alias(s) for s in _STATS))
    stats = sums.select(F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("batch"), F.array(*_STATS).alias("stats"))
    stats = stats.select("batch", F.lit(-1).alias("bucket"), *(F.lit(None).cast("binary").alias(c) for c in _NAMES[2:-1]), "stats")
    told = asked.groupBy("bucket").applyInArrow(lambda table: _answered(table), _TOLD).unionByName(stats)
    freed = texts.groupBy("batch").cogroup(told.groupBy("batch")).applyInArrow(lambda table, answers: _freed(n, table, answers), _FREED)
    weights = freed.groupBy("bucket").applyInArrow(lambda table: _weighted(table), _TOLD)
    schema = f"doc_id {kind}, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return texts.groupBy("batch").cogroup(told.unionByName(weights).groupBy("batch")).applyInArrow(lambda table, answers: _scored(n, table, answers), schema)


def held_out_scores(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``score`` with held_out: rows whose crc32 of the id is 2 modulo 7 never train."""
    out = score(df, fold_crc("doc_id", 7) != 2, id_col, text_col)
    return out.select("doc_id", (fold_crc("doc_id", 7) == 2).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
