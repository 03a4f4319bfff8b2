"""Byte-level BPE encoding and decoding with the ranks of a public tokenizer's file.

A text is cut by the tokenizer's pattern, and the bytes of each piece are merged: every step joins the
adjacent pair with the lowest rank, the leftmost of equals, until no pair has one.  Decoding
concatenates the bytes of the ids.

``digest`` folds each distinct piece of a task's texts once, in Arrow batches, and keeps at most ``MEMO``
folded pieces; no piece costs more than n log n steps.  ``native_digest`` is the same by Spark's
higher-order functions alone: a fold over the bytes with a literal rank map, hashed into buckets, and a
second literal of the ``HEAD`` most used pieces of a sample.  It gives equal rows but several times the
CPU seconds (the README has the figures), and is quadratic in the length of a piece.  Neither shuffles.

Defined cases: a null text counts as empty and has no ids; equal rows give a row each; null ids are
kept; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import json
from functools import partial

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MEMO = 80_000
ROWS = 256  # texts that are worked on at a time
BUCKETS = 1 << 16
HEAD = 1 << 16
SAMPLE = 6_000
NO_RANK = 2**31 - 1
VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def fold_bytes(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one piece: lowest rank first, then leftmost, with a heap of the pairs that may be joined."""
    if (whole := ranks.get(piece)) is not None:
        return [whole]
    n = len(piece)
    end, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n  # of the part that begins at i
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        middle = end[i]
        if not alive[i] or middle >= n or end[middle] != stop:  # one of the two was joined meanwhile
            continue
        alive[middle], end[i] = False, stop
        if stop < n:
            before[stop] = i
            if (r := ranks.get(piece[i : end[stop]])) is not None:
                heapq.heappush(heap, (r, i, end[stop]))
        if (j := before[i]) >= 0 and (r := ranks.get(piece[j:stop])) is not None:
            heapq.heappush(heap, (r, j, stop))
    return [ranks[piece[i : end[i]]] for i in range(n) if alive[i]]


def pattern() -> str:
    """The tokenizer's pattern in Java's dialect: white space as Unicode has it."""
    import public_tokenizers

    return "(?U)" + public_tokenizers.PATTERN


def read_ranks(path: str | None = None) -> dict[bytes, int]:
    """Token bytes and ranks of a rank file."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(VOCABULARY)
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def _literal(pairs, kind: str) -> Column:
    """A map literal from (key, value) pairs, as an array of small maps by the key's hash."""
    table: list[dict] = [{} for _ in range(BUCKETS)]
    for key, value in pairs:
        table[xxhash.xxh64_intdigest(key.encode(), 42) & (BUCKETS - 1)][key] = value
    return F.from_json(F.lit(json.dumps(table, separators=(",", ":"))), f"array<map<string,{kind}>>")


def _find(table: Column, key: Column) -> Column:
    return F.try_element_at(F.get(table, F.xxhash64(key).bitwiseAND(F.lit(BUCKETS - 1)).cast("int")), key)


def _using(table: Column, body) -> Column:
    """``body(table)`` with the table bound once, however often the body mentions it."""
    return F.get(F.transform(F.array(table), body), F.lit(0))


class Tokenizer:
    """The literals of one rank file."""

    def __init__(self, spark: SparkSession, path: str | None = None):
        ranks = read_ranks(path)
        self.spark = spark
        self.ranks = _literal(((token.hex().upper(), rank) for token, rank in ranks.items()), "int")
        pieces = [""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            pieces[rank] = token.hex()
        self.pieces = F.from_json(F.lit(json.dumps(pieces)), "array<string>")
        self.head: Column | None = None

    @staticmethod
    def fold(b: Column, table: Column) -> Column:
        """The ids of one piece, given its bytes (one at least) and the rank table.

        The state has a long for each part: the rank of the part joined to the next, shifted left by 32,
        plus where the part begins.  The least of them is the pair to merge, and the leftmost of equals.
        """
        n, none, shift = F.length(b).cast("long"), F.lit(NO_RANK << 32), F.lit(1 << 32)

        def rank(start: Column, end: Column) -> Column:
            return _find(table, F.hex(F.substring(b, (start + 1).cast("int"), (end - start).cast("int"))))

        def entry(start: Column, middle: Column, end: Column) -> Column:
            """The state of a part that ends at ``middle`` and whose next part ends at ``end``."""
            return F.when(middle < n, F.coalesce(rank(start, end).cast("long") * shift, none)).otherwise(none) + start

        def step(state: Column, _: Column) -> Column:
            def merged(least: Column) -> Column:
                return F.when(least >= none, state).otherwise(_using(F.array_position(state, least).cast("int"), lambda at: at_place(least, at)))

            def at_place(least: Column, at: Column) -> Column:
                def begin(k) -> Column:  # of the k-th part after `at`
                    return F.coalesce(F.get(state, at - 1 + k) % shift, n)

                def with_ends(ends: Column) -> Column:
                    middle, end = F.get(ends, F.lit(0)), F.get(ends, F.lit(1))
                    gone = F.get(state, at)
                    before = F.get(state, at - 2)
                    start = least % shift
                    return F.transform(
                        F.filter(state, lambda x: x != gone),
                        lambda x: F.when(x == least, entry(start, middle, end)).when(x == before, entry(before % shift, start, middle)).otherwise(x),
                    )

                return _using(F.array(begin(2), begin(3)), with_ends)

            return _using(F.array_min(state), merged)

        def ids(state: Column) -> Column:
            return F.transform(state, lambda x, i: rank(x % shift, F.coalesce(F.get(state, i + 1) % shift, n)))

        start = F.transform(F.sequence(F.lit(0), F.length(b) - 1), lambda i: entry(i.cast("long"), i.cast("long") + 1, i.cast("long") + 2))
        whole = _find(table, F.hex(b))
        return F.coalesce(F.when(whole.isNotNull(), F.array(whole)), F.aggregate(F.sequence(F.lit(1), F.greatest(F.length(b) - 1, F.lit(1))), start, step, ids))

    def warm(self, df: DataFrame, text_col: str) -> None:
        """Fold the sample's most used pieces once."""
        n = df.count()
        if not n:
            return
        some = df.filter(F.pmod(F.xxhash64(text_col), F.lit(1_000_000)) < F.lit(int(1_000_000 * min(1.0, SAMPLE / n))))
        pieces = some.select(F.explode(F.regexp_extract_all(F.col(text_col), F.lit(pattern()), F.lit(0))).alias("p")).groupBy("p").count()
        top = pieces.filter("count > 1").orderBy(F.desc("count"), "p").limit(HEAD)
        self.head = _literal(((r["p"], r["ids"]) for r in top.select("p", _using(self.ranks, lambda t: self.fold(F.encode("p", "UTF-8"), t)).alias("ids")).collect()), "array<int>")

    def ids(self, text: Column) -> Column:
        """The ids of a text."""
        pieces = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(pattern()), F.lit(0))

        def with_ranks(ranks: Column) -> Column:
            if self.head is None:
                return F.transform(pieces, lambda p: self.fold(F.encode(p, "UTF-8"), ranks))
            return _using(self.head, lambda head: F.transform(pieces, lambda p: F.coalesce(_find(head, p), self.fold(F.encode(p, "UTF-8"), ranks))))

        return F.flatten(_using(self.ranks, with_ranks))

    def decoded(self, ids: Column) -> Column:
        """The bytes that ids stand for."""
        return F.unhex(F.array_join(_using(self.pieces, lambda t: F.transform(ids, lambda i: F.get(t, i))), ""))


def native_digest(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """``digest`` by higher-order functions alone."""
    t = Tokenizer(df.sparkSession, path)
    t.warm(df.select(F.col(text_col).alias("text")), "text")
    coded = df.select(F.col(id_col).alias("doc_id"), t.ids(F.col(text_col)).alias("ids"))
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"), F.sha2(t.decoded(F.col("ids")), 256).alias("decoded_sha256"))


def _encoded(ranks: dict[bytes, int], cut: str, keep_ids: bool, batches):
    import regex

    find = regex.compile(cut).findall
    bytes_of = {rank: token for token, rank in ranks.items()}
    memo: dict[str, tuple[tuple[int, ...], str, bytes]] = {}

    def fold(piece: str):
        ids = tuple(fold_bytes(piece.encode(), ranks))
        made = (ids, ",".join(map(str, ids)), b"".join(map(bytes_of.__getitem__, ids)))
        if len(memo) < MEMO:
            memo[piece] = made
        return made

    for batch in (b.slice(at, ROWS) for b in batches for at in range(0, b.num_rows, ROWS)):
        n, coded, back, kept = [], [], [], []
        for text in batch.column("text"):
            made = [memo.get(p) or fold(p) for p in find(text.as_py() or "")]
            n.append(sum(len(m[0]) for m in made))
            coded.append(hashlib.sha256(",".join([m[1] for m in made]).encode()).hexdigest())
            back.append(hashlib.sha256(b"".join([m[2] for m in made])).hexdigest())
            if keep_ids:
                kept.append([i for m in made for i in m[0]])
        ids = [pa.array(kept, pa.list_(pa.int32()))] if keep_ids else []
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *ids, pa.array(n, pa.int64()), pa.array(coded, pa.string()), pa.array(back, pa.string())], ["doc_id", *["ids"] * keep_ids, "n_tokens", "ids_sha256", "decoded_sha256"])


def digest(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, keep_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of each row, and the ids if asked for."""
    import public_tokenizers

    space = public_tokenizers.PATTERN.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")
    kind = df.schema[id_col].dataType.simpleString()
    schema = f"doc_id {kind}, " + "ids array<int>, " * keep_ids + "n_tokens long, ids_sha256 string, decoded_sha256 string"
    return df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(partial(_encoded, read_ranks(path), space, keep_ids), schema)
