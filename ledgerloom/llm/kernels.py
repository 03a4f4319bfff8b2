"""Arrow and numpy helpers that run inside tasks; Spark partitions and shuffles the work.

Texts arrive as Arrow batches.  ``blocks`` regroups them into runs of whole documents
bounded by bytes, so that a batch of long documents needs no more memory than a batch of
short ones.  Words are maximal runs of bytes outside ``\\x20`` and ``\\x09-\\x0D``.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BLOCK_BYTES = 1 << 20
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_BYTE_CODES = np.random.default_rng(20240607).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
_powers: dict[str, np.ndarray] = {}


def shared_dir(spark: SparkSession) -> None:
    """Make sure ``checkpoint()`` has a folder: the one that the cluster names in ``spark.checkpoint.dir``.  A local
    session without one gets a folder in its warehouse; on a cluster that is an error."""
    sc = spark.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isEmpty():
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder and not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    sc.setCheckpointDir(folder or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/checkpoints")


def tasks(spark: SparkSession) -> int:
    """The session's shuffle partition count, which the cluster sets in proportion to its input."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fold_crc(doc_id: str | Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``."""
    return F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string")) % modulus


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


class Block:
    """Whole documents as one byte buffer: ``ids``, ``buf`` and ``offs`` (len(ids) + 1 offsets)."""

    def __init__(self, ids: pa.Array, buf: np.ndarray, offs: np.ndarray, columns: dict[str, pa.Array]):
        self.ids, self.buf, self.offs, self.columns = ids, buf, offs, columns

    def __len__(self) -> int:
        return len(self.ids)

    def bytes_of(self, i: int) -> bytes:
        return self.buf[self.offs[i] : self.offs[i + 1]].tobytes()


def blocks(batches: Iterable[pa.RecordBatch], extra: tuple[str, ...] = (), limit: int = BLOCK_BYTES) -> Iterator[Block]:
    """Blocks of at most ``limit`` bytes (or one document); a null text counts as empty.  The
    batches have ``doc_id``, ``text`` and the columns named in ``extra``, which stay Arrow arrays."""
    for batch in batches:
        if not batch.num_rows:
            continue
        text = batch.column("text")
        if text.null_count:
            text = text.fill_null("")
        text = text.cast(pa.large_binary()) if not pa.types.is_large_binary(text.type) else text
        _, where, data = text.buffers()
        offs = np.frombuffer(where, dtype=np.int64)[text.offset : text.offset + len(text) + 1]
        buf = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
        ids = batch.column("doc_id")
        more = {k: batch.column(k) for k in extra}
        start = 0
        while start < len(ids):
            end = max(start + 1, int(np.searchsorted(offs, offs[start] + limit, "right")) - 1)
            a, b = offs[start], offs[end]
            yield Block(ids[start:end], buf[a:b], offs[start : end + 1] - a, {k: v[start:end] for k, v in more.items()})
            start = end


def _power(kind: str, n: int) -> np.ndarray:
    have = _powers.get(kind)
    if have is None or len(have) < n:
        size = max(n, BLOCK_BYTES + 1)
        with np.errstate(over="ignore"):
            have = np.full(size, _BASE if kind == "up" else _INVERSE, dtype=np.uint64)
            have[0] = 1
            have = np.multiply.accumulate(have)
        if size <= 16 * BLOCK_BYTES:
            _powers[kind] = have
    return have


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser; different inputs stay different."""
    with np.errstate(over="ignore"):
        x = x ^ (x >> np.uint64(31))
        x = x * np.uint64(0xBF58476D1CE4E5B9)
        x = x ^ (x >> np.uint64(29))
        x = x * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(32))


class Words:
    """Word bounds of a block: ``start``, ``end``, ``doc`` (index in the block) and ``first``
    (index of each document's first word, with the total at the end)."""

    def __init__(self, block: Block):
        buf, offs = block.buf, block.offs
        solid = ~_SPACE[buf]
        before = np.zeros(len(buf), dtype=bool)
        before[1:] = solid[:-1]
        inner = offs[1:-1]
        before[inner[inner < len(buf)]] = False
        after = np.zeros(len(buf), dtype=bool)
        after[:-1] = solid[1:]
        cut = offs[1:] - 1
        after[cut[(cut >= 0)]] = False
        self.start = np.flatnonzero(solid & ~before)
        self.end = np.flatnonzero(solid & ~after) + 1
        self.first = np.searchsorted(self.start, offs)
        self.count = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(block)), self.count)
        self.place = np.arange(len(self.start)) - self.first[self.doc]

    def __len__(self) -> int:
        return len(self.start)


def lowered(buf: np.ndarray) -> np.ndarray:
    """A-Z lower-cased; all other bytes stay."""
    return _LOWER[buf]


def word_hashes(buf: np.ndarray, words: Words) -> np.ndarray:
    """A stable 64-bit hash of each word's bytes."""
    with np.errstate(over="ignore"):
        total = np.zeros(len(buf) + 1, dtype=np.uint64)
        np.cumsum(_BYTE_CODES[buf] * _power("up", len(buf))[: len(buf)], out=total[1:])
        return mix((total[words.end] - total[words.start]) * _power("down", len(buf) + 1)[words.start])


def gram_hashes(h: np.ndarray, words: Words, k: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the k words from each word on, and whether they lie in one document."""
    n = len(h)
    out = np.zeros(n, dtype=np.uint64)
    ok = np.zeros(n, dtype=bool)
    if n >= k:
        with np.errstate(over="ignore"):
            acc = np.full(n - k + 1, np.uint64(seed * 2 + 1), dtype=np.uint64)
            for j in range(k):
                acc = (acc ^ h[j : n - k + 1 + j]) * _BASE
                acc ^= acc >> np.uint64(30)
        out[: n - k + 1] = mix(acc)
        ok[: n - k + 1] = words.doc[: n - k + 1] == words.doc[k - 1 :]
    return out, ok


def long_array(values: np.ndarray, counts: np.ndarray) -> pa.ListArray:
    """A list column: ``counts[i]`` of the values for row i."""
    offsets = np.zeros(len(counts) + 1, dtype=np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))
