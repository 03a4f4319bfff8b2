"""SimHash near-duplicates, searched through the anchor points of a covering code.

A fingerprint has 64 bits; two that differ in at most 3 bits agree on one 32-bit half up to
one bit.  The anchors of a half are the code words of the [31,26] Hamming code, whose covering
radius is one, times the two values of the remaining bit.  Each distinct fingerprint lives at
the anchor nearest to its half and is also sent to every anchor within the radius plus the one
bit that a partner may differ by: 2 homes and 4 to 34 visits each.  Partners then meet at an
anchor, by a join, and are compared there.  The search is exact and needs no cap.

Defined cases: a null text counts as empty; a text without words has fingerprint zero, which
links like any other; equal fingerprints form one class before any search, however many rows
hold them; repeated rows give a row each; a row with a null id links nothing and gets the component of
its equals (null if there are none); an empty table gives no rows; very long texts are hashed
piece by piece; the smallest id names a component, so there are no ties; other columns are ignored.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.components import connected_components
from ledgerloom.llm.kernels import blocks, shared_dir

SEED = 42
DISTANCE = 3
_CHUNK = 1 << 16


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """The 64-bit fingerprint of a text whose A-Z are lower-cased here."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(words) >= shingle:
        starts, ends = starts[: len(words) - shingle + 1], ends[shingle - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(starts), _CHUNK):
        s, e = starts[at : at + _CHUNK].tolist(), ends[at : at + _CHUNK].tolist()
        h = np.fromiter(map(xxhash.xxh64_intdigest, [joined[i:j] for i, j in zip(s, e, strict=True)], repeat(SEED)), np.uint64, len(s))
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(starts), bitorder="little").view(np.uint64)[0])


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed long."""

    def run(batches):
        for block in blocks(batches):
            fp = np.fromiter((fingerprint(block.bytes_of(i), shingle) for i in range(len(block))), np.uint64, len(block))
            yield pa.RecordBatch.from_arrays([block.ids, pa.array(fp.view(np.int64))], ["doc_id", "fp"])

    kind = df.schema[id_col].dataType.simpleString()
    docs = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return docs.mapInArrow(run, f"doc_id {kind}, fp long")


def _syndrome(half: np.ndarray) -> np.ndarray:
    """XOR of the places (1 to 31) of the set bits among the lower 31."""
    s = np.zeros(half.shape, dtype=np.int64)
    for place in range(1, 32):
        s ^= np.where((half >> (place - 1)) & 1, place, 0)
    return s


def _bit(place: np.ndarray) -> np.ndarray:
    """The bit of a place, none for place 0."""
    return np.where(place > 0, np.left_shift(1, np.maximum(place - 1, 0)), 0)


def homes(half: np.ndarray) -> np.ndarray:
    """The nearest anchor of each 32-bit half."""
    return half ^ _bit(_syndrome(half))


def visits(half: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index, anchor) of all anchors within two bits of each half."""
    s = _syndrome(half)
    home = half ^ _bit(s)
    index = np.arange(len(half))
    out_i, out_a = [index, index], [home, home ^ (1 << 31)]
    off = np.flatnonzero(s)
    for i in range(1, 32):  # two flips i, j with i xor j = s lead to another code word
        j = s[off] ^ i
        keep = (j > i)
        out_i.append(off[keep])
        out_a.append(half[off[keep]] ^ (1 << (i - 1)) ^ _bit(j[keep]))
    return np.concatenate(out_i), np.concatenate(out_a)


def links(classes: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(a, b): nodes of distinct fingerprints at most ``distance`` (3 at most) bits apart.  ``classes``: (fp, node)."""

    def at_home(batches):
        for b in batches:
            fp, node = b.column("fp").to_numpy(), b.column("node")
            for side in (0, 1):
                half = (fp.view(np.uint64) >> np.uint64(32 * side)).astype(np.int64) & 0xFFFFFFFF
                yield pa.RecordBatch.from_arrays([pa.array(homes(half) | side << 32), b.column("fp"), node], ["anchor", "fp", "node"])

    def visiting(batches):
        for b in batches:
            fp, node = b.column("fp").to_numpy(), b.column("node")
            for side in (0, 1):
                half = (fp.view(np.uint64) >> np.uint64(32 * side)).astype(np.int64) & 0xFFFFFFFF
                index, anchor = visits(half)
                yield pa.RecordBatch.from_arrays([pa.array(anchor | side << 32), pa.array(fp[index]), node.take(pa.array(index))], ["anchor", "fp2", "node2"])

    if not 0 <= distance <= DISTANCE:
        raise ValueError(f"two halves cover a distance of at most {DISTANCE}")
    kind = classes.schema["node"].dataType.simpleString()
    met = classes.select("fp", "node").mapInArrow(at_home, f"anchor long, fp long, node {kind}").join(
        classes.select("fp", "node").mapInArrow(visiting, f"anchor long, fp2 long, node2 {kind}"), "anchor"
    )
    near = met.filter((F.col("fp") != F.col("fp2")) & (F.bit_count(F.col("fp").bitwiseXOR(F.col("fp2"))) <= distance))
    return near.select(F.least("node", "node2").alias("a"), F.greatest("node", "node2").alias("b")).distinct()


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, distance: int = DISTANCE) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row; the component is the smallest id reachable by links."""
    shared_dir(df.sparkSession)
    prints = fingerprints(df, id_col, text_col, shingle).checkpoint()
    classes = prints.groupBy("fp").agg(F.min("doc_id").alias("node")).filter("node is not null").checkpoint()
    members = connected_components(links(classes, distance))
    named = classes.join(members, "node", "left").select("fp", F.coalesce("component", "node").alias("component_id"))
    return prints.join(named, "fp", "left").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")

