"""Language identification by a bidirectional gated recurrent network over bytes.

Two gated recurrent layers read windows of ``WINDOW`` bytes forwards and backwards, every byte
position gets a probability of each language from both states, and a document's probabilities are the
mean over all its positions.  Gates are clipped lines and the candidate state is a softsign, which
numpy computes several times faster than exponentials.  Training is backpropagation through time in
numpy with Adam, on the driver, over at most ``PER_LANG`` documents a language and ``SPOTS`` windows
each; that bound does not depend on the corpus.  Prediction covers every byte of every text.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; so is every text when no
row is labelled; null ids are kept (and do not train); equal rows give a row each; ties between
languages go to the first by name; an empty table gives no rows; very long texts are read window by
window; other columns are ignored.  The languages learned are a label set, so their number is taken as bounded.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.kernels import blocks, fold_crc

WINDOW = 128
HIDDEN = 8
PER_LANG = 320
SPOTS = 2
STEPS = 160
BATCH = 64
RATE = 0.02
UNKNOWN = "und"


class Layer:
    """One direction: input table ``e`` (byte, 3H) and recurrent matrix ``u`` (H, 3H); update, reset, candidate."""

    def __init__(self, rng: np.random.Generator, hidden: int):
        self.h = hidden
        self.e = (rng.standard_normal((256, 3 * hidden)) * 0.3).astype(np.float32)
        self.e[:, : 2 * hidden] = self.e[:, : 2 * hidden] * 0.3 + 0.5
        self.u = (rng.standard_normal((hidden, 3 * hidden)) * 0.25).astype(np.float32)

    def forward(self, x: np.ndarray, keep: bool = False) -> tuple[np.ndarray, list]:
        """States (T, N, H) over bytes x (T, N), and what the backward pass needs."""
        steps, n = x.shape
        H = self.h
        out = np.empty((steps, n, H), dtype=np.float32)
        h = np.zeros((n, H), dtype=np.float32)
        tape = []
        for t in range(steps):
            a, b = self.e[x[t]], h @ self.u
            zr = np.clip(a[:, : 2 * H] + b[:, : 2 * H], 0, 1)
            z, r = zr[:, :H], zr[:, H:]
            c = r * b[:, 2 * H :]
            c += a[:, 2 * H :]
            c /= np.abs(c) + 1
            new = c - h
            new *= z
            new += h
            if keep:
                tape.append((h, b[:, 2 * H :], zr, c))
            out[t] = h = new
        return out, tape

    def backward(self, x: np.ndarray, tape: list, dout: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Gradients of ``e`` and ``u``."""
        H, steps = self.h, len(tape)
        da_all = np.empty((*x.shape, 3 * H), dtype=np.float32)
        du = np.zeros_like(self.u)
        dh = np.zeros_like(dout[0])
        for t in range(steps - 1, -1, -1):
            h, bc, zr, c = tape[t]
            z, r = zr[:, :H], zr[:, H:]
            dh = dh + dout[t]
            dc = dh * z * (1 - np.abs(c)) ** 2
            dzr = np.concatenate((dh * (c - h), dc * bc), axis=1) * ((zr > 0) & (zr < 1))
            da_all[t] = np.concatenate((dzr, dc), axis=1)
            db = np.concatenate((dzr, dc * r), axis=1)
            du += h.T @ db
            dh = dh * (1 - z) + db @ self.u.T
        de = np.zeros_like(self.e)
        order = np.argsort(x.ravel(), kind="stable")
        which, start = np.unique(x.ravel()[order], return_index=True)
        de[which] = np.add.reduceat(da_all.reshape(-1, 3 * H)[order], start, axis=0)
        return de, du


class Network:
    def __init__(self, langs: list[str], hidden: int = HIDDEN, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.langs = langs
        self.there, self.back = Layer(rng, hidden), Layer(rng, hidden)
        self.v = (rng.standard_normal((2 * hidden, len(langs))) * 0.3).astype(np.float32)
        self.b = np.zeros(len(langs), dtype=np.float32)

    def states(self, x: np.ndarray) -> np.ndarray:
        return np.concatenate((self.there.forward(x)[0], self.back.forward(x[::-1])[0][::-1]), axis=2)

    def positions(self, x: np.ndarray) -> np.ndarray:
        """Probabilities (T, N, languages) at every position."""
        logits = self.states(x) @ self.v + self.b
        logits -= logits.max(axis=2, keepdims=True)
        np.exp(logits, out=logits)
        logits /= logits.sum(axis=2, keepdims=True)
        return logits

    def fit(self, x: np.ndarray, y: np.ndarray, steps: int = STEPS, batch: int = BATCH, rate: float = RATE, seed: int = 5) -> None:
        """x: windows (N, T) of bytes; y: language numbers.  Every position is to tell the language."""
        rng = np.random.default_rng(seed)
        params = [self.there.e, self.there.u, self.back.e, self.back.u, self.v, self.b]
        first, second, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
        epochs = -(-steps * batch // len(x))
        for epoch in range(epochs):
            order = rng.permutation(len(x))
            for at in range(0, len(x), batch):
                own = order[at : at + batch]
                xs, ys = np.ascontiguousarray(x[own].T), y[own]
                hf, tf = self.there.forward(xs, True)
                hb, tb = self.back.forward(xs[::-1], True)
                h = np.concatenate((hf, hb[::-1]), axis=2)
                logits = h @ self.v + self.b
                logits -= logits.max(axis=2, keepdims=True)
                p = np.exp(logits)
                p /= p.sum(axis=2, keepdims=True)
                p[:, np.arange(len(ys)), ys] -= 1
                p /= p.shape[0] * p.shape[1]
                dh = p @ self.v.T
                H = self.there.h
                grads = [*self.there.backward(xs, tf, dh[:, :, :H]), *self.back.backward(xs[::-1], tb, dh[::-1, :, H:])]
                grads += [np.einsum("tnh,tnl->hl", h, p), p.sum(axis=(0, 1))]
                norm = float(np.sqrt(sum(float((g**2).sum()) for g in grads)))
                step += 1
                now = rate * (1 - 0.9 * epoch / epochs)
                for k, (w, g) in enumerate(zip(params, grads, strict=True)):
                    g = g * min(1.0, 1.0 / (norm + 1e-9))
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.99 * second[k] + 0.01 * g * g
                    w -= (now * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)


def train(df: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Network | None:
    """A network fitted on a bounded sample of the rows for which ``learn`` holds."""
    known = df.filter(learn & F.col(id_col).isNotNull() & F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()).select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    counts = {r["lang"]: r["count"] for r in known.groupBy("lang").count().orderBy(F.desc("count")).collect()}
    if not counts:
        return None
    share = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, PER_LANG / n))])
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) / 1_000_003
    spots = F.transform(F.sequence(F.lit(1), F.lit(SPOTS)), lambda k: F.substring(F.col("text"), F.pmod(F.xxhash64("doc_id", k), F.greatest(F.lit(1), F.length("text") - WINDOW + 1)).cast("int") + 1, F.lit(WINDOW)))
    rows = known.filter(place < F.element_at(share, F.col("lang"))).select("doc_id", "lang", spots.alias("spots")).orderBy(F.xxhash64("doc_id")).limit(2 * PER_LANG * len(counts)).collect()
    langs = sorted(counts)
    data = [(r["lang"], s.encode()[:WINDOW]) for r in sorted(rows, key=lambda r: r["doc_id"]) for s in r["spots"] if s.strip()]
    if not data:
        return None
    x = np.stack([np.frombuffer((s * (WINDOW // len(s) + 1))[:WINDOW], np.uint8) for _, s in data])
    net = Network(langs)
    net.fit(x, np.array([langs.index(lang) for lang, _ in data]))
    return net


def document_probabilities(net: Network, buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Mean position probabilities (documents, languages); zero for empty ones."""
    size = np.diff(offs)
    pieces = -(-size // WINDOW)
    doc = np.repeat(np.arange(len(size)), pieces)
    start = offs[:-1][doc] + (np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * WINDOW
    length = np.minimum(WINDOW, offs[1:][doc] - start)
    out = np.zeros((len(size), len(net.langs)))
    order = np.argsort(-length, kind="stable")
    for at in range(0, len(order), 2048):
        own = order[at : at + 2048]
        steps = int(length[own[0]])
        grid = start[own][None, :] + np.arange(steps)[:, None]
        real = np.arange(steps)[:, None] < length[own][None, :]
        p = net.positions(buf[np.where(real, grid, start[own][None, :])])
        np.add.at(out, doc[own], np.einsum("tnl,tn->nl", p, real.astype(np.float32)))
    return out / np.maximum(size, 1)[:, None]


def predict(df: DataFrame, net: Network | None, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """doc_id, lang_pred, score and the columns named in ``keep`` for each row."""

    def run(net, names, batches):
        for block in blocks(batches, ("lettered", *names)):
            lettered = np.asarray(block.columns["lettered"].to_numpy(zero_copy_only=False), dtype=bool)
            if net is None or not len(block.buf):
                best, score, lettered = np.zeros(len(block), np.int64), np.zeros(len(block)), np.zeros(len(block), bool)
            else:
                p = document_probabilities(net, block.buf, block.offs)
                best, score = p.argmax(axis=1), np.minimum(1.0, p.max(axis=1))
            label = [net.langs[k] if ok else UNKNOWN for k, ok in zip(best.tolist(), lettered.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([block.ids, pa.array(label, pa.string()), pa.array(np.where(lettered, score, 0.0)), *(block.columns[k] for k in names)], ["doc_id", "lang_pred", "score", *names])

    keep = keep or []
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    names = [f"kept_{i}" for i in range(len(keep))]
    rows = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False)).alias("lettered"), *(F.col(c).alias(n) for c, n in zip(keep, names, strict=True)))
    schema = f"doc_id {kinds[id_col]}, lang_pred string, score double" + "".join(f", {n} {kinds[c]}" for c, n in zip(keep, names, strict=True))
    out = rows.mapInArrow(partial(run, net, names), schema)
    return out.select("doc_id", "lang_pred", "score", *(F.col(n).alias(c) for c, n in zip(keep, names, strict=True)))


def identify(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """doc_id, held_out, lang_pred, score: rows whose crc32 of the id is 1 modulo 3 never train."""
    net = train(df, fold_crc(id_col, 3) != 1, id_col, text_col, lang_col)
    return predict(df, net, id_col, text_col).select("doc_id", (fold_crc("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score")


def keep_identified(df: DataFrame, net: Network | None, least_score: float, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` whose text has a letter and whose best language scores ``least_score`` or more."""

    def run(net, batches):
        for batch in batches:
            bare = pa.RecordBatch.from_arrays([batch.column(batch.schema.names.index(id_col)), batch.column(batch.schema.names.index(text_col)), batch.column(batch.num_columns - 1)], ["doc_id", "text", "lettered"])
            fits = []
            for block in blocks([bare], ("lettered",)):
                lettered = np.asarray(block.columns["lettered"].to_numpy(zero_copy_only=False), dtype=bool)
                if net is not None and len(block.buf):
                    lettered = lettered & (document_probabilities(net, block.buf, block.offs).max(axis=1) >= least_score)
                fits.append(lettered)
            if fits:
                yield pa.RecordBatch.from_arrays(batch.columns[:-1], batch.schema.names[:-1]).filter(pa.array(np.concatenate(fits)))

    marked = df.withColumn("ledgerloom lettered", F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False)))
    return marked.mapInArrow(partial(run, net), df.schema)
