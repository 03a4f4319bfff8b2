"""Personal data: patterns propose spans, checksums confirm them, nearby words adjust the score.

``find_spans`` is the operator on one text, ``detect`` the operator on a DataFrame and
``redact`` the one that rewrites texts.  The four base kinds are always reported when their
rule holds.  Further kinds (bank account numbers with a mod-97 check, national numbers,
secrets) start from a prior, gain or lose by context words within ``WINDOW`` code points,
and are reported from ``THRESHOLD`` on.

Defined cases: a null text counts as empty and has no spans; an empty text likewise; repeated
rows and repeated ids give a row each; a null id stays null; other columns pass untouched in
``redact`` and are ignored in ``detect``.  All patterns take linear time on long texts.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

KINDS = ("email", "ip", "card", "phone", "iban", "national", "secret")
THRESHOLD = 0.6
WINDOW = 48

_LOCAL_SET = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A run of digits can only start a match at its beginning, and is then taken whole.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"\b[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?\b")
_NATIONAL = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_SECRET = re.compile(r"(?<![A-Za-z0-9_])(?:[0-9a-fA-F]{32,128}|(?:AKIA|ghp_|sk_live_|xox[bp]-)[A-Za-z0-9-]{12,80})(?![A-Za-z0-9_])")
_SECRET_HINT = re.compile(r"[0-9a-fA-F]{32}|AKIA|ghp_|sk_live_|xox[bp]-")
# Words that make a kind likelier or less likely when they stand nearby.
_FOR = {
    "iban": ("iban", "account", "bank", "konto", "cuenta", "compte", "bic", "swift"),
    "national": ("ssn", "social", "security", "taxpayer", "national"),
    "secret": ("token", "secret", "password", "passwd", "api", "key", "bearer", "credential"),
}
_AGAINST = {
    "iban": ("serial", "part", "sku"),
    "national": ("part", "serial", "order", "isbn", "phone"),
    "secret": ("sha256", "sha1", "md5", "checksum", "digest", "commit", "hash"),
}
_PRIOR = {"iban": 0.75, "national": 0.45, "secret": 0.4}


def luhn(digits: str) -> bool:
    """The mod-10 check of card numbers."""
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def mod97(number: str) -> bool:
    """The mod-97 check of international bank account numbers (letters count as 10 to 35)."""
    moved = number[4:] + number[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _ibans(text: str) -> Iterator[tuple[int, int]]:
    """Account numbers whose check holds.  A match may have swallowed a word after the number, so its shorter ends at
    spaces are tried from the longest on; where none holds, the next number may begin inside the match."""
    m = _IBAN.search(text)
    while m:
        start, end = m.span()
        while end > start and not (15 <= len(n := text[start:end].replace(" ", "")) <= 34 and mod97(n)):
            end = text.rfind(" ", start, end)
        if end > start:
            yield start, end
        m = _IBAN.search(text, max(end, start + 1))


def _emails(text: str) -> Iterator[tuple[int, int]]:
    at, done = text.find("@"), 0
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL_SET:
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            yield start, m.end()
            done = m.end()
        at = text.find("@", max(done, at + 1))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The spans of the four base kinds, by start and then kind."""
    out = [("email", s, e) for s, e in _emails(text)]
    for m in _IP.finditer(text):
        # int() of a very long run of digits is refused, and such a part is over 255 anyway
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                out.append(("phone", m.start(), m.end()))
    return sorted(out, key=_order)


def _order(span: tuple) -> tuple[int, int]:
    return span[1], KINDS.index(span[0])


def _context(text: str, kind: str, start: int, end: int) -> float:
    near = text[max(0, start - WINDOW) : start].lower() + " " + text[end : end + WINDOW // 2].lower()
    score = _PRIOR[kind]
    score += 0.35 * any(w in near for w in _FOR[kind])
    return score - 0.3 * any(w in near for w in _AGAINST[kind])


def find_spans(text: str | None, threshold: float = THRESHOLD) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int, float]]]:
    """(base spans, all spans with scores), each by start and then kind; code points, end exclusive."""
    if not text:
        return [], []
    base = base_spans(text)
    more = [(*s, 1.0) for s in base]
    found = [("iban", s, e) for s, e in _ibans(text)]
    if "-" in text:
        found += [("national", m.start(), m.end()) for m in _NATIONAL.finditer(text) if m[0][:3] not in ("000", "666") and m[0][0] != "9"]
    if _SECRET_HINT.search(text):
        found += [("secret", m.start(), m.end()) for m in _SECRET.finditer(text)]
    for kind, s, e in found:
        if (score := _context(text, kind, s, e)) >= threshold:
            more.append((kind, s, e, min(1.0, score)))
    return base, sorted(more, key=_order)


def _joined(spans: list[tuple]) -> str:
    return ",".join(f"{x[0]}:{x[1]}:{x[2]}" for x in spans)


def detect(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: counts of the base kinds, their digest, all spans and the best score."""

    def run(batches):
        for batch in batches:
            rows: dict[str, list] = {k: [] for k in ("n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_spans", "top_score")}
            for text in batch.column(1):
                base, every = find_spans(text.as_py())
                for kind in KINDS[:4]:
                    rows[f"n_{kind}"].append(sum(x[0] == kind for x in base))
                rows["base_sha256"].append(hashlib.sha256(_joined(base).encode()).hexdigest())
                rows["spans"].append(_joined(every))
                rows["n_spans"].append(len(every))
                rows["top_score"].append(max((x[3] for x in every), default=0.0))
            types = {"base_sha256": pa.string(), "spans": pa.string(), "top_score": pa.float64()}
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(v, types.get(k, pa.int64())) for k, v in rows.items())], [id_col, *rows])

    kind = df.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_spans long, top_score double"
    return df.select(id_col, text_col).mapInArrow(run, schema)


def redact(df: DataFrame, text_col: str = "text", count_col: str | None = None) -> DataFrame:
    """Texts with each span replaced by its kind in angle brackets; overlapping spans become one, named
    after the first.  ``count_col``, if given, is set to the new length in code points.  A null text stays null."""

    def run(batches):
        for batch in batches:
            names = batch.schema.names
            texts = [clean(t) for t in batch.column(names.index(text_col)).to_pylist()]
            columns = list(batch.columns)
            columns[names.index(text_col)] = pa.array(texts, batch.schema.field(text_col).type)
            if count_col:
                columns[names.index(count_col)] = pa.array([None if t is None else len(t) for t in texts], batch.schema.field(count_col).type)
            yield pa.RecordBatch.from_arrays(columns, names)

    return df.mapInArrow(run, df.schema)


def clean(text: str | None) -> str | None:
    """One text with its spans replaced."""
    spans = find_spans(text)[1]
    if not spans:
        return text
    out, at, merged = [], 0, []
    for kind, s, e, _ in spans:
        if merged and s < merged[-1][2]:
            merged[-1][2] = max(merged[-1][2], e)
        else:
            merged.append([kind, s, e])
    for kind, s, e in merged:
        out += [text[at:s], f"<{kind.upper()}>"]
        at = e
    return "".join(out) + text[at:]
