"""Answers of classifiers, short or wordy: what they say of columns, payment, rows and travel, and of a trust document.

Readers go from the strict form to the tolerant one; ``source`` tells which of them gave the type.  Thinking blocks,
also one that was cut off, are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.routing import column_roles, header_list
from ledgerloom.operators.rules import DEFAULT_TYPE, EVIDENCE_RULES, complexity, first_type, trust_type
from ledgerloom.operators.statements import strip

# Labels, their answers, the echo of the question, and the keywords of trust documents in the order they are tried.
_LABEL = r"(?im)^[#>\-*\d.\)\s]*"
_ECHO = r"(?i)yes\s+or\s+no|no\s+or\s+yes"
_TRAVEL = r"(?i)(?:^|\n)\s*(?:#{1,6}\s*\d*\.?\s*|\d+\s*[.\)]\s*)TRAVEL\b"
EVIDENCE = ("HEADER", "HAS_ABN", "HAS_TFN", "HAS_DISTRIBUTION_TABLE", "HAS_ITEM_13", "ADDRESSED_TO")
TRUST_WORDS = (
    ("BENEFICIARY_ITR", ("item 13", "partnerships and trusts", "individual tax return")), ("DISTRIBUTION_STMT", ("distribution statement", "beneficiary distribution")),
    ("INCOME_SCHEDULE", ("schedule", "trust income", "tax offsets")), ("TRUST_RETURN", ("trust return", "trust tax return", "trustee details")),
)


def without_thinking(raw: Column) -> Column:
    closed = F.regexp_replace(raw, r"(?is)<think>.*?</think>", "")
    return strip(F.regexp_replace(F.regexp_replace(closed, r"(?is)<think>.*\z", ""), r"(?i)</?think>", ""))


def _yes_no(text: Column, label: str) -> Column:
    """True or false by ``LABEL: YES`` on one line; null without."""
    found = F.upper(F.regexp_extract(text, _LABEL + label + r"\**\s*:\s*(YES|NO)\b", 1))
    return F.when(found != "", found == "YES")


def _later_travel(text: Column) -> Column:
    """The last yes or no after the last heading of the travel question, the question's own words left out."""
    parts = F.split(F.regexp_replace(text, _TRAVEL, "\u0001"), "\u0001")
    said = F.regexp_extract_all(F.regexp_replace(F.element_at(parts, -1), _ECHO, ""), F.lit(r"(?i)\b(YES|NO)\b"), F.lit(1))
    return (F.size(parts) > 1) & F.coalesce(F.upper(F.try_element_at(said, F.lit(-1))) == "YES", F.lit(False))


def classification(answers: DataFrame, raw: str, roles: dict[str, tuple[str, ...]], rules: tuple[dict, ...] = EVIDENCE_RULES, default: str = DEFAULT_TYPE) -> DataFrame:
    """Adds ``headers``, ``paid``, ``travel``, ``rows``, ``kind``, ``tier`` and ``source`` (``evidence``); all null where the answer has
    no columns label."""
    text = F.col("_text")
    df = answers.withColumn("_text", without_thinking(F.coalesce(raw, F.lit(""))))
    inline = strip(F.regexp_replace(strip(F.regexp_extract(text, _LABEL + r"COLUMNS\**\s*:\s*(.+)$", 1)), r"^[*`]+|[*`]+$", ""))
    piped = F.get(F.filter(F.split(text, "\n"), lambda x: F.length(x) - F.length(F.replace(x, F.lit("|"), F.lit(""))) >= 2), F.lit(0))
    df = df.withColumns({"_asked": text.rlike(r"(?i)\bCOLUMNS\b"), "_inline": inline, "_line": F.coalesce(F.nullif(inline, F.lit("")), strip(piped), F.lit(""))})
    listed = header_list(F.col("_line"))
    df = df.withColumn("_headers", F.when(F.upper("_inline") == "NONE", F.array().cast("array<string>")).otherwise(listed))
    df = df.withColumns({f"_role_{r}": c for r, c in column_roles(F.col("_headers"), roles).items()})
    rows = F.coalesce(F.regexp_extract(text, _LABEL + r"ROWS\**\s*:\s*(\d+)", 1).try_cast("int"), F.lit(0))
    df = df.withColumns({
        "_roles": F.filter(F.array(*[F.when(F.col(f"_role_{r}").isNotNull(), r) for r in roles]), lambda r: r.isNotNull()),
        "_paid": F.coalesce(_yes_no(text, "PAID"), F.lit(False)), "_travel": F.coalesce(_yes_no(text, "TRAVEL"), _later_travel(text)), "_rows": rows,
    })
    c = F.col
    found = {
        "headers": c("_headers"), "paid": c("_paid"), "travel": c("_travel"), "rows": c("_rows"), "kind": first_type(c("_roles"), c("_paid"), c("_travel"), rules, default),
        "tier": complexity(c("_rows")), "source": F.lit("evidence"),
    }
    return df.select(*answers.columns, *[F.when(c("_asked"), v).alias(k) for k, v in found.items()])


def trust_evidence(raw: Column) -> Column:
    """A map of what an answer says: the header's text, YES or NO for the others.  A dashed line is the answer; without one the rest of
    the label's own line.  Labels may be numbered or not, repeated ones count by their last block."""
    label = r"(?i)(?:\d\.\s*)?(?:" + "|".join(EVIDENCE) + r")\s*:"
    text = F.coalesce(raw, F.lit(""))
    marked = F.regexp_replace(text, f"({label})", "\u0001$1\u0002")
    parts = F.filter(F.split(marked, "\u0001"), lambda p: p.contains("\u0002"))

    def read(part: Column) -> Column:
        name, body = F.upper(F.substring_index(part, "\u0002", 1)), F.substring_index(part, "\u0002", -1)
        key = None
        for f in EVIDENCE:
            key = F.when(name.contains(f), f) if key is None else key.when(name.contains(f), f)
        first = strip(F.get(F.split(strip(body), "\n"), F.lit(0)))
        bullet = strip(F.regexp_extract(body, r"(?m)[-–]\s*\*{0,2}(.+?)\*{0,2}\s*$", 1))
        said = F.upper(F.regexp_extract(body, r"(?i)[-–]\s*\*{0,2}(YES|NO)\*{0,2}", 1))
        short = F.upper(F.regexp_extract(first, r"(?i)(YES|NO)", 1))
        filled = lambda *c: F.coalesce(*[F.nullif(x, F.lit("")) for x in c])
        return F.struct(key.alias("k"), F.when(key == "HEADER", filled(bullet, first)).otherwise(filled(said, short)).alias("v"))

    pairs = F.transform(parts, read)
    last = F.filter(pairs, lambda p, i: p["v"].isNotNull() & ~F.exists(F.slice(pairs, i + 2, F.size(pairs)), lambda q: q["k"] == p["k"]))
    return F.map_from_entries(F.transform(last, lambda p: F.struct(p["k"], p["v"])))


def trust_answer(raw: Column) -> dict[str, Column]:
    """``kind``, ``confidence`` and ``source`` of a trust document: by its evidence, else by keywords of the whole answer, else unknown."""
    evidence = trust_evidence(raw)
    yes = lambda f: F.coalesce(F.try_element_at(evidence, F.lit(f)) == "YES", F.lit(False))
    ruled = trust_type(F.try_element_at(evidence, F.lit("HEADER")), yes("HAS_ITEM_13"), yes("HAS_DISTRIBUTION_TABLE"), yes("ADDRESSED_TO"), yes("HAS_ABN"))
    low, word = F.lower(F.coalesce(raw, F.lit(""))), F.lit(None).cast("string")
    for kind, words in reversed(TRUST_WORDS):
        test = low.contains(words[0])
        for w in words[1:]:
            test = test | low.contains(w)
        word = F.when(test, kind).otherwise(word)
    sure = ruled["type"] != ""
    return {
        "kind": F.when(sure, ruled["type"]).otherwise(F.coalesce(word, F.lit("UNKNOWN_TRUST_DOC"))), "confidence": F.when(sure, ruled["confidence"]).when(word.isNotNull(), 0.5).otherwise(0.3),
        "source": F.when(sure, "evidence").when(word.isNotNull(), "keyword").otherwise("none"),
    }
