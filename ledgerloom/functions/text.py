"""String similarity and cleaning of document fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.functions.arrays import bound

MISSING = "NOT_FOUND"


def anls(a: Column, b: Column) -> Column:
    """One minus the edit distance over the longer length, on lower case; two empty texts are alike."""
    x, y = F.lower(F.trim(a)), F.lower(F.trim(b))
    longest = F.greatest(F.length(x), F.length(y))
    return F.when(longest == 0, 1.0).otherwise(1.0 - F.levenshtein(x, y) / longest)


def anls_floored(a: Column, b: Column, floor: float = 0.5) -> Column:
    return bound(anls(a, b), lambda s: F.when(s >= floor, s).otherwise(0.0))


def words(c: Column) -> Column:
    """Distinct lower-case words."""
    return F.array_distinct(F.filter(F.split(F.lower(F.trim(c)), r"\s+"), lambda w: w != ""))


def jaccard(a: Column, b: Column) -> Column:
    """Shared words over all words; without any, whether the texts are equal."""
    return shared_words(words(a), words(b), a == b)


def shared_words(x: Column, y: Column, equal: Column) -> Column:
    """Shared over all of two arrays of distinct words; without any, whether the texts are equal."""
    n, common = F.size(x) + F.size(y), F.size(F.array_intersect(x, y))
    return F.when(n == 0, equal.cast("double")).otherwise(common / (n - common))


def fuzzy_equal(a: Column, b: Column, anls_least: float = 0.9, words_least: float = 0.75) -> Column:
    return (anls(a, b) >= anls_least) | (jaccard(a, b) >= words_least)


def read_text(c: Column) -> Column:
    """A text as ``fuzzy_equal`` compares it, read once however often it is compared."""
    return bound(F.lower(F.trim(c)), lambda low: F.struct(low.alias("low"), F.array_distinct(F.filter(F.split(low, r"\s+"), lambda w: w != "")).alias("words"), F.length(low).alias("n")))


def reads_equal(a: Column, b: Column, anls_least: float = 0.9, words_least: float = 0.75) -> Column:
    """``fuzzy_equal`` of two texts of ``read_text``; edits are counted only where the lengths leave a chance, and only so far as they matter."""
    longest, n, m = F.greatest(a["n"], b["n"]), F.size(a["words"]), F.size(b["words"])
    shared = (F.least(n, m) / F.greatest(n, m) >= words_least) & (shared_words(a["words"], b["words"], F.lit(True)) >= words_least)
    most = F.floor(longest * (1.0 - anls_least)).cast("int") + 1
    near = lambda d: (d >= 0) & (1.0 - d / longest >= anls_least)
    edits = (1.0 - F.abs(a["n"] - b["n"]) / longest >= anls_least) & bound(F.call_function("levenshtein", a["low"], b["low"], most), near)
    return (longest == 0) | (a["low"] == b["low"]) | F.when(longest > 0, edits) | F.when(F.greatest(n, m) > 0, shared).otherwise(F.lit(False))


def tokens(c: Column) -> Column:
    """Upper-case words; ``&`` is AND, ASCII punctuation goes."""
    bare = F.regexp_replace(F.regexp_replace(F.upper(c), "&", "AND"), r"""[!"#$%'()*+,\-./:;<=>?@\[\\\]^_`{|}~]""", "")
    return F.filter(F.split(bare, r"\s+"), lambda w: w != "")


def containment(name: Column, description: Column) -> Column:
    """Share of the name's words, repeats counted, that the description has; 0 for missing ones."""
    a, b = tokens(name), tokens(description)
    none = name.isNull() | (F.upper(F.trim(name)) == MISSING) | description.isNull() | (F.size(a) == 0) | (F.size(b) == 0)
    return F.when(none, 0.0).otherwise(F.size(F.filter(a, lambda w: F.array_contains(b, w))) / F.size(a))


def description_matches(expected: Column, actual: Column) -> Column:
    """Equal, one within the other, or half of the expected distinct words found."""
    e, a = F.lower(F.trim(expected)), F.lower(F.trim(actual))
    x, y = words(expected), words(actual)
    return (e == a) | a.contains(e) | e.contains(a) | ((F.size(x) > 0) & (F.size(F.array_intersect(x, y)) * 2 >= F.size(x)))


def strip_quantity(c: Column) -> Column:
    """``3x``, ``x3`` and ``3 EACH`` become ``3``; anything else stays."""
    t = F.trim(c)
    for pattern in (r"^(?i)([0-9]+(?:\.[0-9]+)?)\s*x$", r"^(?i)x\s*([0-9]+(?:\.[0-9]+)?)$", r"^([0-9]+(?:\.[0-9]+)?)\s+[A-Za-z]+$"):
        t = F.regexp_replace(t, pattern, "$1")
    return t


def split_items(c: Column, keep_blank: bool = False) -> Column:
    """Items of a pipe list, trimmed."""
    items = F.transform(F.split(c, r"\|"), lambda x: F.trim(x))
    return items if keep_blank else F.filter(items, lambda x: x != "")


def join_items(items: Column) -> Column:
    """A pipe list; an empty one is the missing mark."""
    return F.coalesce(F.nullif(F.array_join(items, " | "), F.lit("")), F.lit(MISSING))


def case_id(name: Column) -> Column:
    """``CASE`` and its digits at the start of a name, or ``_ungrouped``."""
    return F.coalesce(F.nullif(F.regexp_extract(F.upper(name), r"^(CASE\d+)", 1), F.lit("")), F.lit("_ungrouped"))


def base_type(c: Column) -> Column:
    """A document type without its layout suffix."""
    return F.regexp_replace(c, r"(?i)(_flat|_date_grouped)$", "")


def clean_date(c: Column) -> Column:
    """Labels and trailing punctuation go, white space is single."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.regexp_replace(c, r"(?i)^(date|dated)\s*:?\s*", ""), r"[.,;]+$", ""), r"\s+", " "))


def clean_id(c: Column) -> Column:
    """Labels go; eleven digits lose their blanks."""
    bare = F.trim(F.regexp_replace(c, r"(?i)^(ABN|ACN|BSB|TFN)\s*:?\s*", ""))
    packed = F.regexp_replace(bare, r"\s", "")
    return F.when(packed.rlike(r"^\d{11}$"), packed).otherwise(bare)


def overlap_equal(a: Column, b: Column, least: float = 0.85) -> Column:
    """Share of the first text's characters that occur in the second; three characters or fewer must be equal."""
    common = F.size(F.filter(F.split(a, ""), lambda ch: (ch != "") & F.contains(b, ch)))
    return F.when(F.length(b) <= 3, a == b).when(F.length(a) == 0, False).otherwise(common / F.greatest(F.length(a), F.length(b)) >= least)


def tier_of(name: Column) -> Column:
    """The severity tier that a file name's ending tells."""
    stem = F.regexp_replace(F.substring_index(name, "/", -1), r"\.[^.]*$", "")
    return F.when(stem.endswith("_v1"), "light").when(stem.endswith("_v2"), "moderate").when(stem.endswith("_v3"), "heavy").otherwise("clean")


def fill(template: Column, values: dict[str, tuple[Column, str | None]]) -> Column:
    """A text with each ``{name}`` replaced by its value, or by the default (or the name) where that is null."""
    out = template
    for name, (value, default) in values.items():
        out = F.replace(out, F.lit("{" + name + "}"), F.coalesce(value, F.lit(default if default is not None else name)))
    return out
