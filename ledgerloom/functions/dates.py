"""Dates in text, business days, and date scores."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.functions.arrays import bound

# Month names.
MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")
_DMY = r"^(\d{1,2})[/\-.](\d{1,2})[/\-.](\d{2}|\d{4})$"
_DMONY = r"^(\d{1,2})\s+([A-Za-z]+)\s+(\d{2}|\d{4})$"


def _month(name: Column) -> Column:
    # one look-up: a chain of comparisons works the name out again for each of them
    names = {n: i for i, m in enumerate(MONTHS, 1) for n in (m, m[:3])} | {"sept": 9}
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in names.items() for x in pair]), F.lower(name))


def _date(year: Column, month: Column, day: Column) -> Column:
    """A date, or null where there is no such day."""
    return F.try_to_date(F.concat_ws("-", F.lpad(year.cast("string"), 4, "0"), F.lpad(month.cast("string"), 2, "0"), F.lpad(day.cast("string"), 2, "0")), "yyyy-MM-dd")


def _year(text: Column, pivot: int) -> Column:
    value = F.struct(F.length(text).alias("digits"), text.try_cast("int").alias("n"))
    return bound(value, lambda v: F.when(v["digits"] > 2, v["n"]).when(v["n"] <= pivot, 2000 + v["n"]).otherwise(1900 + v["n"]))


def parse_date(c: Column, pivot: int = 68) -> Column:
    """ISO, day first with ``/``, ``-`` or ``.``, or with a month name; two-digit years up to ``pivot`` are 20xx."""
    t = F.trim(c)
    part = lambda pattern, i: F.regexp_extract(t, pattern, i)
    iso = F.when(t.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(t, "yyyy-MM-dd"))
    dmy = F.when(t.rlike(_DMY), _date(_year(part(_DMY, 3), pivot), part(_DMY, 2), part(_DMY, 1)))
    named = F.when(t.rlike(_DMONY) & _month(part(_DMONY, 2)).isNotNull(), _date(_year(part(_DMONY, 3), pivot), _month(part(_DMONY, 2)), part(_DMONY, 1)))
    return F.coalesce(iso, dmy, named)


def _weekdays_until(d: Column) -> Column:
    """Weekdays from a Monday long ago up to the day itself."""
    n = F.datediff(d, F.to_date(F.lit("1900-01-01")))
    return F.floor(n / 7) * 5 + F.least(F.pmod(n, F.lit(7)) + 1, F.lit(5))


def business_days(a: Column, b: Column) -> Column:
    """Monday to Friday days after the earlier date up to the later one."""
    return F.abs(_weekdays_until(b) - _weekdays_until(a)).cast("long")


def date_score(a: Column, b: Column, window: int = 5) -> Column:
    """1 on the same business day, falling in a line to 0 beyond the window; 0 without both dates."""
    n = business_days(a, b)
    return F.when(a.isNull() | b.isNull() | (n > window), 0.0).when(n == 0, 1.0).otherwise(F.greatest(F.lit(0.0), 1.0 - n / F.lit(window + 1)))


def near_dates(a: Column, b: Column, days: int) -> Column:
    return F.coalesce(F.abs(F.datediff(a, b)) <= days, F.lit(False))


def _named_month(low: Column) -> Column:
    """The number of the first month of the year whose short name a lower-case text holds; null without one."""
    short = F.split(F.lit(",".join(m[:3] for m in MONTHS)), ",")
    place = F.array_position(short, F.get(F.filter(short, lambda m: F.contains(low, m)), F.lit(0)))
    return place.cast("int")


def date_parts(c: Column, pivot: int = 50) -> Column:
    """(day, month, year) by position, as the scorer reads them: digit runs in turn, a month name if there is one."""
    text = F.regexp_replace(F.lower(c), r"^(mon|tue|wed|thu|fri|sat|sun)[a-z]*[\s,]+", "")
    runs = F.transform(F.regexp_extract_all(text, F.lit(r"\d+"), F.lit(0)), lambda x: x.try_cast("int"))
    named = _named_month(text)
    year = F.when(named.isNotNull(), F.get(runs, F.lit(1))).otherwise(F.get(runs, F.lit(2)))
    full = F.when(year < 100, F.when(year < pivot, 2000 + year).otherwise(1900 + year)).otherwise(year)
    return F.struct(F.get(runs, F.lit(0)).alias("d"), F.coalesce(named, F.get(runs, F.lit(1))).alias("m"), full.alias("y"))


def same_parts(a: Column, b: Column) -> Column:
    """Known parts agree and at least two do."""
    hits = [F.when(a[k].isNotNull() & b[k].isNotNull(), (a[k] == b[k]).cast("int")) for k in ("d", "m", "y")]
    clash = F.lit(False)
    total = F.lit(0)
    for h in hits:
        clash = clash | F.coalesce(h == 0, F.lit(False))
        total = total + F.coalesce(h, F.lit(0))
    return ~clash & (total >= 2)


def known_parts(c: Column) -> Column:
    """(d, m, y) as two- and four-digit texts: three numbers, or two or one with a month's name; null for anything else."""

    def read(v: Column) -> Column:
        low, runs = v["low"], v["runs"]
        at, n = lambda k: F.get(runs, F.lit(k)), F.size(runs)
        named = F.lpad(_named_month(low).cast("string"), 2, "0")
        pad = lambda x: F.when(F.length(x) < 2, F.lpad(x, 2, "0")).otherwise(x)
        year = F.when(n == 3, at(2)).when(n == 2, at(1))
        full = F.when(F.length(year) == 2, F.when(year <= "50", F.concat(F.lit("20"), year)).otherwise(F.concat(F.lit("19"), year))).otherwise(year)
        month = F.when(n == 3, at(1)).otherwise(named)
        return F.when((n == 3) | (n == 2) | ((n == 1) & named.isNotNull()), F.struct(pad(at(0)).alias("d"), pad(month).alias("m"), full.alias("y")))

    return bound(F.struct(F.lower(c).alias("low"), F.regexp_extract_all(c, F.lit(r"\d+"), F.lit(0)).alias("runs")), read)


def parts_agree(a: Column, b: Column) -> Column:
    """Whether two ``known_parts`` have two equal parts and none that differ."""
    same = [a[k] == b[k] for k in ("d", "m", "y")]
    hits = sum(F.coalesce(x, F.lit(False)).cast("int") for x in same)
    return F.coalesce(F.forall(F.array(*same), lambda x: F.coalesce(x, F.lit(True))) & (hits >= 2), F.lit(False))


def alike(a: Column, b: Column) -> Column:
    """Equal texts, or dates whose known parts agree, two of them at least."""
    parts = bound(F.struct(known_parts(a).alias("a"), known_parts(b).alias("b")), lambda v: parts_agree(v["a"], v["b"]))
    return (F.trim(a) == F.trim(b)) | parts


# Shapes of dates as (pattern, groups of day, month and year).
_SHAPES = {
    "d/m/Y": (r"^(\d{1,2})/(\d{1,2})/(\d{4})$", 1, 2, 3), "m/d/Y": (r"^(\d{1,2})/(\d{1,2})/(\d{4})$", 2, 1, 3), "d-m-Y": (r"^(\d{1,2})-(\d{1,2})-(\d{4})$", 1, 2, 3),
    "d/m/y": (r"^(\d{1,2})/(\d{1,2})/(\d{2})$", 1, 2, 3), "Y-m-d": (r"^(\d{4})-(\d{1,2})-(\d{1,2})$", 3, 2, 1),
    "d b Y": (r"^(\d{1,2})\s+([A-Za-z]{3})\s+(\d{4})$", 1, 2, 3), "d B Y": (r"^(\d{1,2})\s+([A-Za-z]{3,9})\s+(\d{4})$", 1, 2, 3), "d-b-y": (r"^(\d{1,2})-([A-Za-z]{3})-(\d{2})$", 1, 2, 3),
    "d b y": (r"^(\d{1,2})\s+([A-Za-z]{3,9})\s+(\d{2})$", 1, 2, 3), "a d b Y": (r"^(?i)(?:mon|tue|wed|thu|fri|sat|sun)\s+(\d{1,2})\s+([A-Za-z]{3})\s+(\d{4})$", 1, 2, 3),
    "d b": (r"^(\d{1,2})\s+([A-Za-z]{3,9})$", 1, 2, 0), "*d b Y*": (r"(\d{1,2})\s+([A-Za-z]{3})\s+(\d{4})", 1, 2, 3),
}
STATEMENT_LADDER = ("a d b Y", "d/m/Y", "d-b-y", "d b Y", "Y-m-d", "d/m/y", "*d b Y*")
REGISTER_LADDER = ("d/m/Y", "d B Y", "a d b Y", "Y-m-d", "m/d/Y", "d/m/y", "d b y", "d b")
REPORT_LADDER = ("d/m/Y", "d-m-Y", "Y-m-d", "d B Y", "d/m/y")


def ladder(c: Column, shapes: tuple[str, ...]) -> Column:
    """The date by the first shape that fits; two-digit years up to 68 are 20xx, a missing year is 1900."""

    def read(t: Column) -> Column:
        out = []
        for shape in shapes:
            pattern, d, m, y = _SHAPES[shape]
            part = lambda i, pattern=pattern: F.regexp_extract(t, pattern, i)
            month = F.coalesce(part(m).try_cast("int"), _month(part(m)))
            year = _year(part(y), 68) if y else F.lit(1900)
            out.append(F.when(t.rlike(pattern), _date(year, month, part(d))))
        return F.coalesce(*out)

    return bound(F.trim(c), read)


def day_first(c: Column) -> Column:
    """A date as DD/MM/YYYY where one of the usual shapes fits, else the text as it is."""
    return F.coalesce(F.date_format(ladder(c, (*REGISTER_LADDER[:7], "d-m-Y", "*d b Y*")), "dd/MM/yyyy"), c)


def date_tuple(c: Column) -> Column:
    """(d, m, y) by position: three numbers, or two and a month's name, or two and the year 2000; null for fewer."""

    def read(v: Column) -> Column:
        low, runs = v["low"], v["runs"]
        at = lambda k: F.get(runs, F.lit(k))
        named = _named_month(low)
        many = F.size(runs) >= 3
        year = F.when(many, at(2)).when(named.isNotNull(), at(1)).otherwise(F.lit(0))
        full = bound(year, lambda y: F.when(y < 100, F.when(y <= 50, 2000 + y).otherwise(1900 + y)).otherwise(y))
        return F.when(F.size(runs) >= 2, F.struct(at(0).alias("d"), F.when(many, at(1)).otherwise(F.coalesce(named, at(1))).alias("m"), full.alias("y")))

    low = F.lower(F.trim(c))
    runs = F.transform(F.regexp_extract_all(low, F.lit(r"\d+"), F.lit(0)), lambda x: x.try_cast("int"))
    return bound(F.struct(low.alias("low"), runs.alias("runs")), read)


RANGE_MARKS = (" - ", " to ", " – ", " — ", "-")


def date_range(c: Column) -> Column:
    """The dates of a text: both ends of a range, by the first mark that parts it into two of five signs or more, or one."""
    cut = lambda m: F.filter(F.transform(F.split(c, m), lambda x: F.trim(x)), lambda x: F.length(x) > 4)
    tried = F.transform(F.array(*map(F.lit, RANGE_MARKS)), lambda m: F.struct(F.contains(F.lower(c), m).alias("has"), cut(m).alias("parts")))
    parts = F.get(F.filter(tried, lambda k: k["has"] & (F.size(k["parts"]) >= 2)), F.lit(0))["parts"]
    ends = F.filter(F.transform(F.slice(parts, 1, 2), date_tuple), lambda x: x.isNotNull())
    whole = F.filter(F.array(date_tuple(c)), lambda x: x.isNotNull())
    return bound(ends, lambda found: F.when(F.coalesce(F.size(found), F.lit(0)) > 0, found).otherwise(whole))


def date_ends(c: Column) -> Column:
    """The different dates of a text, as ``date_range`` reads them."""
    return F.array_distinct(date_range(c))


def date_field_score(value: Column, truth: Column) -> Column:
    """1 for the same dates, the common share where some agree, 0.8 for the same first day and month, else 0."""
    return date_ends_score(date_ends(value), date_ends(truth))


def date_ends_score(a: Column, b: Column) -> Column:
    """``date_field_score`` of two ``date_ends``."""

    def score(v: Column) -> Column:
        a, b = v["a"], v["b"]
        first = lambda x: F.get(x, F.lit(0))
        common = F.size(F.array_intersect(a, b))
        alike = (first(a)["d"] == first(b)["d"]) & (first(a)["m"] == first(b)["m"])
        return F.when((F.size(a) == 0) | (F.size(b) == 0), 0.0).when(common > 0, common / F.greatest(F.size(a), F.size(b))).when(alike, 0.8).otherwise(0.0)

    return bound(F.struct(a.alias("a"), b.alias("b")), score)
