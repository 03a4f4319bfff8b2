"""Model responses to records: ``KEY: value`` text and JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions.arrays import bound
from ledgerloom.functions.dates import day_first
from ledgerloom.functions.text import MISSING, strip_quantity
from ledgerloom.operators.blocks import repair_json
from ledgerloom.operators.statements import strip


def key_values(raw: Column, first_wins: bool = False) -> Column:
    """A map of upper-case keys from the lines of a response; empty values are left out, of repeated keys the last
    (or the first) counts."""
    lines = F.transform(F.split(raw, "\n"), lambda x: F.trim(x))
    lines = F.filter(lines, lambda x: x.contains(":"))
    pairs = F.transform(lines, lambda x: F.struct(F.upper(F.trim(F.substring_index(x, ":", 1))).alias("k"), F.trim(F.substring(x, F.instr(x, ":") + 1, F.length(x))).alias("v")))
    pairs = F.filter(pairs, lambda p: (p["k"] != "") & (p["v"] != ""))
    pairs = pairs if first_wins else F.reverse(pairs)
    only = F.aggregate(
        pairs, F.array().cast("array<struct<k:string,v:string>>"),
        lambda acc, p: F.when(F.exists(acc, lambda q: q["k"] == p["k"]), acc).otherwise(F.concat(acc, F.array(p))),
    )
    return F.map_from_entries(only)


def json_fields(raw: Column, fields: tuple[str, ...]) -> Column:
    """The outermost ``{...}`` of a response as a map of the expected fields; absent and empty ones are missing."""
    body = F.from_json(F.regexp_extract(raw, r"(?s)\{.*\}", 0), T.MapType(T.StringType(), T.StringType()))
    values = [x for f in fields for x in (F.lit(f), F.coalesce(F.nullif(F.trim(F.element_at(body, f)), F.lit("")), F.lit(MISSING)))]
    return F.create_map(*values)


def looks_like_json(raw: Column | str) -> Column:
    """Fenced or braced text, or one with at least four quotes around keys."""
    t = F.trim(raw)
    return t.rlike(r"(?s)^(```(json)?\s*)?\{") | (F.size(F.regexp_extract_all(t, F.lit('"[A-Za-z_]+"\\s*:'), F.lit(0))) >= 2)


def wide(df: DataFrame, parsed: str, fields: tuple[str, ...]) -> DataFrame:
    """A column for each expected field of a map column, with the missing mark."""
    return df.select("*", *[F.coalesce(F.element_at(parsed, f), F.lit(MISSING)).alias(f) for f in fields])


# What chat models put around an answer, list and address fields, and words that tell an address line.
ARTIFACTS = (
    r"I'll extract.*?\n", r"I can extract.*?\n", r"Here (?:is|are) the.*?\n", r"Based on.*?\n", r"Looking at.*?\n",
    r"<\|start_header_id\|>.*?<\|end_header_id\|>", r"<image>", r"assistant\n\n", r"^\s*Extract.*?below\.\s*\n",
)
LIST_FIELDS = ("LINE_ITEM_", "TRANSACTION_", "ACCOUNT_BALANCE")
ADDRESS_FIELDS = ("BUSINESS_ADDRESS", "PAYER_ADDRESS")
DATE_FIELDS = ("INVOICE_DATE", "TRANSACTION_DATES")
ADDRESS_WORDS = ("street", "road", "avenue", "drive", "lane", "court", "place", "way", "vic", "nsw", "qld", "sa", "wa", "tas", "nt", "act")
_PAIR = "struct<k:string,v:string>"


def _key_value(line: Column) -> Column:
    """(k, v) of a line without markdown and with known slips of keys mended; null without a colon."""
    for pattern, new in (
        (r"\*+([^*]+)\*+", "$1"), (r"^KEY:\s*([A-Z_]+):", "$1:"), (r"^KEY\s+([A-Z_]+):", "$1:"), (r"^DESCRIPTION:", "DESCRIPTIONS:"), (r"^DESCRIPTIONDESCRIPTION:", "DESCRIPTIONS:"),
    ):
        line = F.regexp_replace(line, pattern, new)
    cut = lambda x: F.struct(F.upper(strip(F.substring_index(x, ":", 1))).alias("k"), strip(F.substring(x, F.instr(x, ":") + 1, F.length(x))).alias("v"))
    return F.get(F.transform(F.array(line), lambda x: F.when(F.instr(x, ":") > 0, cut(x))), F.lit(0))


def _folded(events: Column, takes, starts, gives, value) -> Column:
    """The fold that both passes share: an open key collects what it ``takes`` until something else comes; ``starts`` opens a key,
    ``gives`` is what a line adds as it is, ``value`` makes a value of what was collected."""
    none, text = F.array().cast(f"array<{_PAIR}>"), F.lit(None).cast("string")
    state = lambda key, own, out: F.struct(key.alias("key"), own.alias("own"), out.alias("out"))
    closed = lambda s: F.when(s["key"].isNotNull(), F.concat(s["out"], F.array(F.struct(s["key"].alias("k"), value(s["key"], s["own"]).alias("v"))))).otherwise(s["out"])
    empty = F.array().cast("array<string>")

    def step(s: Column, e: Column) -> Column:
        taken = s["key"].isNotNull() & takes(e, s)
        waits = s["key"].isNotNull() & (e["t"] == "") & (F.size(s["own"]) == 0)
        opens, given = starts(e), gives(e)
        fresh = F.when(opens.isNotNull(), state(opens, empty, closed(s))).otherwise(state(text, empty, F.when(given.isNotNull(), F.concat(closed(s), F.array(given))).otherwise(closed(s))))
        return F.when(taken, state(s["key"], F.when(e["t"] == "", s["own"]).otherwise(F.concat(s["own"], F.array(e["t"]))), s["out"])).when(waits, s).otherwise(fresh)

    return F.aggregate(events, state(text, empty, none), step, closed)


def field_lines(df: DataFrame, raw_col: str, fields: tuple[str, ...], list_fields: tuple[str, ...] = (), artifacts: bool = False) -> DataFrame:
    """Adds ``fields``, a map of every expected field, from a response: as JSON (also cut off) where it looks like it, else line by line.

    The first pass reads ``KEY: value``; a list field without a value takes the bullets below it, the last line of a key counts.  Where it
    finds less than half of the fields, a second pass reads bold keys whose values stand on the lines below; it fills gaps only.  Lists then get
    pipes, addresses lose commas, dates become DD/MM/YYYY.  Both passes are folds over the lines.  ``list_fields`` names list fields beside
    those that ``LIST_FIELDS`` tells by their beginning.
    """
    text = F.coalesce(F.col(raw_col), F.lit(""))
    if artifacts:
        for pattern in ARTIFACTS:
            text = F.regexp_replace(text, "(?im)" + pattern, "")
    out = df.withColumn("_text", strip(text))
    body = F.from_json(repair_json(F.col("_text")), T.MapType(T.StringType(), T.StringType()))
    out = out.withColumn("_json", F.when(looks_like_json("_text"), body)).withColumn("_lines", F.split("_text", "\n"))
    known = lambda k: k.isin(*fields)
    listed = lambda k: F.exists(F.array(*map(F.lit, LIST_FIELDS)), lambda p: F.startswith(k, p)) | k.isin(*list_fields)
    bullet = lambda t: t.startswith("*") | t.startswith("-")
    slip = lambda x: F.regexp_replace(F.replace(x, F.lit("*"), F.lit("")), "^LINE_ITEM_DESCRIPTION:", "LINE_ITEM_DESCRIPTIONS:")
    plain = lambda x: F.regexp_replace(F.regexp_replace(x, r"^\s*\*+\s*", ""), r"\*+([^*]+)\*+", "$1")
    or_missing = lambda v: F.coalesce(F.nullif(v, F.lit("")), F.lit(MISSING))
    one = F.transform("_lines", lambda x: F.struct(strip(x).alias("t"), _key_value(slip(plain(x))).alias("p")))
    first = _folded(
        one, lambda e, s: bullet(e["t"]), lambda e: F.when(known(e["p"]["k"]) & (e["p"]["v"] == "") & listed(e["p"]["k"]), e["p"]["k"]),
        lambda e: F.when(known(e["p"]["k"]), F.struct(e["p"]["k"].alias("k"), or_missing(e["p"]["v"]).alias("v"))),
        lambda k, own: or_missing(F.array_join(F.transform(own, lambda x: strip(F.regexp_replace(x, r"^[* -]+", ""))), " | ")),
    )
    mark, start = r"^\*\*([A-Z_\s]+):\*\*\s*(.*)$", r"^\*\*[A-Z_\s]+:\*\*"
    two = F.transform("_lines", lambda x: F.struct(strip(x).alias("t"), F.regexp_replace(F.regexp_extract(strip(x), mark, 1), " ", "_").alias("k"), strip(F.regexp_extract(strip(x), mark, 2)).alias("v")))
    address = lambda t: F.exists(F.array(*map(F.lit, ADDRESS_WORDS)), lambda w: F.contains(F.lower(t), w))
    stops = lambda t: t.rlike(start) | (t.contains(":") & ~address(t))

    def collected(k: Column, own: Column) -> Column:
        stars = F.forall(own, lambda x: x.startswith("*"))
        starless = F.transform(own, lambda x: strip(F.regexp_replace(x, r"^[* ]+", "")))
        return or_missing(F.when(k.startswith("LINE_ITEM_"), F.array_join(F.when(stars, starless).otherwise(own), " | ")).otherwise(F.array_join(own, " ")))

    as_read = lambda e: F.when((e["k"] != "") & (e["v"] != ""), F.concat(e["k"], F.lit(": "), e["v"])).when(e["k"] == "", e["t"])
    second = _folded(
        two, lambda e, s: ~stops(e["t"]), lambda e: F.when((e["k"] != "") & (e["v"] == ""), e["k"]),
        lambda e: F.get(F.transform(F.array(_key_value(as_read(e))), lambda p: F.when(known(p["k"]), F.struct(p["k"].alias("k"), or_missing(p["v"]).alias("v")))), F.lit(0)), collected,
    )
    out = out.withColumns({"_one": first, "_two": second})
    last = lambda f: F.try_element_at(F.filter("_one", lambda p: p["k"] == f), F.lit(-1))["v"]
    gap = lambda f: F.get(F.filter("_two", lambda p: (p["k"] == f) & (p["v"] != MISSING)), F.lit(0))["v"]
    found = F.array_distinct(F.transform(F.filter("_one", lambda p: ~F.exists(F.filter("_one", lambda q: q["k"] == p["k"]), lambda q: q["v"] == MISSING)), lambda p: p["k"]))
    out = out.withColumn("_few", F.size(found) < len(fields) * 0.5)
    by_line = lambda f: F.coalesce(F.nullif(last(f), F.lit(MISSING)), F.when(F.col("_few"), gap(f)), F.lit(MISSING))
    is_json = F.col("_json").isNotNull() & (F.size("_json") > 0)
    of_json = lambda f: bound(strip(F.try_element_at("_json", F.lit(f))), or_missing)
    of_lines = lambda f: bound(by_line(f), lambda v: _tidied(f, v))
    values = [F.when(is_json, of_json(f)).otherwise(of_lines(f)) for f in fields]
    # Spark writes a created map out anew wherever one of its fields is asked for; one from arrays is made once
    out = out.withColumn("fields", F.map_from_arrays(F.array(*map(F.lit, fields)), F.array(*values)))
    return out.drop("_text", "_json", "_lines", "_one", "_two", "_few")


def _tidied(field: str, value: Column) -> Column:
    """A value in the form of its field."""
    if field == "DOCUMENT_TYPE":
        return value
    tidy = value
    if field.startswith(LIST_FIELDS):
        parts = lambda p: F.array_join(F.filter(F.transform(F.split(value, p), strip), lambda x: x != ""), " | ")
        tidy = F.when(value.contains(" | "), value).when(value.contains(","), parts(r",(?!\d)")).when(value.rlike(r"\s{2,}"), parts(r"\s{2,}")).otherwise(value)
        if field == "LINE_ITEM_QUANTITIES":
            tidy = F.array_join(F.transform(F.split(tidy, r" \| "), strip_quantity), " | ")
    elif field in ADDRESS_FIELDS:
        tidy = strip(F.replace(value, F.lit(","), F.lit(" ")))
    if field in DATE_FIELDS:
        tidy = F.array_join(F.transform(F.split(tidy, r" \| "), lambda x: day_first(strip(x))), " | ")
    return F.when(value == MISSING, value).otherwise(tidy)


def link_object(raw: Column, keys: tuple[str, ...], needs: str = "MATCHED_TRANSACTION") -> Column:
    """The outermost ``{...}`` of a link response with the keys that are known; null unless it has the one it ``needs``."""
    body = F.from_json(F.regexp_extract(raw, r"(?s)\{.*\}", 0), T.MapType(T.StringType(), T.StringType()))
    known = F.map_filter(body, lambda k, v: k.isin(*keys))
    whole = F.transform_values(known, lambda k, v: F.coalesce(F.nullif(F.trim(v), F.lit("")), F.lit(MISSING)))
    return F.when(F.map_contains_key(body, needs), whole)


def hybrid(raw: Column, fields: tuple[str, ...]) -> Column:
    """The expected fields of a response, as JSON where it looks like it and can be read, else by its ``KEY: value`` lines."""
    body = F.from_json(F.regexp_extract(raw, r"(?s)\{.*\}", 0), T.MapType(T.StringType(), T.StringType()))
    lines = key_values(raw)
    value = lambda f: F.when(looks_like_json(raw) & body.isNotNull() & (F.size(body) > 0), F.try_element_at(body, F.lit(f))).otherwise(F.try_element_at(lines, F.lit(f)))
    return F.create_map(*[x for f in fields for x in (F.lit(f), F.coalesce(F.nullif(F.trim(value(f)), F.lit("")), F.lit(MISSING)))])


def debit_rows(lists: dict[str, Column], paid: str, strict: bool = False) -> dict[str, Column]:
    """Parallel pipe lists without the places where ``paid`` is missing.  Lists of another length stay as they are, as do all
    where every place or none is missing; ``strict`` raises on unequal lengths."""
    items = {k: F.split(c, r" \| ") for k, c in lists.items()}
    mask = items[paid]
    gone = F.size(F.filter(mask, lambda x: F.trim(x) == MISSING))
    out = {}
    for name, own in items.items():
        kept = F.transform(F.filter(F.arrays_zip(own.alias("x"), mask.alias("m")), lambda p: F.trim(p["m"]) != MISSING), lambda p: p["x"])
        same = F.size(own) == F.size(mask)
        if strict:
            same = F.coalesce(F.when(same, F.lit(True)), F.raise_error(F.lit(f"{name} and {paid} have different lengths")).cast("boolean"))
        out[name] = F.when(same & (gone > 0) & (gone < F.size(mask)), F.array_join(kept, " | ")).otherwise(lists[name])
    return out
