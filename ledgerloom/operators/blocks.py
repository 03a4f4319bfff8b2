"""Responses in blocks: receipt and match blocks, link answers as JSON or blocks, and JSON that was cut off.

A block begins with a line like ``--- RECEIPT 2 ---``; what stands before the first is not read.  Within a block the last
line of a key counts.  Blocks without any known key are left out.  Null and empty responses have no blocks.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions.arrays import bound
from ledgerloom.operators.statements import lines_of, strip

# The header of a block, its keys, and stores that stand for no answer.
HEADER = r"(?i)^(?:---\s*)?RECEIPT\s+\d+"
RECEIPT_KEYS = ("STORE", "DATE", "TOTAL")
MATCH_KEYS = (
    "MATCHED_TRANSACTION", "TRANSACTION_DATE", "TRANSACTION_AMOUNT", "TRANSACTION_DESCRIPTION", "RECEIPT_STORE", "RECEIPT_TOTAL",
    "AMOUNT_CHECK", "NAME_CHECK", "CONFIDENCE", "MISMATCH_TYPE", "REASONING",
)
LINK_KEYS = ("RECEIPT_STORE", "RECEIPT_DATE", "RECEIPT_TOTAL", "MATCHED_TRANSACTION", "TRANSACTION_DATE", "TRANSACTION_AMOUNT", "TRANSACTION_DESCRIPTION", "CONFIDENCE", "REASONING")
PLACEHOLDERS = ("not specified", "unknown", "n/a", "none", "next purchase")


def key_blocks(text: Column, keys: tuple[str, ...], bare: bool = False) -> Column:
    """An array of maps, one for each block; with ``bare`` a key's line may lack the colon and is then empty."""
    lines = F.transform(lines_of(text), lambda x: F.struct(x.rlike(HEADER).alias("h"), x.alias("x")))

    def read(x: Column) -> Column:
        key = F.upper(strip(F.substring_index(x, ":", 1)))
        value = F.when(F.instr(x, ":") > 0, strip(F.substring(x, F.instr(x, ":") + 1, F.length(x)))).otherwise("")
        known = lambda k: k.isin(*keys) & (F.lit(True) if bare else F.instr(x, ":") > 0)
        return bound(key, lambda k: F.when(known(k), F.struct(k.alias("k"), value.alias("v"))))

    def cut(all_: Column) -> Column:
        n = F.size(all_)
        starts = F.filter(F.transform(all_, lambda e, i: F.when(e["h"], i)), lambda i: i.isNotNull())
        span = lambda heads: lambda a, k: F.slice(all_, a + 2, F.coalesce(F.get(heads, k + 1), n) - a - 1)
        return F.transform(bound(starts, lambda heads: F.transform(heads, span(heads))), block)

    def block(span: Column) -> Column:
        pairs = F.filter(F.transform(span, lambda e: read(e["x"])), lambda p: p.isNotNull())
        last = lambda own: F.filter(own, lambda p, i: ~F.exists(F.slice(own, i + 2, F.size(own)), lambda q: q["k"] == p["k"]))
        return F.map_from_entries(F.transform(bound(pairs, last), lambda p: F.struct(p["k"], p["v"])))

    return F.filter(F.get(F.transform(F.array(lines), cut), F.lit(0)), lambda m: F.size(m) > 0)


def receipt_blocks(text: Column) -> Column:
    return key_blocks(text, RECEIPT_KEYS)


def purchases(blocks: Column) -> Column:
    """The receipts as numbered lines for a prompt."""
    of = lambda m, k: F.coalesce(F.try_element_at(m, F.lit(k)), F.lit("UNKNOWN"))
    line = lambda m, i: F.concat(F.lit("Purchase "), (i + 1).cast("string"), F.lit(": "), of(m, "STORE"), F.lit(", date "), of(m, "DATE"), F.lit(", total "), of(m, "TOTAL"))
    return F.array_join(F.transform(blocks, line), "\n")


def match_blocks(text: Column) -> Column:
    return key_blocks(text, MATCH_KEYS)


def is_placeholder(block: Column) -> Column:
    """An answer without a store, or with one that only stands in for it."""
    store = F.coalesce(F.try_element_at(block, F.lit("RECEIPT_STORE")), F.lit(""))
    return (store == "") | store.startswith("[") | F.lower(store).isin(*PLACEHOLDERS)


def link_answers(text: Column) -> Column:
    """The answers of a link response, placeholders left out: the outermost JSON object if it has the decision, else the blocks."""
    body = F.from_json(F.regexp_extract(text, r"(?s)\{.*\}", 0), T.MapType(T.StringType(), T.StringType()))
    upper = F.transform_keys(body, lambda k, v: F.upper(strip(k)))
    known = F.transform_values(F.map_filter(upper, lambda k, v: k.isin(*LINK_KEYS)), lambda k, v: strip(F.coalesce(v, F.lit(""))))
    answers = bound(known, lambda k: F.when(F.map_contains_key(k, "MATCHED_TRANSACTION"), F.array(k)).otherwise(key_blocks(text, LINK_KEYS, bare=True)))
    return F.filter(answers, lambda m: ~is_placeholder(m))


# --- JSON that was cut off -----------------------------------------------------------------------
_STRING = r'"[^"\\]*+(?:\\(?:u[0-9a-fA-F]{4}|[^u])[^"\\]*+)*+'
_TOKEN = rf'{_STRING}"?+|[{{}}\[\]:,]|[^\s{{}}\[\]:,"]+'
_WHOLE = rf'(?s)^{_STRING}"$'
_LITERAL = r"^(?:true|false|null|-?(?:0|[1-9]\d*)(?:\.\d+)?(?:[eE][+-]?\d+)?)$"


def _tokens(text: Column) -> Column:
    """(t, kind): ``open``, ``close``, ``colon``, ``comma``, ``text``, ``cut`` (a text without its end), ``word`` or ``bad``."""
    kind = lambda t: (
        F.when(t.isin("{", "["), "open").when(t.isin("}", "]"), "close").when(t == ":", "colon").when(t == ",", "comma")
        .when(t.startswith('"'), F.when(t.rlike(_WHOLE), "text").otherwise("cut")).when(t.rlike(_LITERAL), "word").otherwise("bad")
    )
    return F.transform(F.regexp_extract_all(text, F.lit(_TOKEN), F.lit(0)), lambda t: F.struct(t.alias("t"), kind(t).alias("kind")))


def repair_json(text: Column, keep_cut: bool = True) -> Column:
    """The longest beginning of a JSON object that can be closed, closed: missing commas between fields are put in, commas before
    an end and what follows the object go.  With ``keep_cut`` a text or number that the cut went through stays as far as it came,
    else it goes with its key.  Fences and words before the object are not read; null without an object.

    The fold carries the open brackets and what may come next (a key, colon, value, or the end of a value) over the tokens,
    and the last place where the object could be closed.
    """
    start = F.regexp_extract(text, r"(?s)\{.*", 0)
    tokens = F.filter(_tokens(start), lambda e: e["kind"].isNotNull())

    def trimmed(all_: Column) -> Column:
        # a number that the cut went through ends with its last digit
        number = lambda e: F.regexp_replace(e["t"], r"[.eE+-]+$", "")
        cut = lambda e, i: (i == F.size(all_) - 1) & (e["kind"] == "bad") & number(e).rlike(_LITERAL)
        return F.transform(all_, lambda e, i: F.when(cut(e, i), F.struct(number(e).alias("t"), F.lit("word").alias("kind"))).otherwise(e))

    def tidy(all_: Column) -> Column:
        # commas before an end go; a field that follows a value gets one
        after = lambda i, k: F.get(all_, i + k)["kind"]
        return bound(F.filter(all_, lambda e, i: ~((e["kind"] == "comma") & F.coalesce(after(i, 1) == "close", F.lit(False)))), with_commas)

    def with_commas(kept: Column) -> Column:
        nxt = lambda i, k: F.get(kept, i + k)["kind"]
        ends = lambda e: e["kind"].isin("text", "word", "close")
        comma = F.struct(F.lit(",").alias("t"), F.lit("comma").alias("kind"))
        gap = lambda e, i: F.coalesce(ends(e) & (nxt(i, 1) == "text") & (nxt(i, 2) == "colon"), F.lit(False))
        return F.flatten(F.transform(kept, lambda e, i: F.when(gap(e, i), F.array(e, comma)).otherwise(F.array(e))))

    def state(stack: Column, want: Column, n: Column, at: Column, closing: Column) -> Column:
        return F.struct(stack.alias("stack"), want.alias("want"), n.alias("n"), at.alias("at"), closing.alias("closing"))

    def step(s: Column, e: Column) -> Column:
        t, kind, stack, want = e["t"], e["kind"], s["stack"], s["want"]
        top, n = F.substring(stack, 1, 1), s["n"] + 1
        object_ = top == "}"
        value_end = (want == "value") & kind.isin("text", "word")
        push = F.concat(F.when(t == "{", "}").otherwise("]"), stack)
        opens = (kind == "open") & (want == "value")
        closes = (kind == "close") & (t == top) & ((want == "end") | want.isin("key", "value") & (s["at"] == s["n"]))  # the latter: just opened
        cut = (kind == "cut") & (want == "value") & F.lit(keep_cut)
        new = F.when(opens, push).when(closes, F.substring(stack, F.lit(2), F.length(stack))).otherwise(stack)
        next_ = (
            F.when(opens, F.when(t == "{", "key").otherwise("value")).when(closes, F.when(F.length(stack) == 1, "done").otherwise("end")).when(value_end, "end")
            .when((want == "key") & (kind == "text"), "colon").when((want == "colon") & (kind == "colon"), "value")
            .when((want == "end") & (kind == "comma"), F.when(object_, "key").otherwise("value")).otherwise("done")
        )
        safe = opens | closes | value_end | cut
        live = want != "done"
        return F.when(live, state(new, next_, n, F.when(safe, n).otherwise(s["at"]), F.when(cut, F.concat(F.lit('"'), stack)).when(safe, new).otherwise(s["closing"]))).otherwise(s)

    def whole(all_: Column) -> Column:
        # the very last word may be cut too: without keep_cut it is no value
        last = F.size(all_) - 1
        if not keep_cut:
            return bound(F.filter(all_, lambda e, i: ~((i == last) & (e["kind"] == "word"))), folded)
        return folded(all_)

    def folded(seen: Column) -> Column:
        none = state(F.lit(""), F.lit("value"), F.lit(0), F.lit(0), F.lit(""))
        end = lambda s: F.concat(F.array_join(F.transform(F.slice(seen, F.lit(1), s["at"]), lambda e: e["t"]), ""), s["closing"])
        return F.aggregate(seen, none, step, end)

    # each step is worked out once: without that a token reads all tokens again, and again for each step before it
    closed = bound(bound(bound(tokens, trimmed), tidy), whole)
    return F.when(start != "", closed)
