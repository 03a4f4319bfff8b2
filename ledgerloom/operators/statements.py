"""Statement transcripts to transaction rows: dated blocks of labelled lines, read by a fold over the lines.

Each line first becomes one event (a date, a labelled value, a line that goes on, or nothing) by expressions alone;
the fold then carries the open date, the open row and whether its description may go on.  Two forms are known:

* ``balance``: description, debit, credit and balance under a date; bold, starred and dashed labels;
* ``amount``: description, one signed amount and perhaps a balance; an unlabelled line under a date is the description.

A second description under one date opens a new row.  A row whose date is not known yet waits for it, unless
another description comes first, then it stays without one.  Null and empty texts give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The shapes of date lines, in order, and the labels of each role.
_LABEL = r"(?i)^\d*\.?\s*\*?\*?Date:?\*?\*?\s*(.+)$"
_NUMBERED = r"^\d+\.\s*\*?\*?"
_DAY_MONTH = r"\d{1,2}\s+[A-Za-z]{3,9}"
DATE_LINES = {
    "balance": (
        r"^\*\*(\d{1,2}/\d{1,2}/\d{4})\*\*$", _NUMBERED + r"([A-Za-z]{3}\s+\d{1,2}\s+[A-Za-z]{3}\s+\d{4})\*?\*?", _NUMBERED + r"(\d{1,2}\s+[A-Za-z]{3}\s+\d{4})\*?\*?",
        _NUMBERED + r"(\d{1,2}/\d{1,2}/\d{4})\*?\*?", _NUMBERED + rf"\[({_DAY_MONTH})\]\*?\*?", _NUMBERED + rf"({_DAY_MONTH})\*?\*?$", _NUMBERED + rf"({_DAY_MONTH}\s+\d{{2}})\*?\*?$",
    ),
    "amount": (
        _NUMBERED + r"(\d{1,2}[/\-]\d{1,2}[/\-]\d{2,4})\*?\*?", _NUMBERED + r"(\d{1,2}\s+[A-Za-z]{3}\s+\d{4})\*?\*?",
        _NUMBERED + rf"\[({_DAY_MONTH})\]\*?\*?", _NUMBERED + rf"({_DAY_MONTH})\*?\*?$", _NUMBERED + rf"({_DAY_MONTH}\s+\d{{2}})\*?\*?$",
    ),
}
FIELD_LINES = {
    "balance": (r"(?i)^\*\*([^*:]+)(?:\s*Amount)?:?\*\*\s*(.+)$", r"^\*\s*([^:]+):\s*(.+)$", r"^-\s*([^:]+):\s*(.+)$"),
    "amount": (r"^[-*]\s*([^:]+):\s*(.+)$",),
}
LABELS = {
    "balance": {
        "description": ("description", "transaction", "details", "particulars"), "debit": ("debit", "withdrawal", "withdrawwal", "dr"),
        "credit": ("credit", "deposit", "cr"), "balance": ("balance",), "amount": ("amount",),
    },
    "amount": {"description": ("description", "details", "transaction details"), "amount": ("amount",), "balance": ("balance",)},
}
_GOES_ON = r"^-\s+(.+)$"
# How all those lines begin; the patterns are tried on no others.
_DATE_START = r"(?i)^(?:\d+\.|\*\*\d|\d*\.?\s*\*?\*?Date)"
_FIELD_START = {"balance": (r"^\*\*", r"^\*", "^-"), "amount": ("^[-*]",)}
# All white space of Unicode.
WHITE = "\t\n\v\f\r \u0085\u00a0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
VALUES = ("description", "debit", "credit", "amount", "balance")
_ROW = "struct<date:string," + ",".join(f"{v}:string" for v in VALUES) + ">"
ROWS = f"array<{_ROW}>"


def strip(c: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.btrim(c, F.lit(WHITE))


def lines_of(text: Column) -> Column:
    """The lines of a text, stripped, without empty ones."""
    return F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), strip), lambda x: x != "")


def _first(items: list[Column], test=lambda x: x != "") -> Column:
    """The first item that passes, each worked out once; null without one."""
    return F.get(F.filter(F.array(*items), test), F.lit(0))


def read_line(line: Column, form: str) -> Column:
    """(date, field (name, value), more) of a stripped line; null where it has none."""
    group = lambda p, k=1: strip(F.regexp_extract(line, p, k))
    labelled = strip(F.regexp_replace(group(_LABEL), r"^\*+|\*+$", ""))
    date = F.when(line.rlike(_DATE_START), _first([labelled, *map(group, DATE_LINES[form])]))
    name = lambda p: strip(F.replace(F.lower(group(p)), F.lit(" amount"), F.lit(""))) if form == "balance" else F.lower(group(p))
    named = lambda p: F.struct(name(p).alias("name"), group(p, 2).alias("value"))
    field = _first([F.when(line.rlike(_FIELD_START[form][k]), named(p)) for k, p in enumerate(FIELD_LINES[form])], lambda x: x["name"] != "")
    return F.struct(date.alias("date"), field.alias("field"), _first([group(_GOES_ON)]).alias("more"))


def line_event(read: Column, form: str, columns: dict[str, str]) -> Column:
    """(kind, value) of what a line says: kind is ``date``, a role, ``other``, ``more`` or null."""
    name, value, role = read["field"]["name"], read["field"]["value"], F.lit("other")
    for kind, words in reversed(LABELS[form].items()):
        if form == "amount" and kind == "balance" and columns and kind not in columns:
            continue
        own = (columns[kind].lower(),) if kind in columns and (form, kind) != ("balance", "balance") else ()
        role = F.when(name.isin(*words, *own), kind).otherwise(role)
    labelled = F.coalesce(value != "", F.lit(False))
    kind = F.when(read["date"].isNotNull(), "date").when(labelled, role).when(read["more"].isNotNull(), "more")
    return F.struct(kind.alias("kind"), F.when(read["date"].isNotNull(), read["date"]).when(labelled, value).otherwise(read["more"]).alias("value"))


def _row(row: Column, **changes: Column) -> Column:
    return F.struct(*[changes.get(v, row[v]).cast("string").alias(v) for v in ("date", *VALUES)])


def _step(form: str):
    """The next state from (date, row, on, rows) and an event."""
    nothing = F.lit(None).cast(_ROW)
    empty = F.struct(*[F.lit(None).cast("string").alias(v) for v in ("date", *VALUES)])

    def state(date: Column, row: Column, on: Column, rows: Column) -> Column:
        return F.struct(date.alias("date"), row.alias("row"), on.alias("on"), rows.alias("rows"))

    def step(s: Column, e: Column) -> Column:
        kind, value, row = e["kind"], e["value"], s["row"]
        open_ = F.coalesce(*[row[v] for v in VALUES]).isNotNull()
        closes = F.when((kind == "date") & open_ & s["date"].isNotNull(), True).when((kind == "description") & row["description"].isNotNull(), True).otherwise(False)
        done = F.when(closes, _row(row, date=s["date"])).otherwise(nothing)
        base = F.when(closes, empty).otherwise(row)
        set_ = lambda v: _row(base, **{v: value})
        new = F.when(kind == "description", set_("description")).when(kind == "credit", set_("credit")).when(kind == "debit", set_("debit")).when(kind == "balance", set_("balance"))
        goes_on = _row(row, description=F.concat_ws(" ", row["description"], value))
        if form == "balance":
            new = new.when(kind == "amount", F.when(row["debit"].isNull(), _row(base, debit=value)).otherwise(base))
            new = new.when((kind == "more") & s["on"] & row["description"].isNotNull(), goes_on)
            on = F.when(kind == "description", True).when(kind.isin("other", "more"), s["on"]).when(kind.isNull(), s["on"]).otherwise(False)
        else:
            new = new.when(kind == "amount", set_("amount")).when((kind == "more") & (row["description"].isNull() | s["on"]), goes_on)
            starts = (kind == "more") & row["description"].isNull()
            on = F.when((kind == "description") | starts, True).when(kind.isNull() | (kind == "more"), s["on"]).otherwise(False)
        rows = F.when(closes, F.concat(s["rows"], F.array(done))).otherwise(s["rows"])
        return state(F.when(kind == "date", value).otherwise(s["date"]), new.otherwise(base), on, rows)

    start = state(F.lit(None).cast("string"), empty, F.lit(False), F.array().cast(ROWS))
    return start, step


def _finish(s: Column) -> Column:
    open_ = F.coalesce(*[s["row"][v] for v in VALUES]).isNotNull() & s["date"].isNotNull()
    return F.when(open_, F.concat(s["rows"], F.array(_row(s["row"], date=s["date"])))).otherwise(s["rows"])


def statement_rows(text: Column, form: str = "balance", columns: dict[str, str] | None = None) -> Column:
    """An array of (date, description, debit, credit, amount, balance), all as text; null where a row has no such line.

    ``columns`` names the statement's own headers by role; they are labels too.  An amount statement whose headers
    are named, but no balance among them, has no balance lines.
    """
    events = F.transform(F.transform(lines_of(text), lambda x: read_line(x, form)), lambda r: line_event(r, form, columns or {}))
    start, step = _step(form)
    return F.aggregate(events, start, step, _finish)
