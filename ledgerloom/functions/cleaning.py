"""Cleaning of extracted field values, by the kind of field.

A field's name decides how its value is cleaned: its parts are looked up in the order list, money, date, identifier,
address, and anything else is text.  Null, blank and the usual spellings of "nothing" become the missing mark.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.functions.arrays import bound
from ledgerloom.functions.text import MISSING

# Name parts of each kind in the order in which they are tried, spellings of a missing value, suffixes of
# prices, currency marks, and labels before identifiers.
NAME_PARTS = (
    ("list", ("LINE_ITEM", "ITEMS", "DESCRIPTIONS", "QUANTITIES", "PRICES", "TRANSACTION_DATES", "TRANSACTION_AMOUNTS", "ACCOUNT_BALANCE")),
    ("monetary", ("AMOUNT", "PRICE", "COST", "FEE", "TOTAL", "SUBTOTAL", "GST")),
    ("date", ("DATE", "TIME", "PERIOD", "RANGE")),
    ("id", ("NUMBER", "ID", "ABN", "BSB", "ACCOUNT")),
    ("address", ("ADDRESS", "LOCATION", "STREET")),
)
# Fixed values, down to ALIASES: what stands for no value, decorations of prices, identifiers and addresses, and names of types.
NOTHING = ("NOT_FOUND", "Not Found", "not found", "None", "null", "", "N/A", "n/a")
PRICE_SUFFIXES = (r"\s+(each|per\s+item|per\s+unit|per\s+piece)$", r"\s+(ea\.?|@|apiece)$")
CURRENCIES = (r"AUD?\s*", r"USD?\s*", r"\$\$+")
ID_LABEL = r"^(ABN|BSB|ACN|GST|TAX|ID|NUMBER|NO\.?|#)\s*:?\s*"
CONTACT = r"\s*-\s*(?:P|Phone|Tel|T):\s*\(?[0-9\s\)\(-]+"
EMAIL = r"\s*-?\s*[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}"
PHONE = r"\s*-?\s*\(?[0-9]{2,4}\)?\s*[0-9\s\-]{6,}$"
ABN_SHAPE = r"\d{2}\s+\d{3}\s+\d{3}\s+\d{3}$"
ALIASES = {
    "invoice": ("invoice", "tax invoice", "bill", "estimate", "quote", "quotation", "proforma invoice"),
    "receipt": ("receipt", "purchase receipt", "sales receipt", "transaction receipt"),
    "bank_statement": ("statement", "bank statement", "account statement", "credit card statement"),
    "logbook": ("logbook", "vehicle logbook", "vehicle_logbook", "motor vehicle logbook", "car logbook", "mileage log", "trip log", "ato logbook"),
}


def _or_missing(c: Column) -> Column:
    return bound(c, lambda x: F.when(x != "", x).otherwise(MISSING))


def _gone(c: Column, *patterns: str) -> Column:
    for p in patterns:
        c = F.regexp_replace(c, p, "")
    return c


def _single(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def _unmarked(c: Column) -> Column:
    """Without leading stars and double stars."""
    return F.replace(_gone(c, r"^\s*\*+\s*"), F.lit("**"), F.lit(""))


def clean_money(c: Column) -> Column:
    """Markdown, price suffixes and thousands commas go; a currency mark is one leading ``$``."""
    s = _gone(_unmarked(c), *("(?i)" + p for p in PRICE_SUFFIXES))
    for p in CURRENCIES:
        s = F.regexp_replace(s, "(?i)" + p, r"\$")
    s = _single(F.replace(s, F.lit(","), F.lit("")))
    return _or_missing(bound(s, lambda x: F.when(x.contains("$") & ~x.startswith("$"), F.regexp_replace(x, r"^(.*?)\$(.+)", r"\$$2")).otherwise(x)))


def clean_text(c: Column) -> Column:
    """Markdown goes, white space is single, a closing comma or semicolon goes."""
    s = F.replace(_gone(F.trim(c), r"^\s*\*+\s*", r"\s*\*+\s*$"), F.lit("**"), F.lit(""))
    return _or_missing(F.trim(_gone(F.regexp_replace(s, r"\s+", " "), r"\s*[,;]\s*$")))


def clean_date(c: Column) -> Column:
    """Markdown goes, separators lose the blanks around them."""
    return _or_missing(_single(F.regexp_replace(_unmarked(F.trim(c)), r"\s*([-/.])\s*", "$1")))


def clean_id(c: Column) -> Column:
    """Labels go; eleven digits in groups are joined."""
    s = F.trim(_gone(F.trim(c), "(?i)" + ID_LABEL))
    packed = F.replace(s, F.lit(" "), F.lit(""))
    return _or_missing(F.when(s.rlike(r"^\d+(\s+\d+)+$") & (F.length(packed) == 11), packed).otherwise(_single(s)))


def clean_address(c: Column) -> Column:
    """Telephone numbers, mail addresses and commas go; slashes lose the blanks around them."""
    s = _gone(F.trim(c), "(?i)" + CONTACT, EMAIL)
    s = F.replace(F.when(s.rlike(ABN_SHAPE), s).otherwise(_gone(s, PHONE)), F.lit(","), F.lit(""))
    return _or_missing(_single(F.regexp_replace(_gone(s, r"\s*[;\-]\s*$"), r"\s*/\s*", "/")))


def clean_list(field: Column, c: Column) -> Column:
    """A pipe list of cleaned items; without pipes, commas that no digit follows separate.  Items keep their places, so
    an item that comes to nothing stays as the missing mark; a list of nothing else is missing as a whole."""
    s, name = _unmarked(c), F.upper(field)
    s = F.when(name.rlike("AMOUNT|PRICE|COST|FEE"), F.regexp_replace(s, r"(\$\d+\.\d{2})\s+(\$\d+\.\d{2})", "$1 | $2")).otherwise(s)
    items = F.transform(bound(s, lambda x: F.when(x.contains("|"), F.split(x, r"\|")).otherwise(F.split(x, r",(?!\d)"))), lambda x: F.trim(x))
    items = F.filter(items, lambda x: x != "")
    made = F.when(name.contains("PRICE"), F.transform(items, clean_money)).otherwise(F.transform(items, clean_text))
    return bound(made, lambda m: F.when(F.forall(m, lambda x: x == MISSING), F.lit(MISSING)).otherwise(F.array_join(m, " | ")))


def field_kind(field: Column) -> Column:
    """list, monetary, date, id, address or text."""
    name, out = F.upper(field), None
    for kind, parts in NAME_PARTS:
        hit = name.rlike("|".join(parts))
        out = F.when(hit, kind) if out is None else out.when(hit, kind)
    return out.otherwise("text")


def canonical_type(c: Column) -> Column:
    """A document type by its alias, in upper case; an unknown one stays."""
    low, out = F.lower(F.trim(c)), F.upper(c)
    for name, words in ALIASES.items():
        out = F.when(low.isin(name, *words), F.lit(name.upper())).otherwise(out)
    return out


def clean_value(field: Column, raw: Column) -> Column:
    """The value of a field, cleaned by its kind; a document type is named by its alias."""
    kind, value = field_kind(field), F.trim(raw)
    made = (
        F.when(kind == "list", clean_list(field, value)).when(kind == "monetary", clean_money(value)).when(kind == "date", clean_date(value)).when(kind == "id", clean_id(value))
        .when(kind == "address", clean_address(value)).otherwise(clean_text(value))
    )
    made = F.when((field == "DOCUMENT_TYPE") & (made != MISSING), canonical_type(made)).otherwise(made)
    return F.when(raw.isNull() | raw.isin(*NOTHING) | (value == ""), F.lit(MISSING)).otherwise(made)


def cleaning_operation(raw: Column, cleaned: Column) -> Column:
    """What kind of change cleaning made, the first of the list that applies."""
    n = lambda c: F.size(F.filter(F.split(c, r"\s+"), lambda w: w != ""))
    low = F.lower(raw)
    return (
        F.when(raw == cleaned, "none").when(low.contains("each") & ~F.lower(cleaned).contains("each"), "price_suffix_removal").when(n(raw) != n(cleaned), "whitespace_normalization")
        .when(raw.contains("$") & cleaned.contains("$"), "currency_formatting").when(raw.contains(",") & cleaned.contains("|"), "list_formatting")
        .when(raw.contains("P:") & ~cleaned.contains("P:"), "address_contact_removal").otherwise("general_cleaning")
    )


def for_console(c: Column, most: int = 500) -> Column:
    """Square brackets are escaped, and a longer text is cut with three dots."""
    safe = F.replace(F.replace(c, F.lit("["), F.lit("\\[")), F.lit("]"), F.lit("\\]"))
    return F.when(F.length(safe) > most, F.concat(F.substring(safe, 1, most), F.lit("..."))).otherwise(safe)
