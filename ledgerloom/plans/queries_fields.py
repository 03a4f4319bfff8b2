"""Queries of value cleaning, date shapes, headers and routing, each with its SQL over awkward values."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.functions import cleaning, dates, money, text
from ledgerloom.operators import routing
from ledgerloom.plans.views import duck, view

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str):
    """Register a query under its function's name, with DuckDB SQL over the record views."""

    def add(f):
        QUERIES[f.__name__] = f
        ORACLE[f.__name__] = duck(sql)
        return f

    return add


# --- the cleaners in SQL -----------------------------------------------------------------------
def _re(x: str, pattern: str, by: str = "", flags: str = "g") -> str:
    return f"regexp_replace({x}, '{pattern}', '{by}', '{flags}')"


def _single(x: str) -> str:
    return f"trim({_re(x, r'\s+', ' ')})"


def _unmarked(x: str) -> str:
    return f"replace({_re(x, r'^\s*\*+\s*')}, '**', '')"


def _filled(x: str) -> str:
    return f"coalesce(nullif({x}, ''), 'NOT_FOUND')"


def sql_money(x: str) -> str:
    s = _unmarked(x)
    for p in cleaning.PRICE_SUFFIXES:
        s = _re(s, p, "", "gi")
    for p in cleaning.CURRENCIES:
        s = _re(s, p, "$", "gi")
    s = _single(f"replace({s}, ',', '')")
    return _filled(f"CASE WHEN contains({s}, '$') AND NOT starts_with({s}, '$') THEN {_re(s, r'^(.*?)\$(.+)', r'$\2', '')} ELSE {s} END")


def sql_text(x: str) -> str:
    s = f"replace({_re(_re(f'trim({x})', r'^\s*\*+\s*'), r'\s*\*+\s*$')}, '**', '')"
    return _filled(f"trim({_re(_re(s, r'\s+', ' '), r'\s*[,;]\s*$')})")


def sql_date(x: str) -> str:
    return _filled(_single(_re(_unmarked(f"trim({x})"), r"\s*([-/.])\s*", r"\1")))


def sql_id(x: str) -> str:
    s = f"trim({_re(f'trim({x})', cleaning.ID_LABEL, '', 'gi')})"
    return _filled(f"CASE WHEN regexp_matches({s}, '^\\d+(\\s+\\d+)+$') AND length(replace({s}, ' ', '')) = 11 THEN replace({s}, ' ', '') ELSE {_single(s)} END")


def sql_address(x: str) -> str:
    s = _re(_re(f"trim({x})", cleaning.CONTACT, "", "gi"), cleaning.EMAIL)
    s = f"replace(CASE WHEN regexp_matches({s}, '{cleaning.ABN_SHAPE}') THEN {s} ELSE {_re(s, cleaning.PHONE)} END, ',', '')"
    return _filled(_single(_re(_re(s, r"\s*[;\-]\s*$"), r"\s*/\s*", "/")))


def sql_list(field: str, x: str) -> str:
    s = _unmarked(x)
    s = f"CASE WHEN regexp_matches(upper({field}), 'AMOUNT|PRICE|COST|FEE') THEN {_re(s, r'(\$\d+\.\d{2})\s+(\$\d+\.\d{2})', r'\1 | \2')} ELSE {s} END"
    cut = _re(_re(s, ",([^0-9]|$)", r"~\1"), ",([^0-9]|$)", r"~\1")
    items = f"list_filter(list_transform(CASE WHEN contains({s}, '|') THEN string_split({s}, '|') ELSE string_split({cut}, '~') END, lambda i: trim(i)), lambda i: i <> '')"
    made = f"CASE WHEN contains(upper({field}), 'PRICE') THEN list_transform({items}, lambda i: {sql_money('i')}) ELSE list_transform({items}, lambda i: {sql_text('i')}) END"
    return f"CASE WHEN len(list_filter({made}, lambda i: i <> 'NOT_FOUND')) = 0 THEN 'NOT_FOUND' ELSE array_to_string({made}, ' | ') END"


def sql_kind(field: str) -> str:
    return "CASE " + " ".join(f"WHEN regexp_matches(upper({field}), '{'|'.join(parts)}') THEN '{kind}'" for kind, parts in cleaning.NAME_PARTS) + " ELSE 'text' END"


def sql_value(field: str, raw: str) -> str:
    types = " ".join(f"WHEN lower(trim({sql_text(raw)})) IN ({', '.join(repr(w) for w in (name, *words))}) THEN '{name.upper()}'" for name, words in cleaning.ALIASES.items())
    v = f"trim({raw})"
    by = f"CASE {sql_kind(field)} WHEN 'list' THEN {sql_list(field, v)} WHEN 'monetary' THEN {sql_money(v)} WHEN 'date' THEN {sql_date(v)} WHEN 'id' THEN {sql_id(v)} WHEN 'address' THEN {sql_address(v)} WHEN 'text' THEN {sql_text(v)} END"
    nothing = ", ".join(repr(w) for w in cleaning.NOTHING)
    return f"CASE WHEN {raw} IS NULL OR {raw} IN ({nothing}) OR {v} = '' THEN 'NOT_FOUND' WHEN {field} = 'DOCUMENT_TYPE' AND {sql_text(raw)} <> 'NOT_FOUND' THEN CASE {types} ELSE upper({sql_text(raw)}) END ELSE {by} END"


@query(f"SELECT doc, field, raw, {sql_money('raw')} AS money, {sql_text('raw')} AS plain, {sql_date('raw')} AS dated, {sql_id('raw')} AS id, {sql_address('raw')} AS address FROM messy_values")
def str11_str16_cleaners(spark, sf_dir):
    raw = F.col("raw")
    made = {"money": cleaning.clean_money, "plain": cleaning.clean_text, "dated": cleaning.clean_date, "id": cleaning.clean_id, "address": cleaning.clean_address}
    # a null value is the missing mark
    return view(spark, sf_dir, "messy_values").select("doc", "field", "raw", *[f(raw).alias(k) for k, f in made.items()])


@query(f"SELECT doc, field, raw, {sql_list('field', 'raw')} AS items FROM messy_values WHERE raw IS NOT NULL")
def str12_list_cleaner(spark, sf_dir):
    return view(spark, sf_dir, "messy_values").filter("raw is not null").select("doc", "field", "raw", cleaning.clean_list(F.col("field"), F.col("raw")).alias("items"))


@query(f"SELECT doc, field, raw, {sql_kind('field')} AS kind, {sql_value('field', 'raw')} AS cleaned FROM messy_values")
def str17_str19_routed_cleaning(spark, sf_dir):
    return view(spark, sf_dir, "messy_values").select("doc", "field", "raw", cleaning.field_kind(F.col("field")).alias("kind"), cleaning.clean_value(F.col("field"), F.col("raw")).alias("cleaned"))


_WORDS = lambda x: f"len(list_filter(regexp_split_to_array({x}, '\\s+'), lambda w: w <> ''))"


@query(f"""SELECT operation, count(*) AS n FROM (SELECT CASE WHEN o = c THEN 'none' WHEN contains(lower(o), 'each') AND NOT contains(lower(c), 'each') THEN 'price_suffix_removal'
      WHEN {_WORDS('o')} <> {_WORDS('c')} THEN 'whitespace_normalization' WHEN contains(o, '$') AND contains(c, '$') THEN 'currency_formatting' WHEN contains(o, ',') AND contains(c, '|') THEN 'list_formatting'
      WHEN contains(o, 'P:') AND NOT contains(c, 'P:') THEN 'address_contact_removal' ELSE 'general_cleaning' END AS operation
    FROM (SELECT trim(raw) AS o, {sql_value('field', 'raw')} AS c FROM messy_values WHERE raw IS NOT NULL)) GROUP BY operation""")
def str18_cleaning_operations(spark, sf_dir):
    rows = view(spark, sf_dir, "messy_values").filter("raw is not null").select(F.trim("raw").alias("o"), cleaning.clean_value(F.col("field"), F.col("raw")).alias("c"))
    return rows.groupBy(cleaning.cleaning_operation(F.col("o"), F.col("c")).alias("operation")).agg(F.count("*").alias("n"))


# --- numbers -----------------------------------------------------------------------------------
_NUM7 = "CASE WHEN upper(trim(text)) IN ('', 'NOT_FOUND') THEN NULL ELSE abs(TRY_CAST(regexp_replace(regexp_replace(trim(text), '[$,\\s]', '', 'g'), '^\\((.*)\\)$', '\\1') AS DOUBLE)) END"


@query(f"SELECT case_id, pos, text, {_NUM7} AS value, '$' || CAST(CAST(amount AS DECIMAL(18,2)) AS VARCHAR) AS printed, starts_with(trim(text), '-') OR (starts_with(trim(text), '(') AND ends_with(trim(text), ')')) AS negative FROM amount_texts")
def num7_num15_flt4_amounts(spark, sf_dir):
    t = F.col("text")
    return view(spark, sf_dir, "amount_texts").select("case_id", "pos", "text", money.parse_unsigned(t).alias("value"), money.dollars(F.col("amount")).alias("printed"), money.is_negative_text(t).alias("negative"))


@query(f"SELECT case_id, count(*) FILTER (negative) AS below, count(*) FILTER (NOT negative AND value > 0) AS above, count(*) FILTER (value IS NULL AND upper(trim(text)) <> 'NOT_FOUND') AS unreadable FROM (SELECT case_id, text, {_NUM7} AS value, starts_with(trim(text), '-') OR (starts_with(trim(text), '(') AND ends_with(trim(text), ')')) AS negative FROM amount_texts) GROUP BY case_id")
def flt3_flt4_flt5_signs(spark, sf_dir):
    t = F.col("text")
    rows = view(spark, sf_dir, "amount_texts").select("case_id", "text", money.parse_unsigned(t).alias("value"), money.is_negative_text(t).alias("negative"))
    return rows.groupBy("case_id").agg(F.count_if("negative").alias("below"), F.count_if(~F.col("negative") & (F.col("value") > 0)).alias("above"), F.count_if(F.col("value").isNull() & (F.upper(F.trim("text")) != "NOT_FOUND")).alias("unreadable"))


# --- dates -------------------------------------------------------------------------------------
_SQL_SHAPES = {
    "d/m/Y": (r"\d{1,2}/\d{1,2}/\d{4}", "%d/%m/%Y"), "m/d/Y": (r"\d{1,2}/\d{1,2}/\d{4}", "%m/%d/%Y"), "d-m-Y": (r"\d{1,2}-\d{1,2}-\d{4}", "%d-%m-%Y"), "d/m/y": (r"\d{1,2}/\d{1,2}/\d{2}", "%d/%m/%y"),
    "Y-m-d": (r"\d{4}-\d{1,2}-\d{1,2}", "%Y-%m-%d"), "d b Y": (r"\d{1,2} [A-Za-z]{3} \d{4}", "%d %b %Y"), "d-b-y": (r"\d{1,2}-[A-Za-z]{3}-\d{2}", "%d-%b-%y"), "a d b Y": (r"[A-Za-z]{3} \d{1,2} [A-Za-z]{3} \d{4}", "%a %d %b %Y"),
    "d B Y": (r"\d{1,2} [A-Za-z]{3,9} \d{4}", "%d %b %Y', '%d %B %Y"), "d b y": (r"\d{1,2} [A-Za-z]{3,9} \d{2}", "%d %b %y', '%d %B %y"), "d b": (r"\d{1,2} [A-Za-z]{3,9}", "%d %b', '%d %B"),
}


def sql_ladder(x: str, shapes: tuple[str, ...]) -> str:
    tries = [f"CASE WHEN regexp_full_match(trim({x}), '{_SQL_SHAPES[s][0]}') THEN CAST(try_strptime(trim({x}), ['{_SQL_SHAPES[s][1]}']) AS DATE) END" for s in shapes if not s.startswith("*")]
    return f"coalesce({', '.join(tries)})"


@query(f"SELECT n, text, {sql_ladder('text', dates.STATEMENT_LADDER)} AS statement, {sql_ladder('text', dates.REGISTER_LADDER)} AS register, {sql_ladder('text', dates.REPORT_LADDER)} AS report FROM date_shapes WHERE text NOT LIKE '% on %'")
def dat5_dat6_dat12_ladders(spark, sf_dir):
    rows = view(spark, sf_dir, "date_shapes").filter("text not like '% on %'")
    return rows.select("n", "text", dates.ladder(F.col("text"), dates.STATEMENT_LADDER).alias("statement"), dates.ladder(F.col("text"), dates.REGISTER_LADDER).alias("register"), dates.ladder(F.col("text"), dates.REPORT_LADDER).alias("report"))


@query(f"SELECT n, text, coalesce(strftime({sql_ladder('text', (*dates.REGISTER_LADDER[:7], 'd-m-Y'))}, '%d/%m/%Y'), text) AS day_first FROM date_shapes WHERE text NOT LIKE '% on %'")
def dat7_day_first(spark, sf_dir):
    return view(spark, sf_dir, "date_shapes").filter("text not like '% on %'").select("n", "text", dates.day_first(F.col("text")).alias("day_first"))


_MONTH = "CASE " + " ".join(f"WHEN contains(t, '{m[:3]}') THEN {i}" for i, m in enumerate(dates.MONTHS, 1)) + " END"


def sql_tuples(x: str) -> str:
    """A list of up to two 'd/m/y' texts, as the range reader gives them."""
    def one(y: str) -> str:
        runs = f"list_transform(regexp_extract_all(lower({y}), '\\d+'), lambda r: CAST(r AS INT))"
        month = _MONTH.replace("contains(t,", f"contains(lower({y}),")
        year = f"CASE WHEN len({runs}) >= 3 THEN {runs}[3] WHEN {month} IS NOT NULL THEN {runs}[2] ELSE 0 END"
        full = f"CASE WHEN ({year}) < 100 THEN CASE WHEN ({year}) <= 50 THEN 2000 ELSE 1900 END + ({year}) ELSE ({year}) END"
        return f"CASE WHEN len({runs}) >= 2 THEN {runs}[1] || '/' || CASE WHEN len({runs}) >= 3 THEN {runs}[2] ELSE coalesce({month}, {runs}[2]) END || '/' || ({full}) END"

    whens = []
    for mark in dates.RANGE_MARKS:
        parts = f"list_filter(list_transform(string_split({x}, '{mark}'), lambda p: trim(p)), lambda p: length(p) > 4)"
        ends = f"list_filter(list_transform(({parts})[1:2], lambda p: {one('p')}), lambda p: p IS NOT NULL)"
        whens.append(f"WHEN contains(lower({x}), '{mark}') AND len({parts}) >= 2 THEN {ends}")
    ranged = f"CASE {' '.join(whens)} END"
    return f"CASE WHEN len({ranged}) > 0 THEN {ranged} ELSE list_filter([{one(x)}], lambda p: p IS NOT NULL) END"


@query(f"""WITH t AS (SELECT a.n AS a, b.n AS b, a.text AS x, b.text AS y, list_distinct({sql_tuples('a.text')}) AS p, list_distinct({sql_tuples('b.text')}) AS q, {sql_tuples('a.text')} AS p1, {sql_tuples('b.text')} AS q1 FROM date_shapes a JOIN date_shapes b ON b.n BETWEEN a.n - 3 AND a.n + 3)
    SELECT a, b, round(CASE WHEN len(p) = 0 OR len(q) = 0 THEN 0.0 WHEN len(list_intersect(p, q)) > 0 THEN len(list_intersect(p, q)) / greatest(len(p), len(q))::DOUBLE WHEN regexp_replace(p1[1], '/[0-9]+$', '') = regexp_replace(q1[1], '/[0-9]+$', '') THEN 0.8 ELSE 0.0 END, 6) AS score FROM t""")
def dat4_set5_date_scores(spark, sf_dir):
    # a text is read once, not once for each of its pairs
    a = view(spark, sf_dir, "date_shapes").select(F.col("n").alias("a"), dates.date_ends(F.col("text")).alias("x"))
    near = a.withColumn("b", F.explode(F.sequence(F.col("a") - 3, F.col("a") + 3)))
    both = near.join(a.select(F.col("a").alias("b"), F.col("x").alias("y")), "b")
    return both.select("a", "b", F.round(dates.date_ends_score(F.col("x"), F.col("y")), 6).alias("score"))


# --- texts -------------------------------------------------------------------------------------
@query("""SELECT p.doc, p.field, CASE WHEN length(g.value) <= 3 THEN p.value = g.value WHEN length(p.value) = 0 THEN false
    ELSE len(list_filter(string_split(p.value, ''), lambda c: c <> '' AND contains(g.value, c))) / greatest(length(p.value), length(g.value))::DOUBLE >= 0.85 END AS alike FROM pred_fields p JOIN gt_fields g ON p.doc = g.doc AND p.field = g.field""")
def str8_character_overlap(spark, sf_dir):
    p, g = view(spark, sf_dir, "pred_fields"), view(spark, sf_dir, "gt_fields").withColumnRenamed("value", "want")
    return p.join(g, ["doc", "field"]).select("doc", "field", text.overlap_equal(F.col("value"), F.col("want")).alias("alike"))


@query("""SELECT doc, raw, CASE WHEN length(s) > 12 THEN substr(s, 1, 12) || '...' ELSE s END AS shown, CASE doc % 4 WHEN 1 THEN 'light' WHEN 2 THEN 'moderate' WHEN 3 THEN 'heavy' ELSE 'clean' END AS tier, 'Columns: ' || coalesce(raw, 'none') || ', name: c' AS prompt
    FROM (SELECT doc, raw, replace(replace('[' || raw, '[', '\\['), ']', '\\]') AS s FROM messy_values WHERE doc > 0)""")
def str23_str25_rul23_texts(spark, sf_dir):
    name = F.concat(F.lit("a/img"), F.when(F.col("doc") % 4 == 0, "").otherwise(F.concat(F.lit("_v"), (F.col("doc") % 4).cast("string"))), F.lit(".png"))
    prompt = text.fill(F.lit("Columns: {x}, name: {c}"), {"x": (F.col("raw"), "none"), "c": (F.lit(None).cast("string"), None)})
    return view(spark, sf_dir, "messy_values").filter("doc > 0").select("doc", "raw", cleaning.for_console(F.concat(F.lit("["), "raw"), 12).alias("shown"), text.tier_of(name).alias("tier"), prompt.alias("prompt"))


# --- headers and routes ------------------------------------------------------------------------
_BARE = r"replace(replace(trim(regexp_replace(x, '^[0-9.\-•* ]+', '')), '**', ''), '__', '')"
_COUNT = lambda x, s: f"(length({x}) - length(replace({x}, '{s}', '')))"
_READ = f"""CASE WHEN ends_with(x, ':') THEN [] WHEN length(x) > 20 AND ({_COUNT('x', ',')} >= 2 OR {_COUNT('x', '|')} >= 2)
    THEN list_filter(list_transform(string_split(x, CASE WHEN {_COUNT('x', '|')} >= 2 THEN '|' ELSE ',' END), lambda p: trim(p)), lambda p: length(p) > 1)
    WHEN length(x) > 40 OR length(x) <= 2 THEN [] ELSE [x] END"""
_HEADERS = f"(SELECT doc, flatten(list_transform(list_transform(list_filter(list_transform(string_split(raw, chr(10)), lambda x: trim(x)), lambda x: x <> ''), lambda x: {_BARE}), lambda x: {_READ})) AS h FROM header_texts)"


def _role_sql(words: tuple[str, ...]) -> str:
    equal = [f"list_filter(h, lambda x: lower(x) = '{w}')[1]" for w in words]
    within = [f"list_filter(h, lambda x: length(x) <= 20 AND contains(lower(x), '{w}'))[1]" for w in words if len(w) > 2]
    return f"coalesce({', '.join(equal + within)})"


_FOUND = f"(SELECT doc, {', '.join(f'{_role_sql(w)} AS {r}_' for r, w in routing.ROLES.items())} FROM {_HEADERS})"
_CUT = f"""(SELECT *, greatest(strpos(lower(debit_), 'debit'), strpos(lower(debit_), 'credit')) AS cut, debit_ = credit_ AND strpos(lower(debit_), 'debit') > 0 AND strpos(lower(debit_), 'credit') > 0 AS both_ FROM {_FOUND})"""
_PARTS = f"(SELECT *, trim(regexp_replace(substr(debit_, 1, cut - 1), '[ /]+$', '')) AS l, trim(substr(debit_, cut)) AS r FROM {_CUT})"
_ROLES = f"""(SELECT doc, date_ AS date_col, description_ AS description_col, balance_ AS balance_col, amount_ AS amount_col,
    CASE WHEN both_ AND l <> '' AND r <> '' THEN CASE WHEN contains(lower(l), 'debit') THEN l ELSE r END ELSE debit_ END AS debit_col,
    CASE WHEN both_ AND l <> '' AND r <> '' THEN CASE WHEN contains(lower(l), 'debit') THEN r ELSE l END ELSE credit_ END AS credit_col FROM {_PARTS})"""


def _roles(spark, sf_dir):
    found = view(spark, sf_dir, "header_texts").select("doc", routing.header_list(F.col("raw")).alias("h"))
    return found.select("doc", *[c.alias(f"{r}_col") for r, c in routing.column_roles(F.col("h")).items()])


@query(f"SELECT doc, array_to_string(h, '~') AS headers FROM {_HEADERS}")
def par4_headers(spark, sf_dir):
    return view(spark, sf_dir, "header_texts").select("doc", F.array_join(routing.header_list(F.col("raw")), "~").alias("headers"))


@query(f"SELECT * FROM {_ROLES}")
def par5_par6_column_roles(spark, sf_dir):
    return _roles(spark, sf_dir)


_EDGE = "CASE WHEN balance_col IS NOT NULL AND debit_col IS NOT NULL THEN 'has_balance_debit' WHEN amount_col IS NOT NULL THEN 'has_amount' WHEN debit_col IS NOT NULL OR credit_col IS NOT NULL THEN 'has_debit_or_credit' ELSE 'default' END"


@query(f"""SELECT doc, CASE WHEN doc % 5 = 0 THEN 'is_receipt' WHEN doc % 5 = 1 THEN {_EDGE} WHEN {_EDGE} = 'has_debit_or_credit' THEN 'default' ELSE {_EDGE} END AS edge,
    CASE WHEN balance_col IS NOT NULL AND coalesce(debit_col, credit_col) IS NOT NULL THEN 'BALANCE_DESCRIPTION' WHEN amount_col IS NOT NULL THEN 'AMOUNT_DESCRIPTION' WHEN coalesce(debit_col, credit_col) IS NOT NULL THEN 'DEBIT_CREDIT_DESCRIPTION' ELSE 'TABLE_EXTRACTION' END AS strategy FROM {_ROLES}""")
def rul8_rul9_routing(spark, sf_dir):
    b, d, c, a = (F.col(f"{x}_col") for x in ("balance", "debit", "credit", "amount"))
    edge = routing.register_edge(b, d, c, a)
    kind = F.when(F.col("doc") % 5 == 0, "RECEIPT").when(F.col("doc") % 5 == 2, "OTHER")
    some = ("is_receipt", "has_balance_debit", "has_amount")
    routed = F.when(F.col("doc") % 5 == 1, routing.router_edge(kind, (*some, "has_debit_or_credit"), edge)).otherwise(routing.router_edge(kind, some, edge))
    return _roles(spark, sf_dir).select("doc", routed.alias("edge"), routing.strategy(b, d, c, a).alias("strategy"))


@query(f"""SELECT doc, CASE WHEN doc % 9 = 4 THEN 'TABLE_EXTRACTION' WHEN balance_col IS NOT NULL AND coalesce(debit_col, credit_col) IS NOT NULL THEN 'BALANCE_DESCRIPTION' WHEN amount_col IS NOT NULL THEN 'AMOUNT_DESCRIPTION' WHEN coalesce(debit_col, credit_col) IS NOT NULL THEN 'DEBIT_CREDIT_DESCRIPTION' ELSE 'TABLE_EXTRACTION' END AS strategy,
    CASE WHEN doc % 9 = 4 THEN 'Manual override' WHEN balance_col IS NOT NULL AND coalesce(debit_col, credit_col) IS NOT NULL THEN 'Balance + Debit/Credit columns detected' WHEN balance_col IS NOT NULL AND amount_col IS NOT NULL THEN 'Balance + Amount column detected (signed values)'
      WHEN amount_col IS NOT NULL THEN 'Amount column detected (no balance)' WHEN coalesce(debit_col, credit_col) IS NOT NULL THEN 'Debit/Credit columns detected (no balance)' ELSE 'Schema fallback (column detection failed)' END AS reason FROM {_ROLES}""")
def rul9_reasoned_strategy(spark, sf_dir):
    b, d, c, a = (F.col(f"{x}_col") for x in ("balance", "debit", "credit", "amount"))
    forced = F.when(F.col("doc") % 9 == 4, "TABLE_EXTRACTION")
    return _roles(spark, sf_dir).select("doc", routing.reasoned_strategy(b, d, c, a, forced).alias("s")).select("doc", "s.*")


@query(f"""WITH f AS (SELECT doc, count(*) FILTER (value <> 'NOT_FOUND') + CASE WHEN doc % 3 = 0 THEN 2 ELSE 0 END AS n FROM pred_fields GROUP BY doc),
    r AS (SELECT doc, (date_col IS NOT NULL)::INT + (description_col IS NOT NULL)::INT + (debit_col IS NOT NULL)::INT + (credit_col IS NOT NULL)::INT + (amount_col IS NOT NULL)::INT + (balance_col IS NOT NULL)::INT AS k FROM {_ROLES})
    SELECT f.doc, CASE WHEN k >= 3 AND n < 6 THEN 'BANK_STATEMENT' WHEN f.doc % 3 = 0 THEN 'RECEIPT' WHEN f.doc % 2 = 0 THEN 'INVOICE' ELSE 'RECEIPT' END AS doc_type FROM f JOIN r ON f.doc = r.doc""")
def rul7_probed_type(spark, sf_dir):
    fields = view(spark, sf_dir, "pred_fields").groupBy("doc").agg(F.map_from_entries(F.collect_list(F.struct("field", "value"))).alias("f"))
    more = F.when(F.col("doc") % 3 == 0, F.create_map(F.lit("PAYMENT_DATE"), F.lit("1/2/2024"), F.lit("EXTRA"), F.lit("x"), F.lit("_raw"), F.lit("y"))).otherwise(F.create_map(F.lit("note"), F.lit("z")))
    roles = _roles(spark, sf_dir)
    found = sum((F.col(c).isNotNull().cast("int") for c in roles.columns if c != "doc"), F.lit(0))
    both = fields.withColumn("f", F.map_concat("f", more)).join(roles.select("doc", found.alias("k")), "doc")
    return both.select("doc", routing.probed_type(F.col("f"), F.col("k"), F.when(F.col("doc") % 2 == 0, "INVOICE")).alias("doc_type"))


@query("""SELECT doc, CASE WHEN s > 0 AND i = 5 THEN s WHEN e > 0 THEN e WHEN p > 0 THEN p END AS seconds, CASE WHEN s > 0 AND i = 5 THEN 'stage timing' WHEN e > 0 THEN 'entrypoint elapsed' WHEN p > 0 THEN 'per-image sum' ELSE 'not recorded' END AS source,
    CASE WHEN m >= 24 THEN 'aggressive' WHEN m >= 12 THEN 'balanced' WHEN m IS NOT NULL THEN 'conservative' END AS batch
    FROM (SELECT o_orderkey AS doc, CASE WHEN o_orderkey % 2 = 0 THEN o_totalprice END AS s, 4 + o_orderkey % 3 AS i, CASE WHEN o_orderkey % 5 < 2 THEN CAST(o_orderkey % 5 AS DOUBLE) END AS e, CAST(o_orderkey % 7 AS DOUBLE) AS p, CASE WHEN o_orderkey % 11 > 0 THEN CAST(o_orderkey % 40 AS DOUBLE) END AS m FROM orders)""")
def agg34_rul21_timing_choice(spark, sf_dir):
    k = F.col("o_orderkey")
    rows = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        k.alias("doc"), F.when(k % 2 == 0, F.col("o_totalprice")).alias("s"), (4 + k % 3).alias("i"), F.when(k % 5 < 2, (k % 5).cast("double")).alias("e"), (k % 7).cast("double").alias("p"), F.when(k % 11 > 0, (k % 40).cast("double")).alias("m"),
    )
    seconds, source = routing.timing(F.col("s"), F.col("i"), F.col("e"), F.col("p"), F.lit(5))
    return rows.select("doc", seconds.alias("seconds"), source.alias("source"), routing.batch_strategy(F.col("m")).alias("batch"))
