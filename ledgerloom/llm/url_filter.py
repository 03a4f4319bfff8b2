"""Url filter: rules first, and for what no rule fits, trust and distrust that flow along the links between hosts.

Hosts link to hosts that their pages refer to: absolute addresses in ``href``, ``src`` and ``action``, and host names
in the page's html that are hosts of the table themselves.  A pair's weight is the number of pages that hold the link.
Pages that an allowing rule fits are trusted seeds of their host, pages that a blocking rule fits are distrusted ones.
Trust follows links (a trusted host vouches for what it links to), distrust follows them backwards (whoever links to
a blocked host is suspect), both as personalised PageRank with damping ``DAMPING``: rank = seed + damping * sum over
in-links of rank * weight / weights, iterated ``STEPS`` times.  Ranks are whole numbers (``UNIT`` a seed page), each
contribution is rounded down before it is summed, so results do not depend on the order of sums or on partitions.  A
host is blocked if (trust - distrust) / (trust + distrust) is under ``LEAST``; without either it is 0, so allowed.

Pairs are counted before they are shuffled and lie once by their source for all steps; a host with many links is dealt
over splits of ``SPLIT`` pairs, its rank over as many rows.  Hosts with over a thousandth of all pages (at most a
thousand) meet their pages by a broadcast, all others by a shuffle.

Defined cases: null urls and urls without ``://`` have an empty host and path, no rule and the verdict of score 0; null
html has no links; a page's links to its own host count nothing; repeated rows count each; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.kernels import shared_dir, tasks

# the contract's rules: host with all subdomains, path prefix, verdict
RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block"))
DAMPING = 0.85
STEPS = 20
UNIT = 1_000_000
LEAST = 0.0
SPLIT = 100_000
CUT_EVERY = 5
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# possessive, and names start where a run of their letters starts: linear in html of any shape
_REFERENCE = r"""(?:href|src|action)[ \t\r\n]*+=[ \t\r\n]*+["']?+[ \t\r\n]*+(?:[a-z][a-z0-9+.-]*+:)?+//([^/?#"' \t\r\n<>]+)"""
_NAME = r"(?<![a-z0-9-])[a-z0-9-]++(?:\.[a-z0-9-]++)+"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Both empty for null and for urls without ``://``."""
    known = F.coalesce(url, F.lit(""))
    host = F.translate(F.regexp_extract(known, r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER)
    return host, F.regexp_extract(known, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest fitting rule as host + path, and its verdict; null if none fits."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: len(r[0] + r[1])):  # a longer one later covers a shorter
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, verdict = F.when(fits, h + p).otherwise(name), F.when(fits, v).otherwise(verdict)
    return name, verdict


def judged_by_rules(pages: DataFrame, rules=RULES) -> DataFrame:
    """(page_id, host, path, rule, by_rule)."""
    host, path = host_and_path(F.col("url"))
    split = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    return split.withColumns({"rule": rule, "by_rule": verdict})


def host_links(pages: DataFrame, hosts: DataFrame) -> DataFrame:
    """(src, dst, pages) of all pairs of different hosts; ``hosts`` is the table of known names."""
    html = F.translate(F.coalesce("html", F.lit("")), _UPPER, _LOWER)
    src = host_and_path(F.col("url"))[0]
    low = pages.select(src.alias("src"), html.alias("html")).filter("src <> ''")

    def counted(found: Column) -> DataFrame:
        return low.select("src", F.explode(F.array_distinct(found)).alias("dst")).filter("dst <> src").groupBy("src", "dst").agg(F.count("*").alias("pages"))

    referred = counted(F.regexp_extract_all("html", F.lit(_REFERENCE), F.lit(1)))
    named = counted(F.regexp_extract_all("html", F.lit(_NAME), F.lit(0))).join(hosts.select(F.col("host").alias("dst")), "dst", "left_semi").select("src", "dst", "pages")
    return referred.unionByName(named).groupBy("src", "dst").agg(F.max("pages").alias("pages"))


def _flows(links: DataFrame, n: int) -> DataFrame:
    """(node, kind, split, to, to_splits, share): trust (kind 0) runs along links, distrust (1) against them."""
    both = links.select(F.col("src").alias("node"), F.lit(0).alias("kind"), F.col("dst").alias("to"), "pages").unionByName(
        links.select(F.col("dst").alias("node"), F.lit(1).alias("kind"), F.col("src").alias("to"), "pages")
    )
    # sums, not windows: a host with many links is summed before it is shuffled
    size = both.groupBy("node", "kind").agg(F.sum("pages").alias("all"), F.ceil(F.count("*") / F.lit(SPLIT)).cast("int").alias("splits"))
    shared = both.join(size, ["node", "kind"]).join(size.select(F.col("node").alias("to"), "kind", F.col("splits").alias("to_splits")), ["to", "kind"], "left")
    split = F.pmod(F.xxhash64("to"), F.col("splits")).cast("int").alias("split")
    out = shared.select("node", "kind", split, "to", F.coalesce("to_splits", F.lit(0)).alias("to_splits"), (F.col("pages").cast("double") / F.col("all").cast("double")).alias("share"))
    return out.repartition(n, "node", "kind", "split")


def propagate(links: DataFrame, seeds: DataFrame, damping: float = DAMPING, steps: int = STEPS) -> DataFrame:
    """(host, trust, distrust) from seeds (host, trusted, blocked: seed pages)."""
    shared_dir(links.sparkSession)
    n = tasks(links.sparkSession)
    flows = _flows(links, n).persist()
    sizes = flows.groupBy("node", "kind").agg((F.max("split") + 1).alias("splits"))
    each = F.array(F.struct(F.lit(0).alias("kind"), F.col("trusted").alias("x")), F.struct(F.lit(1).alias("kind"), F.col("blocked").alias("x")))
    start = seeds.select(F.col("host").alias("node"), F.explode(each).alias("s")).select("node", "s.kind", (F.col("s.x") * UNIT).alias("x")).filter("x > 0")
    start = start.join(sizes, ["node", "kind"], "left").select("node", "kind", "x", F.coalesce("splits", F.lit(0)).alias("splits")).checkpoint()
    rank = start
    for step in range(1, steps + 1):
        dealt = rank.filter("splits > 0").select("node", "kind", "x", F.explode(F.sequence(F.lit(0), F.col("splits") - 1)).alias("split"))
        part = F.floor(F.col("x").cast("double") * F.lit(float(damping)) * F.col("share")).cast("long")
        sent = flows.join(dealt, ["node", "kind", "split"]).select(F.col("to").alias("node"), "kind", part.alias("x"), F.col("to_splits").alias("splits"))
        rank = start.unionByName(sent).groupBy("node", "kind").agg(F.sum("x").alias("x"), F.max("splits").alias("splits"))
        if step % CUT_EVERY == 0:
            rank = rank.checkpoint()
    of = lambda kind: F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("x"))), F.lit(0))
    out = rank.groupBy(F.col("node").alias("host")).agg(of(0).alias("trust"), of(1).alias("distrust")).checkpoint()
    flows.unpersist()
    return out


def judge(pages: DataFrame, rules=RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict, score) of every row of ``page_id``, ``url``, ``html``."""
    ruled = judged_by_rules(pages, rules)
    per = ruled.groupBy("host").agg(F.count("*").alias("n"), F.count_if(F.col("by_rule") == "allow").alias("trusted"), F.count_if(F.col("by_rule") == "block").alias("blocked"))
    shared_dir(pages.sparkSession)
    hosts = per.filter("host <> ''").checkpoint()
    ranks = propagate(host_links(pages, hosts), hosts)
    t, d = F.coalesce("trust", F.lit(0)), F.coalesce("distrust", F.lit(0))
    scored = hosts.join(ranks, "host", "left").select("host", "n", F.when(t + d > 0, (t - d).cast("double") / (t + d).cast("double")).otherwise(F.lit(0.0)).alias("score")).checkpoint()
    total = scored.agg(F.sum("n")).first()[0] or 0
    large = F.col("n") > total / 1000  # at most a thousand hosts
    few, many = scored.filter(large).select("host", "score"), scored.filter(~large).select("host", "score")
    met = ruled.join(F.broadcast(few), "host", "left")
    done = F.col("score").isNotNull() | (F.col("host") == "")
    known = met.filter(done).unionByName(met.filter(~done).drop("score").join(many, "host", "left"))
    score = F.coalesce("score", F.lit(0.0))
    verdict = F.coalesce("by_rule", F.when(score < LEAST, "block").otherwise("allow"))
    return known.select("page_id", "host", "path", "rule", verdict.alias("verdict"), score.alias("score"))


def oracle(rules=RULES) -> str:
    """The same rows in DuckDB: the steps written out, since recursion cannot sum."""
    order = sorted(rules, key=lambda r: -len(r[0] + r[1]))
    fits = [f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')" for h, p, _ in order]
    rule = " ".join(f"WHEN {f} THEN '{h}{p}'" for f, (h, p, _) in zip(fits, order, strict=True))
    by = " ".join(f"WHEN {f} THEN '{v}'" for f, (_, _, v) in zip(fits, order, strict=True))
    low = f"translate({{}}, '{_UPPER}', '{_LOWER}')"
    quoted = _REFERENCE.replace("*+", "*").replace("?+", "?").replace("'", "''")  # DuckDB's matcher never backtracks
    step = """r{k} AS MATERIALIZED (SELECT node, kind, sum(x)::BIGINT AS x FROM (SELECT * FROM s UNION ALL
      SELECT f."to", f.kind, floor(r.x::DOUBLE * {damping}::DOUBLE * f.share)::BIGINT FROM r{j} r JOIN f USING (node, kind)) GROUP BY ALL)"""
    steps = ",\n    ".join(step.format(k=k, j=k - 1, damping=DAMPING) for k in range(1, STEPS + 1))
    return f"""
    WITH p AS MATERIALIZED (
      SELECT page_id, {low.format("regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1)")} AS host,
        regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path, {low.format("coalesce(html, '')")} AS html FROM pages),
    j AS MATERIALIZED (SELECT page_id, host, path, html, CASE {rule} END AS rule, CASE {by} END AS by_rule FROM p),
    h AS MATERIALIZED (SELECT host, count(*) FILTER (by_rule = 'allow') AS trusted, count(*) FILTER (by_rule = 'block') AS blocked FROM j WHERE host <> '' GROUP BY host),
    l AS MATERIALIZED (SELECT src, dst, max(pages) AS pages FROM (
      SELECT src, dst, count(*) AS pages FROM (SELECT host AS src, unnest(list_distinct(regexp_extract_all(html, '{quoted}', 1))) AS dst FROM p WHERE host <> '') WHERE src <> dst GROUP BY ALL
      UNION ALL
      SELECT src, dst, count(*) FROM (SELECT host AS src, unnest(list_distinct(regexp_extract_all(html, '[a-z0-9-]+(?:[.][a-z0-9-]+)+'))) AS dst FROM p WHERE host <> '')
      WHERE src <> dst AND dst IN (SELECT host FROM h) GROUP BY ALL) GROUP BY ALL),
    b AS (SELECT src AS node, 0 AS kind, dst AS "to", pages FROM l UNION ALL SELECT dst, 1, src, pages FROM l),
    f AS MATERIALIZED (SELECT node, kind, "to", pages::DOUBLE / (sum(pages) OVER (PARTITION BY node, kind))::DOUBLE AS share FROM b),
    s AS MATERIALIZED (SELECT host AS node, 0 AS kind, trusted * {UNIT} AS x FROM h WHERE trusted > 0 UNION ALL SELECT host, 1, blocked * {UNIT} FROM h WHERE blocked > 0),
    r0 AS (SELECT * FROM s),
    {steps},
    c AS (SELECT node AS host, coalesce(sum(x) FILTER (kind = 0), 0)::BIGINT AS t, coalesce(sum(x) FILTER (kind = 1), 0)::BIGINT AS d FROM r{STEPS} GROUP BY node),
    v AS (SELECT j.*, coalesce(CASE WHEN t + d > 0 THEN (t - d)::DOUBLE / (t + d)::DOUBLE END, 0) AS score FROM j LEFT JOIN c USING (host))
    SELECT page_id, host, path, rule, coalesce(by_rule, CASE WHEN score < {LEAST} THEN 'block' ELSE 'allow' END) AS verdict, score::DOUBLE AS score FROM v"""
