"""Hard negatives, url verdicts and collocations against brute force on small tables with every awkward case."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import collocations, hard_negatives, url_filter

# --- hard negatives ------------------------------------------------------------------------------


def brute_negatives(rows, positives=5, negatives=10):
    best = {}
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        key = (label, [float(x) for x in v])
        best[i] = min(best.get(i, key), key)
    whole = {i: (label, [int(np.floor(256 * x)) for x in v]) for i, (label, v) in best.items()}
    clip = lambda s: max(-(2**63), min(2**63 - 1, s))
    out = []
    for a, (la, va) in whole.items():
        if a % 100:
            continue
        s = {i: clip(sum(x * y for x, y in zip(va, v))) for i, (_, v) in whole.items() if i != a}
        first = lambda some: sorted(some, key=lambda i: (-s[i], i))  # noqa: E731, B023
        for p in first([i for i in s if whole[i][0] == la])[:positives]:
            fits = [i for i in s if whole[i][0] != la and 30 * s[p] <= 100 * s[i] <= 90 * s[p]]
            out += [(a, p, r, i, s[p], s[i]) for r, i in enumerate(first(fits)[:negatives], 1)]
    return sorted(out)


def vectors(seed, n, dim=6, scale=1.0):
    rnd = np.random.default_rng(seed)
    rows = [(i, (rnd.standard_normal(dim) * scale + 0.6).astype(np.float32).tolist(), int(rnd.integers(0, 3))) for i in range(0, n * 5, 5)]
    same = rows[3][1]
    rows += [(100_000 + i, same, 1) for i in range(40)]  # ties
    rows += [(7, None, 1), (8, [None] * dim, 1), (9, [float("nan")] + same[1:], 1), (11, [float("inf")] + same[1:], 2), (12, same, None), (None, same, 1)]
    rows += [(13, same[:2], 1), (14, [], 2), (15, [0.0] * dim, 1), (0, same, 2), (100, rows[20][1], rows[20][2]), (200, [-x for x in same], 0)]  # short, empty, repeated ids
    return rows


@pytest.mark.parametrize(("seed", "scale"), [(1, 1.0), (2, 1e6), (3, 1e14)])
def test_hard_negatives(spark, seed, scale):
    rows = vectors(seed, 200, scale=scale)
    df = spark.createDataFrame([(*r, 1, 2.0) for r in rows], "vec_id long, embedding array<float>, label int, rank int, score double").repartition(3)
    got = hard_negatives.mine(df, F.col("vec_id") % 100 == 0)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(tuple(r) for r in got.collect()) == brute_negatives(rows)


def test_hard_negatives_blocks(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "BLOCK", 4)
    monkeypatch.setattr(hard_negatives, "GROUP", 2)
    rows = vectors(4, 300)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(2)
    assert sorted(tuple(r) for r in hard_negatives.mine(df, F.col("vec_id") % 100 == 0).collect()) == brute_negatives(rows)
    assert hard_negatives.mine(df.limit(0), F.col("vec_id") % 100 == 0).count() == 0
    assert hard_negatives.mine(df, F.col("vec_id") == -1).count() == 0


# --- urls ----------------------------------------------------------------------------------------


def brute_verdicts(rows):
    low = lambda s: re.sub("[A-Z]", lambda m: m[0].lower(), s)
    rules = {"org/": "allow", "example.org/es/": "block", "example.org/en/1": "block", "com/fr/": "allow", "com/de/": "block"}
    pages, n = [], defaultdict(lambda: [0, 0])
    for i, url, html in rows:
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        host, tail = re.match(r"([^/?#]*)([^?#]*)", rest).groups()
        host, rule = low(host), None
        for r in rules:
            h, p = r.split("/", 1)
            if (host == h or host.endswith("." + h)) and tail.startswith("/" + p) and (rule is None or len(r) > len(rule)):
                rule = r
        pages.append((i, host, tail, rule, low(html or "")))
        if host:
            n[host][0] += rules.get(rule) == "allow"
            n[host][1] += rules.get(rule) == "block"
    links = [Counter(), Counter()]
    for _, host, _, _, html in pages:
        if not host:
            continue
        found = set(re.findall(r"""(?:href|src|action)[ \t\r\n]*=[ \t\r\n]*["']?[ \t\r\n]*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"' \t\r\n<>]+)""", html)) - {host}
        links[0].update((host, d) for d in found)
        links[1].update((host, d) for d in set(re.findall(r"[a-z0-9-]+(?:\.[a-z0-9-]+)+", html)) - {host} if d in n)
    pair = {k: max(links[0][k], links[1][k]) for k in links[0].keys() | links[1].keys()}
    rank = []
    for kind in (0, 1):
        edges = {(s, d) if kind == 0 else (d, s): w for (s, d), w in pair.items()}
        every = Counter()
        for (s, _), w in edges.items():
            every[s] += w
        seed = {h: c[kind] * 1_000_000 for h, c in n.items()}
        x = Counter(seed)
        for _ in range(20):
            y = Counter(seed)
            for (s, d), w in edges.items():
                y[d] += int(np.floor(float(x[s]) * 0.85 * (float(w) / float(every[s]))))
            x = y
        rank.append(x)
    out = []
    for i, host, tail, rule, _ in pages:
        t, d = rank[0][host], rank[1][host]
        score = (t - d) / (t + d) if host and t + d else 0.0
        out.append((i, host, tail, rule, rules.get(rule) or ("block" if score < 0 else "allow"), round(score, 9)))
    return sorted(out, key=repr)


def test_url_filter(spark, monkeypatch):
    rnd = random.Random(5)
    hosts = [f"{a}{b}.{c}" for a in ("", "www.", "M.") for b in ("one", "two.example", "example", "spam-3") for c in ("com", "org", "net")]
    link = lambda: rnd.choice(['<a href="http://{}/x">', "<img SRC = //{}>", "text {} text", "<form action='https://{}?q'>", '<a href="/local">{}/']).format(rnd.choice(hosts))
    rows = [(i, f"http{'s' * (i % 2)}://{rnd.choice(hosts)}{rnd.choice(['/fr/1', '/de/2', '/es/3', '/en/1', '/en/2', '', '?a=/de/', '#x', '/DE/', '/es'])}", "<p>" + " ".join(link() for _ in range(rnd.randint(0, 6)))) for i in range(400)]
    rows += [(1000, None, "x"), (1001, "no scheme", None), (1002, "://", ""), (1003, "http:///de/", link()), (1004, "a\n://Example.ORG/es/\nx", None), (3, rows[3][1], rows[3][2]), (None, "http://q.com/de/", None)]
    rows += [(2000 + i, None, None) for i in range(50)] + [(3000, "http://big.net/", ""), (4000, "http://evil.com/de/1", None), (4001, "http://linker.net/", '<a href="http://evil.com/">')]
    long = "a" * 300_000 + " href=" + " " * 100_000  # no link; the patterns of brute force would never end on it
    df = spark.createDataFrame([(*r[:2], long if r[0] == 3000 else r[2], "x", 1) for r in rows], "page_id long, url string, html string, host string, pages int").repartition(3)
    monkeypatch.setattr(url_filter, "SPLIT", 2)
    got = url_filter.judge(df)
    assert got.columns == ["page_id", "host", "path", "rule", "verdict", "score"]
    assert sorted(((*r[:5], round(r[5], 9)) for r in got.collect()), key=repr) == brute_verdicts(rows)
    assert {r[4] for r in brute_verdicts(rows) if r[3] is None} == {"allow", "block"}
    assert url_filter.judge(df.limit(0)).count() == 0


# --- collocations --------------------------------------------------------------------------------


def brute_collocations(rows, max_n, least, top):
    n, f = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            for k in range(1, max_n + 1):
                f.update((lang, *w[i : i + k]) for i in range(len(w) - k + 1))
    out = defaultdict(list)
    candidates = {p: a for p, a in f.items() if len(p) > 2 and a >= least}
    cover = Counter()
    for (lang, *w), a in candidates.items():
        for k in range(2, len(w)):
            for i in range(len(w) - k + 1):
                cover[(lang, *w[i : i + k])] = max(cover[(lang, *w[i : i + k])], a)
    for (lang, *w), a in candidates.items():
        if 100 * cover[(lang, *w)] >= 50 * a:
            continue
        cuts = []
        for k in range(1, len(w)):
            left, right = f[(lang, *w[:k])], f[(lang, *w[k:])]
            cuts.append((1_000_000 * a * a // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        out[lang].append((-score, -a, " ".join(w).encode(), left, right))
    return sorted((lang, r, p.decode(), -a, left, right, n[lang], -s) for lang, found in out.items() for r, (s, a, p, left, right) in enumerate(sorted(found)[:top], 1))


def corpus(seed):
    rnd = random.Random(seed)
    vocab = ["the", "of", "The", "a", "stone", "été", "日本", "x\x01", "x", "x\x02b", "\x00", "q\x08"] + [f"w{i}" for i in range(60)]
    weights = [40, 20, 5, 15] + [3] * 8 + [1] * 60
    def text(k):
        return "".join(rnd.choices(vocab, weights)[0] + rnd.choice([" ", " ", " ", "  ", "\t", ", ", ".\n", "? "]) for _ in range(k))
    rows = [(text(rnd.randint(1, 200)), rnd.choice(["en", "en", "de", None, "und", "a b\tc"])) for _ in range(150)]
    copies = [rows[0]] * 30 + [("the the the the the", "en")] * 12 + [("is onhe w1 is onhe w2", "en")] * 25
    return rows + copies + [(None, "en"), ("", "en"), (" .,;\n", "fr"), ("one", "es"), (text(30_000), "en")]


@pytest.mark.parametrize(("max_n", "run"), [(3, None), (2, None), (4, None), (3, 512)])
def test_collocations(spark, monkeypatch, max_n, run):
    rows = corpus(max_n)
    df = spark.createDataFrame([(i, t, lang, 1, "x") for i, (t, lang) in enumerate(rows)], "doc_id long, text string, lang string, words int, phrase string").repartition(5)
    if run:  # long texts in many runs, also inside this process
        monkeypatch.setattr(collocations, "RUN", run)
        block = next(iter(collocations.blocks([_batch(rows[-1:])], ("lang",), 1 << 30)))
        total = Counter()
        for part, ends in collocations._runs(block, 2):
            for lang, words, numbers, count in collocations.suffixes(part, ends, 3):
                for s, c in zip(collocations._joined(lang, words, numbers).to_pylist(), count.tolist()):
                    total[s] += c
        whole = Counter()
        for part, ends in [(block, block.offs[1:])]:
            for lang, words, numbers, count in collocations.suffixes(part, ends, 3):
                for s, c in zip(collocations._joined(lang, words, numbers).to_pylist(), count.tolist()):
                    whole[s] += c
        assert total == whole and len(list(collocations._runs(block, 2))) > 100
    got = collocations.collocations(df, max_n=max_n, least=10, top=40)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(tuple(r) for r in got.collect()) == brute_collocations(rows, max_n, 10, 40)
    assert collocations.collocations(df.limit(0)).count() == 0


def _batch(rows):
    import pyarrow as pa

    return pa.RecordBatch.from_arrays([pa.array([0] * len(rows)), pa.array([t for t, _ in rows]), pa.array([lang for _, lang in rows])], names=["doc_id", "text", "lang"])
