"""Operators with one right answer, against brute force on small tables with every awkward case."""

import base64
import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from ledgerloom.llm import byte_bpe, components, decontaminate, katz, licenses, pii, rp_forest, simhash, substring_dedup
from ledgerloom.llm.kernels import fold_crc

VOCAB = "the of and in to stone river lamp Mit license apache General Public License été straße 日本 a b c d e".split()


def texts(seed=3, n=60):
    """Texts with copies, near copies, shared passages, repeated words, empties and a long one."""
    rnd = random.Random(seed)
    some = lambda k: " ".join(rnd.choice(VOCAB) + str(rnd.randint(0, 40)) * (rnd.random() < 0.6) for _ in range(k))
    passage = some(30)
    out = [some(rnd.randint(1, 80)) for _ in range(n)]
    out += [out[0], out[0], out[1] + " x", f"{some(5)} {passage} {some(5)}", f"{passage}\n{some(20)}", f"a\t\t{passage}"]
    out += [None, "", "   ", "one", "the " * 50, "x y " * 30, some(4000), "İ K \x1c mit license"]
    return out


@pytest.fixture(scope="module")
def rows():
    return [(i, t) for i, t in enumerate(texts())]


@pytest.fixture(scope="module")
def docs(spark, rows):
    # more columns, some with names that results use
    return spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, fingerprint string, fp int")


def words_of(text, lower=False):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in w] if lower else w


def test_simhash(spark, docs, rows):
    prints = {}
    for i, t in rows:
        w = words_of(t, True)
        s = [" ".join(w[j : j + 3]) for j in range(max(1, len(w) - 2))] if w else []
        h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
        prints[i] = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
    parent = {i: i for i in prints}

    def root(i):
        return i if parent[i] == i else root(parent[i])

    for a, b in itertools.combinations(prints, 2):
        if (prints[a] ^ prints[b]).bit_count() <= 3:
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs).collect()}
    assert got == {i: (f"{p:016x}", root(i)) for i, p in prints.items()}


def test_anchors_meet_every_pair_within_three_bits():
    rnd = random.Random(1)
    for _ in range(500):
        a = rnd.getrandbits(64)
        b = a
        for k in rnd.sample(range(64), rnd.randint(0, 3)):
            b ^= 1 << k
        met = False
        for side in (0, 32):
            x, y = np.array([a >> side & 0xFFFFFFFF]), np.array([b >> side & 0xFFFFFFFF])
            met |= int(simhash.homes(x)[0]) in simhash.visits(y)[1].tolist()
        assert met


def test_components(spark):
    rnd = random.Random(5)
    edges = [(i, i + 1) for i in range(100, 160)] + [(rnd.randint(0, 80), rnd.randint(0, 80)) for _ in range(40)] + [(3, None), (7, 7)]
    got = {r.node: r.component for r in components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want: dict[int, int] = {}
    for a, b in edges:
        if b is not None and a != b:
            ids = {want.get(a, a), want.get(b, b)}
            low = min(ids)
            want |= {a: low, b: low}
            want |= {k: low for k, v in want.items() if v in ids}
    assert got == want
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_substring_dedup(spark, docs, rows):
    first = {}
    for i, t in rows:
        w = words_of(t)
        for j in range(len(w) - 12):
            first.setdefault(tuple(w[j : j + 13]), i)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup.remove_repeats(docs).collect()}
    want = {}
    for i, t in rows:
        w = words_of(t)
        gone = [False] * len(w)
        for j in range(len(w) - 12):
            if first[tuple(w[j : j + 13])] < i:
                gone[j : j + 13] = [True] * 13
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        want[i] = (len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
    assert got == want


def test_substring_dedup_of_equal_ids_and_rows(spark):
    t = " ".join(f"w{i}" for i in range(30))
    df = spark.createDataFrame([(5, t), (5, t), (5, t + " more"), (9, t), (None, t)], "doc_id long, text string")
    got = sorted((r.doc_id, r.n_removed) for r in substring_dedup.remove_repeats(df).collect() if r.doc_id is not None)
    assert [r.n_removed for r in substring_dedup.remove_repeats(df).collect() if r.doc_id is None] == [0]
    assert got == [(5, 0), (5, 0), (5, 0), (9, 30)]


def test_windows_need_both_hashes():
    g, check = np.array([7, 7, 7, 8], np.uint64), np.array([1, 2, 1, 1], np.int32)
    assert substring_dedup._labels(g, check).tolist() == [1, 2, 1, 3]


def luhn(d):
    return sum(int(c) if i % 2 == 0 else sum(divmod(int(c) * 2, 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def test_pii_base_spans():
    rnd = random.Random(2)
    plain = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }
    ok = {
        "email": lambda s: True, "ip": lambda s: all(int(p) <= 255 for p in s.split(".")),
        "card": lambda s: 12 <= len(d := re.sub("[ -]", "", s)) <= 19 and luhn(d), "phone": lambda s: 9 <= sum(c.isdigit() for c in s) <= 15,
    }
    pieces = ["a@b.c", "x@y", "@", "a.b+c@d-e.f.g", "1.2.3.4", "300.1.1.1", "1.2.3.4.5.6.7.8", "4111 1111 1111 1111", "4111111111111112", "+1 (555) 010-1234", "+", "12", "é", " ", ".", "-", "a@b.c@d.e", "0" * 20, "378282246310005"]
    for _ in range(800):
        t = "".join(rnd.choice(pieces) for _ in range(rnd.randint(0, 12)))
        want = sorted(((k, m.start(), m.end()) for k, p in plain.items() for m in re.finditer(p, t) if ok[k](m[0])), key=lambda x: (x[1], list(plain).index(x[0])))
        assert pii.base_spans(t) == want, t


def test_pii_account_numbers_before_capital_words():
    ibans = lambda t: [t[s:e] for k, s, e, _ in pii.find_spans(t)[1] if k == "iban"]
    assert ibans("BE68 5390 0754 7034 BIC") == ["BE68 5390 0754 7034"]
    assert ibans("pay AT611904300234573201 EUR now") == ["AT611904300234573201"]
    assert ibans("BE68 5390 0754 7034 SWIFT2 X") == ibans("BE68 5390 0754 7034 CODE 1234 EUR") == ["BE68 5390 0754 7034"]
    assert ibans("BE68 5390 0754 7034 AT61 1904 3002 3457 3201 EUR") == ["BE68 5390 0754 7034", "AT61 1904 3002 3457 3201"]
    assert ibans("REF AB12 CDEF BE68 5390 0754 7034 BIC") == ["BE68 5390 0754 7034"]
    assert ibans("BE69 5390 0754 7034 BIC") == []
    assert pii.clean("BE68 5390 0754 7034 BIC") == "<IBAN> BIC"


def test_pii_on_a_table(spark):
    t = "é card 4111 1111 1111 1111, IBAN DE89370400440532013000 and token = 24be64439e3e49cf46b2d7c90f3602a3d0b907ff"
    df = spark.createDataFrame([(1, t, "s"), (2, None, "s"), (None, "", "s"), (1, t, "s")], "doc_id long, text string, spans string")
    got = pii.detect(df).collect()
    assert [(r.doc_id, r.n_card, r.n_email) for r in got] == [(1, 1, 0), (2, 0, 0), (None, 0, 0), (1, 1, 0)]
    assert got[0].spans.split(",")[0] == "card:7:26" and "iban:" in got[0].spans and "secret:" in got[0].spans
    assert got[1].base_sha256 == hashlib.sha256(b"").hexdigest()
    out = pii.redact(df).collect()
    assert out[0].text == "é card <CARD>, IBAN <IBAN> and token = <SECRET>" and out[1].text is None
    assert pii.mod97("DE89370400440532013000") and not pii.mod97("DE88370400440532013000")
    long = "a" * 200_000 + " " + "1" * 100_000 + " +1" * 1000
    assert pii.find_spans(long)[0] == []  # linear time


def test_bpe(spark, docs, rows):
    import public_tokenizers
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb"))}
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = {}
    for i, t in rows:
        ids = own.encode_ordinary(t or "")
        want[i] = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())
    shape = lambda df: {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in df.collect()}
    assert shape(byte_bpe.digest(docs)) == want
    few = docs.filter("doc_id % 9 = 0")
    assert shape(byte_bpe.native_digest(few)) == {i: v for i, v in want.items() if i % 9 == 0}
    assert byte_bpe.fold_bytes(b"a" * 30_000, ranks)  # n log n


def test_licenses(spark, docs, rows):
    got = {r.doc_id: (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in licenses.scan(docs).collect()}
    phrases = {"mit": ["mit", "license"], "apache": ["apache", "license"], "gpl": ["general", "public", "license"]}
    for i, t in rows:
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        at = [(j, k) for k, p in phrases.items() for j in range(len(w)) if w[j : j + len(p)] == p]
        places = [j for j, _ in at]
        assert got[i] == (len(w), len(at), min(places, default=None), max(places, default=None), ",".join(sorted({k for _, k in at})))


def test_license_grants_and_repeated_rows(spark):
    grant = "Redistribution, and use in source or binary forms with or without any modification are permitted provided that the following conditions are met:"
    df = spark.createDataFrame([(1, grant), (1, grant), (None, "MIT License"), (2, None)], "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.labels, r.n_base) for r in licenses.scan(df).collect())
    assert got == [(0, "mit", 1), (1, "bsd", 0), (1, "bsd", 0), (2, "", 0)]


def edit(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row


def test_decontamination_recall_and_precision(spark):
    rnd = random.Random(8)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 6)))
    items = [(k, " ".join(word() for _ in range(rnd.randint(12, 60)))) for k in range(30)] + [(98, None), (99, "two words")]
    docs, planted = [], {}
    for i in range(200):
        body = [word() for _ in range(rnd.randint(0, 300))]
        if i % 2:
            k, t = items[rnd.randrange(30)]
            w = t.split()
            for _ in range(rnd.randint(0, int(0.15 * len(w)))):
                p = rnd.randrange(len(w))
                w[p : p + 1] = rnd.choice(([], [word()], [w[p], word()]))
            if 1 - min(edit(t.split(), w)[-1], 99) / max(len(w), len(t.split())) >= 0.8:
                planted[i] = k
                at = rnd.randint(0, len(body))
                body[at:at] = [w[0].upper(), *w[1:]]
        docs.append((i, " ".join(body)))
    docs += [(None, items[0][1]), (500, None), (501, ""), (502, " ".join(["the"] * 3000))]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.leaks(df, spark.createDataFrame(items, "item_id long, text string")).collect()}
    want = set(planted.items())
    assert not got - want
    assert len(got & want) >= 0.97 * len(want)
    left = decontaminate.decontaminate(df, spark.createDataFrame(items, "item_id long, text string"))
    assert left.count() == len(docs) - len({d for d, _ in got}) and left.columns == df.columns
    two_blocks = decontaminate.leaks(df, spark.createDataFrame(items, "item_id long, text string"), block_items=16)
    assert {(r.doc_id, r.item_id) for r in two_blocks.collect()} == got
    assert decontaminate.leaks(df.limit(0), spark.createDataFrame([], "item_id long, text string")).count() == 0


def test_decontamination_misses_no_passage_within_the_edits(spark):
    rnd = random.Random(12)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(3, 7)))
    lengths = [*range(20, 90), 120, 160, 200] * 2  # more distinct lengths than classes
    items, docs = [], []
    for k, n in enumerate(lengths):
        w = [word() for _ in range(n)]
        items.append((k, " ".join(w)))
        for kind in range(3):
            v = list(w)
            for p in sorted(rnd.sample(range(1, n), n // 5), reverse=True):
                v[p : p + 1] = ([], [word(), v[p]], [word()])[kind]
            docs.append((3 * k + kind, " ".join([*(word() for _ in range(30)), *v, *(word() for _ in range(30))])))
    found = decontaminate.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(i, i // 3) for i in range(len(docs))}


def test_decontamination_against_all_windows(spark):
    rnd = random.Random(21)
    word = lambda: "".join(rnd.choice("abc") for _ in range(rnd.randint(1, 3)))
    items = [(k, " ".join(word() for _ in range(n))) for k, n in enumerate([1, 2, 3, 4, 5, 6, 8, 10, 14, 20, 20, 25])] + [(50, ""), (51, None)]
    docs = []
    for i in range(60):
        w = items[rnd.randrange(12)][1].split()
        for _ in range(rnd.randint(0, 5)):
            p = rnd.randrange(len(w) + 1)
            w[p : p + 1] = rnd.choice(([], [word()], [word(), word()]))
        body = [word() for _ in range(rnd.randint(0, 20))]
        docs.append((i, " ".join([*body, *w[: len(w) - rnd.choice([0, 0, 1, 3])], *(word() for _ in range(rnd.choice([0, 0, 4])))])))
    docs += [(3, items[9][1]), (3, "x " + items[9][1]), (70, None), (71, "")]
    want = set()
    for d, text in docs:
        w = (text or "").split()
        for k, item in items:
            a = (item or "").split()
            for s in range(len(w) if a else 0):
                row = edit(a, w[s : s + int(len(a) / 0.8) + 1])
                if any(dist <= 0.2 * max(len(a), e) + 1e-9 and e for e, dist in enumerate(row)):
                    want.add((d, k))
    found = decontaminate.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    got = {(r.doc_id, r.item_id) for r in found}
    exact = {(d, k) for d, t in docs for k, item in items if item and f" {item} " in f" {t} "}
    print(len(want), len(got), sorted(want - got), sorted(got - want))
    assert exact <= got <= want
    assert got == want


def test_distance_to_the_nearest_beginning():
    rnd = random.Random(13)
    for _ in range(300):
        a, b = ([rnd.randrange(4) for _ in range(rnd.randint(1, 80))] for _ in range(2))
        row = edit(a, b)
        end = min(range(len(b) + 1), key=lambda e: (row[e], abs(e - len(a)), e))
        assert decontaminate.distance(np.array(a, np.uint64), np.array(b, np.uint64)) == (row[end], end)


def test_neighbours(spark):
    rng = np.random.default_rng(4)
    x = rng.standard_normal((1500, 16)).astype(np.float32)
    data = [(i, v.tolist(), 0) for i, v in enumerate(x)] + [(2000 + i, x[7].tolist(), 0) for i in range(30)]
    data += [(3000, None, 0), (3100, [0.0] * 16, 0), (3200, [1.0, None] * 8, 0), (3300, [float("nan")] * 16, 0), (3400, [1.0] * 5, 0), (None, [1.0] * 16, 0)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>, score int")
    got: dict[int, list] = {}
    for r in rp_forest.nearest(df, sample=512).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    ids = np.array([i for i, v, _ in data[:1530]])
    v = np.array([v for _, v, _ in data[:1530]], dtype=np.float64)
    hit = 0
    asked = [i for i in ids if i % 100 == 0]
    assert set(got) == set(asked)
    for q in asked:
        d = np.sqrt(((v - v[list(ids).index(q)]) ** 2).sum(axis=1))
        order = [int(ids[j]) for j in np.lexsort((ids, d)) if ids[j] != q][:10]
        mine = sorted(got[q])
        assert [m[0] for m in mine] == list(range(1, 11))
        assert all(abs(s - d[list(ids).index(i)]) < 1e-12 for _, i, s in mine)
        assert [(s, i) for _, i, s in mine] == sorted((s, i) for _, i, s in mine)
        hit += len(set(order) & {m[1] for m in mine})
    assert hit >= 0.9 * 10 * len(asked)
    assert [i for _, i, _ in sorted(got[2000])] == [7, *range(2001, 2010)]
    assert rp_forest.nearest(df.limit(0)).count() == 0


def test_neighbours_below_the_fitted_leaves(spark):
    rng = np.random.default_rng(9)
    v = rng.standard_normal((1600, 12))
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>")
    assert rp_forest.Forest(v[:64], 1600).extra > 0
    hit = 0
    for r in rp_forest.nearest(df, every=20, sample=64, query_block=32).groupBy("query_id").agg({"vec_id": "collect_set"}).collect():
        d = ((v - v[r[0]]) ** 2).sum(axis=1)
        d[r[0]] = np.inf
        hit += len(set(np.argsort(d)[:10].tolist()) & set(r[1]))
    assert hit >= 0.9 * 10 * 80


def test_katz_base_and_normalisation(spark, rows):
    df = spark.createDataFrame([*rows, (None, "the of and"), (0, rows[0][1])], "doc_id long, text string")
    got = katz.held_out_scores(df).collect()
    assert len(got) == len(rows) + 2
    every = [*rows, (None, "the of and"), (0, rows[0][1])]
    train = [t for i, t in every if i is not None and zlib.crc32(str(i).encode()) % 7 != 2]
    counts: dict = {}
    for t in train:
        for w in [*words_of(t, True), None]:
            counts[w] = counts.get(w, 0) + 1
    n, v = sum(counts.values()), len(counts)
    by_id = {}
    for r in got:
        by_id.setdefault(r.doc_id, r)
    for i, t in every:
        tokens = [*words_of(t, True), None]
        r = by_id[i]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(tokens), sum(w in counts for w in tokens), n)
        assert math.isclose(r.base_score, sum(math.log10((counts.get(w, 0) + 1) / (n + v + 1)) for w in tokens), rel_tol=1e-9)
        assert math.isfinite(r.score) and r.score < 0


def katz_by_hand(train, K=katz.K):
    """(probability of a word after a history, words of the vocabulary, histories) from plain dictionaries; None is the
    end, a word outside the vocabulary stands for the unseen class."""
    one, two = {}, {}
    for text in train:
        tokens = [*words_of(text, True), None]
        for h, w in zip([None, *tokens], tokens, strict=False):
            one[w] = one.get(w, 0) + 1
            two.setdefault(h, {})[w] = two.get(h, {}).get(w, 0) + 1
    times = lambda counts: np.bincount(np.minimum(list(counts), K + 2), minlength=K + 3)[1 : K + 2]
    d1, d2 = katz.discounts(times(one.values())), katz.discounts(times(c for r in two.values() for c in r.values()))
    kept = lambda c, d: c * (d[c - 1] if c <= K else 1.0)
    n = sum(one.values())
    freed = n - sum(kept(c, d1) for c in one.values())
    whole = n if any(c <= K for c in one.values()) else n + 1
    uni = lambda w: kept(one[w], d1) / whole if w in one else (freed if whole == n else 1) / whole

    def p(h, w):
        row = two.get(h)
        if row is None:
            return uni(w)
        total = sum(row.values()) + all(c > K for c in row.values())
        if w in row:
            return kept(row[w], d2) / total
        return (total - sum(kept(c, d2) for c in row.values())) / total / (1 - sum(uni(x) for x in row)) * uni(w)

    return p, list(one), list(two)


@pytest.mark.parametrize("batch_bytes", [katz.BATCH_BYTES, 500])
def test_katz_against_dictionaries(spark, rows, batch_bytes):
    many = [(1000 + i, "often seen words") for i in range(40)]  # histories without a discounted count
    df = spark.createDataFrame([*rows, *many, (None, "often seen words of words unheard"), (2000, "")], "doc_id long, text string")
    every = [tuple(r) for r in df.collect()]
    train = [t for i, t in every if i is not None and i % 5]
    p, vocabulary, histories = katz_by_hand(train)
    for h in [*histories[:40], "seen", "unheard"]:
        assert math.isclose(sum(p(h, w) for w in [*vocabulary, "unheard"]), 1, rel_tol=1e-9)
    want = []
    for i, t in every:
        tokens = [*words_of(t, True), None]
        want.append((-1 if i is None else i, sum(math.log10(p(h, w)) for h, w in zip([None, *tokens], tokens, strict=False))))
    got = [(-1 if r.doc_id is None else r.doc_id, r.score) for r in katz.score(df, F.col("doc_id") % 5 != 0, batch_bytes=batch_bytes).collect()]
    for (i, x), (j, y) in zip(sorted(want), sorted(got), strict=True):
        assert i == j and math.isclose(x, y, rel_tol=1e-9)


def test_katz_counts_from_255_on(spark):
    df = spark.createDataFrame([(i, "a b " * 200) for i in range(1, 4)] + [(5, "a c")], "doc_id long, text string")
    p, _, _ = katz_by_hand([r.text for r in df.collect()])
    by_id = {r.doc_id: r for r in katz.score(df).collect()}
    assert math.isclose(by_id[5].score, math.log10(p(None, "a")) + math.log10(p("a", "c")) + math.log10(p("c", None)), rel_tol=1e-9)
    assert (by_id[5].n_known, by_id[5].train_tokens) == (3, 1206)


def test_katz_learns_from_nothing(spark):
    df = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    assert sorted((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in katz.score(df, F.lit(False)).collect()) == [(1, 3, 0, 0, 0.0, 0.0), (2, 1, 0, 0, 0.0, 0.0)]


def test_folds(spark):
    df = spark.createDataFrame([(i,) for i in (0, 7, 123456, -5)], "doc_id long")
    assert [r.x for r in df.select(fold_crc("doc_id", 7).alias("x")).collect()] == [zlib.crc32(str(i).encode()) % 7 for i in (0, 7, 123456, -5)]
