"""Near copies at 0.8: recall of planted ones, no link between different texts, chains of large groups."""

import random

from ledgerloom.llm import near_copies


def test_recall_and_precision(spark):
    rnd = random.Random(6)
    word = lambda: "".join(rnd.choice("abcdefghijklm") for _ in range(rnd.randint(2, 7)))
    sets = lambda w: {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
    rows, pairs = [], []
    for i in range(300):
        w = [word() for _ in range(rnd.randint(60, 300))]
        rows.append((i, " ".join(w)))
        if i % 3 == 0:
            v = list(w)
            for _ in range(rnd.randint(0, len(w) // 60)):
                v[rnd.randrange(len(v))] = word()
            a, b = sets(w), sets(v)
            if len(a & b) / len(a | b) >= 0.85:
                pairs.append((i, 1000 + i))
                rows.append((1000 + i, " ".join(v).upper()))
    big = [word() for _ in range(200)]
    for i in range(120):
        v = list(big)
        v[i] = word()
        rows.append((5000 + i, " ".join(v)))
    rows += [(9000, None), (9001, ""), (9002, " "), (9003, "one two"), (9004, "one  TWO"), (None, "one two"), (0, rows[0][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in near_copies.groups(df).collect()}
    assert sum(got[b] == a for a, b in pairs) >= 0.93 * len(pairs) and len(pairs) > 60
    assert all(got[i] == i for i in range(300))
    assert {got[5000 + i] for i in range(120)} == {5000}
    assert got[9001] == got[9002] == 9000 and got[9004] == got[9003] == 9003
    kept = near_copies.keep_representatives(df)
    assert sorted(r.doc_id for r in kept.filter("doc_id is not null").collect()) == sorted(i for i, c in got.items() if i == c)
    assert kept.filter("doc_id is null").count() == 1
    assert near_copies.groups(df.limit(0)).count() == 0


def test_plan_grows_with_the_corpus():
    assert near_copies.plan(10**3, 0.8)[0] < near_copies.plan(10**9, 0.8)[0]
    assert near_copies._nearest().tolist().count(0) == 8


CODED = "key long, node long, part long, head long, tail long"


def test_every_pair_of_a_bucket_meets(spark):
    rnd = random.Random(3)
    signed = lambda x: x - (x >> 63 << 64)
    rows = [(k, 100 * k + i, 100 * k + i - i % 3, signed(i % 2 << 63 ^ rnd.getrandbits(rnd.choice([3, 40]))), signed(rnd.getrandbits(20))) for k in (1, 2) for i in range(90)]
    rows.append((3, 500, 500, 0, 0))
    apart = lambda a, b: sum(((a[c] ^ b[c]) & (1 << 64) - 1).bit_count() for c in (3, 4))
    limit = near_copies.bit_limit(128, 0.8, 4)
    want = {(a[1], b[1]) for a in rows for b in rows if a[0] == b[0] and a[1] < b[1] and a[2] != b[2] and apart(a, b) <= limit}
    coded = spark.createDataFrame(rows, CODED)
    pairs = lambda df: {(min(r.node, o), max(r.node, o)) for r in df.collect() for o in r.others}
    for tile in (1000, 8, 1):
        assert pairs(near_copies.bucket_pairs(coded, 0.8, False, tile)) == want
    by_id = {r[1]: r for r in rows}
    nearest = pairs(near_copies.bucket_pairs(coded, 0.8, True))
    assert nearest <= want and {i for p in nearest for i in p} == {i for p in want for i in p} and len(nearest) <= len(rows)
    for i in {i for p in want for i in p}:
        least = min(apart(by_id[x], by_id[y]) for x, y in want if i in (x, y))
        assert any(i in p and apart(by_id[p[0]], by_id[p[1]]) == least for p in nearest)


def test_links_are_decided_by_the_exact_similarity(spark):
    rnd = random.Random(11)
    word = lambda: "".join(rnd.choice("abcdefghijklm") for _ in range(rnd.randint(3, 8)))
    sets = lambda w: {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
    rows, near, far = [], [], []
    while len(near) < 120 or len(far) < 120:
        w = [word() for _ in range(rnd.randint(150, 300))]
        v = list(w)
        cut = rnd.randint(len(w) // 10, len(w) // 7)  # the end of the text is new
        v[-cut:] = [word() for _ in range(cut)]
        a, b = sets(w), sets(v)
        s, i = len(a & b) / len(a | b), len(rows)
        side = near if 0.8 <= s <= 0.84 else far if 0.74 <= s <= 0.79 else None
        if side is not None and len(side) < 120:
            side.append((i, i + 1))
            rows += [(i, " ".join(w)), (i + 1, " ".join(v))]
    got = {r.doc_id: r.component_id for r in near_copies.groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert sum(got[b] == a for a, b in near) >= 0.93 * len(near)
    assert all(got[b] == b for _, b in far)
