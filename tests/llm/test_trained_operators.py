"""Operators that learn, by held-out accuracy, gradients and defined cases; and the pipeline's stages."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import lang_id, near_copies, toxicity

SYLLABLES = {"en": "th ing er and on ea sh".split(), "de": "sch ung ein ich er ß ü".split(), "es": "ción ado os la ñ ue mente".split()}


def prose(rnd, lang, n):
    return " ".join("".join(rnd.choice(SYLLABLES[lang]) for _ in range(rnd.randint(1, 3))) for _ in range(n)) + "."


@pytest.fixture(scope="module")
def docs(spark):
    rnd = random.Random(1)
    rows = []
    for i in range(240):
        lang = rnd.choice(list(SYLLABLES))
        t = prose(rnd, lang, rnd.randint(5, 120))
        if i % 6 == 0:
            w = t.split()
            w[rnd.randrange(len(w))] = rnd.choice(["idiot", "moron", "id10t", "i.d.i.o.t", "mooooron", "m0r0n"])
            t = " ".join(w)
        rows.append((i, t, lang, "s", len(t), int(i % 6 == 0)))
    rows += [(300, None, "en", "s", 0, None), (301, "", None, "s", 0, 0), (302, "12 !! 34", "en", "s", 8, 0), (None, prose(rnd, "de", 30), "de", "s", 9, 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, toxic int").cache()


def test_language_id(spark, docs):
    got = {r.doc_id: r for r in lang_id.identify(docs).collect()}
    assert len(got) == docs.count()
    truth = {r.doc_id: r.lang for r in docs.collect()}
    held = [i for i, r in got.items() if r.held_out and i is not None and i < 300]
    assert held and sum(got[i].lang_pred == truth[i] for i in held) >= 0.95 * len(held)
    assert [got[i].lang_pred for i in (300, 301, 302)] == ["und"] * 3 and got[300].score == 0
    assert all(0 <= r.score <= 1 for r in got.values())
    unlabelled = lang_id.identify(docs.withColumn("lang", F.lit(None).cast("string"))).select("lang_pred").distinct().collect()
    assert [r.lang_pred for r in unlabelled] == ["und"]
    assert lang_id.identify(docs.limit(0)).count() == 0


def test_network_gradients():
    rng = np.random.default_rng(2)
    layer = lang_id.Layer(rng, 3)
    layer.e, layer.u = layer.e.astype(np.float64), layer.u.astype(np.float64)
    x = rng.integers(0, 256, (7, 4)).astype(np.uint8)
    weight = rng.standard_normal((7, 4, 3))
    loss = lambda: float((layer.forward(x)[0] * weight).sum())
    _, tape = layer.forward(x, True)
    de, du = layer.backward(x, tape, weight)
    for matrix, grad in ((layer.u, du), (layer.e, de)):
        for at in [tuple(rng.integers(0, s) for s in matrix.shape) for _ in range(6)] + [(int(x[3, 1]), 4)] * (matrix is layer.e):
            old = matrix[at]
            matrix[at] = old + 1e-3
            up = loss()
            matrix[at] = old - 1e-3
            down = loss()
            matrix[at] = old
            assert abs((up - down) / 2e-3 - grad[at]) < 2e-2 * max(1.0, abs(grad[at]))


def test_windows_cover_every_byte():
    net = lang_id.Network(["a", "b"])
    rng = np.random.default_rng(1)
    size = np.array([0, 1, lang_id.WINDOW, lang_id.WINDOW + 1, 1000])
    buf = rng.integers(0, 256, size.sum()).astype(np.uint8)
    p = lang_id.document_probabilities(net, buf, np.concatenate(([0], np.cumsum(size))))
    assert np.allclose(p.sum(axis=1), [0, 1, 1, 1, 1], atol=1e-4)


def test_toxicity(spark, docs):
    labels = docs.select("doc_id", "toxic")
    got = {r.doc_id: r for r in toxicity.classify(docs.drop("toxic"), labels).collect()}
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got.values())
    held = [i for i, r in got.items() if r.held_out and i is not None and i < 300]
    right = sum(got[i].predicted == int(i % 6 == 0) for i in held)
    assert right >= 0.9 * len(held)
    assert got[300].score == got[301].score  # null as empty
    none = toxicity.classify(docs.drop("toxic"), labels.limit(0)).select("score").distinct().collect()
    assert [r.score for r in none] == [0.5]
    assert toxicity.classify(docs.drop("toxic").limit(0), labels).count() == 0


def test_deobfuscation():
    text = ("the idiot and the moron saw a stupid clown near the stone river " * 20).encode()
    code = toxicity._CODE[np.frombuffer(text, np.uint8)]
    counts = np.bincount(code[:-2] * 784 + code[1:-1] * 28 + code[2:], minlength=28**3)
    restore = toxicity.restorer(toxicity.CharModel(counts))
    for hidden in ("1d1ot", "i.d.i.o.t", "i d i o t", "idiooot", "id!ot"):
        assert "idiot" in toxicity.words_of(hidden, restore), hidden
    assert "river" in toxicity.words_of("A River, 2024", restore) and "2024" in toxicity.words_of("A River, 2024", restore)


def test_character_counts_do_not_depend_on_partitions(spark):
    rnd = random.Random(5)
    rows = [(" ".join(prose(rnd, "de", rnd.randint(0, 3)) for _ in range(2)),) for _ in range(12)] + [("",), (None,), ("a",), ("ab",), ("abc",)]
    one = toxicity.count_chars(spark.createDataFrame(rows, "text string").coalesce(1))
    many = toxicity.count_chars(spark.createDataFrame(rows, "text string").repartition(12))
    assert (one == many).all() and one.sum() == sum(max(0, len((t or "").encode()) - 2) for (t,) in rows)


def test_disguises_of_any_place_and_length():
    text = ("the idiot and the moron saw a stupid worthless clown you are a dumbass near the river " * 30).encode()
    code = toxicity._CODE[np.frombuffer(text, np.uint8)]
    restore = toxicity.restorer(toxicity.CharModel(np.bincount(code[:-2] * 784 + code[1:-1] * 28 + code[2:], minlength=28**3)))
    for hidden in ("1d10t", "idio7", "idi07", "id10t", "i" * 60 + "diot", "y o u a r e a w o r t h l e s s i d i o t"):
        assert "idiot" in toxicity.words_of(hidden, restore), hidden
    assert "dumbass" in toxicity.words_of("dumb@$$", restore)
    assert toxicity.words_of("stop! 2024-03-18 1,455", restore) == {"stop", "2024", "03", "18", "1", "455"}
    assert toxicity.words_of("a " * 40_000, restore)


def test_stages(spark, docs, tmp_path):
    import corpus_pipeline as p

    docs = docs.drop("toxic")
    columns = docs.columns
    rnd = random.Random(4)
    item = " ".join(prose(rnd, "en", 1) + str(k) for k in range(25))
    extra = spark.createDataFrame([(400, prose(rnd, "en", 60) + " " + item, "en", "s", 9), (401, "mail a@b.cd now please " + prose(rnd, "en", 40), "en", "s", 9)], docs.schema)
    first = docs.filter("doc_id = 3")
    docs = docs.unionByName(extra).unionByName(first.withColumn("doc_id", F.lit(402).cast("long")))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert [n for n, _ in p.STAGES] == ["language", "near_duplicates", "benchmark_leaks", "personal_data", "tokens"]

    ids = lambda df: {r.doc_id for r in df.select("doc_id").collect()}
    a = p.language(spark, docs, str(tmp_path))
    assert a.columns == columns and ids(docs) - ids(a) == {300, 301, 302}
    b = p.near_duplicates(spark, a, str(tmp_path))
    assert b.columns == columns
    found = {r.doc_id: r.component_id for r in near_copies.groups(a).collect()}
    assert 402 not in ids(b) and ids(b) == {i for i, c in found.items() if i == c} | {None}
    c = p.benchmark_leaks(spark, b, str(tmp_path))
    assert c.columns == columns and ids(b) - ids(c) == {400}
    d = p.personal_data(spark, c, str(tmp_path))
    assert d.columns == columns and d.filter("doc_id = 401").first().text.startswith("mail <EMAIL> now")
    assert d.filter("doc_id = 401 and n_chars = length(text)").count() == 1
    e = p.tokens(spark, d, str(tmp_path))
    assert ids(e) == ids(d) and e.filter("n_tokens <> size(ids)").count() == 0


def test_queries_are_registered():
    import __spark_entry__

    names = set(__spark_entry__.queries())
    assert {"pipeline", *(f"op{n}_" for n in range(1, 11))} <= {n if n == "pipeline" else n.split("_")[0] + "_" for n in names if n == "pipeline" or n.startswith("op")}
