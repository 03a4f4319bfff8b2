"""License scan by diagonal voting.

All rolling word k-grams of every text are joined to the places they have in the templates
(a fixed table, so it is broadcast).  A hit votes for the diagonal text place minus template
place.  A phrase is found where one diagonal has all its k-grams, which makes the match exact.
In longer templates neighbouring diagonals, which inserted or missing words cause, are merged,
and a merged span counts if it covers enough of the template without being much longer.

Only DataFrame operations are used.  Defined cases: a null text counts as empty; a text of fewer
than two words has no k-gram and no hit; equal rows give a row each, a null id is kept; other
columns are ignored.
"""

from __future__ import annotations

import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

K = 2
COVERAGE = 0.6
GAP = 3
SLACK = 8
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Phrases that name a license, and sentences that grant one, with their labels.
PHRASES = (("mit", "mit license"), ("apache", "apache license"), ("gpl", "general public license"))
GRANTS = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction"),
    ("apache", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
)
_START = 0  # the hash that stands before each text, so that texts without a hit keep a row
SLOTS = 1 << 12
_SEED = 42


def gram_hash(first: str, second: str) -> int:
    """Spark's xxhash64 of two words, signed."""
    h = xxhash.xxh64_intdigest(second.encode(), xxhash.xxh64_intdigest(first.encode(), _SEED))
    return h - (h >> 63 << 64)


def _slots() -> set[int]:
    """The last bits of the hashes of all templates' word pairs."""
    return {gram_hash(a, b) & (SLOTS - 1) for _, text in (*PHRASES, *GRANTS) for w in [text.split(" ")] for a, b in zip(w, w[1:])}


def templates(spark: SparkSession) -> DataFrame:
    """(gram, tid, tplace, label, grams, phrase): one row per k-gram of a template."""
    rows = [(_START, -1, 0, "", 0, False)]
    for tid, (label, text) in enumerate((*PHRASES, *GRANTS)):
        words = text.split(" ")
        n = len(words) - K + 1
        if n > 63:
            raise ValueError("a template has at most 63 word pairs")
        rows += [(gram_hash(words[i], words[i + 1]), tid, i, label, n, tid < len(PHRASES)) for i in range(n)]
    return spark.createDataFrame(rows, "gram long, tid int, tplace int, label string, grams int, phrase boolean")


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    lowered = F.translate(F.coalesce(F.col(text_col), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0))
    docs = df.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("rid"), words.alias("words"))
    known = templates(df.sparkSession)
    # a word pair whose hash no template pair has is left out before rows are made of the others
    pairs = F.zip_with("words", F.slice("words", 2, F.greatest(F.size("words"), F.lit(1))), lambda a, b: F.xxhash64(a, b))
    slots = _slots()
    flags = F.array(*(F.lit(k in slots) for k in range(SLOTS)))
    maybe = F.transform(pairs, lambda g, i: F.when(F.get(flags, g.bitwiseAND(F.lit(SLOTS - 1)).cast("int")), F.struct((i + 1).alias("at"), g.alias("gram"))))
    hits_of = F.filter(maybe, lambda x: x.isNotNull())
    start = F.array(F.struct(F.lit(0).alias("at"), F.lit(_START).alias("gram")))
    rolling = docs.select("doc_id", "rid", F.size("words").alias("n_words"), F.inline(F.concat(start, hits_of)))
    hits = rolling.join(F.broadcast(known), "gram").repartition("doc_id", "rid")
    votes = hits.groupBy("doc_id", "rid", "n_words", "tid", "label", "grams", "phrase", (F.col("at") - 1 - F.col("tplace")).alias("diagonal")).agg(
        F.count("*").alias("n"), F.bit_or(F.expr("shiftleft(1L, tplace)")).alias("seen"), F.min("at").alias("low"), F.max("at").alias("high")
    )
    by = Window.partitionBy("doc_id", "rid", "tid").orderBy("diagonal")
    steps = votes.withColumn("apart", F.when(F.col("phrase") | (F.col("diagonal") - F.lag("diagonal").over(by) > GAP), 1).otherwise(0))
    spans = (
        steps.withColumn("span", F.sum("apart").over(by))
        .groupBy("doc_id", "rid", "n_words", "tid", "label", "grams", "phrase", "span")
        .agg(F.sum("n").alias("n"), F.bit_count(F.bit_or("seen")).alias("covered"), F.min("low").alias("low"), F.max("high").alias("high"), F.min("diagonal").alias("diagonal"))
    )
    whole = F.col("phrase") & (F.col("covered") == F.col("grams"))
    long = ~F.col("phrase") & (F.col("tid") >= 0) & (F.col("covered") >= COVERAGE * F.col("grams")) & (F.col("high") - F.col("low") + K <= 1.5 * F.col("grams") + SLACK)
    found = spans.withColumn("whole", whole).withColumn("long", long)
    per = found.groupBy("doc_id", "rid", "n_words").agg(
        F.sum(F.when(F.col("tid") < 0, F.col("n")).otherwise(0)).alias("rows"),
        F.count_if("whole").alias("n_base"),
        F.min(F.when(F.col("whole"), F.col("diagonal"))).cast("long").alias("first_word"),
        F.max(F.when(F.col("whole"), F.col("diagonal"))).cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("whole"), F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("whole") | F.col("long"), F.col("label")))), ",").alias("labels"),
        F.coalesce(F.max(F.when(F.col("whole"), F.lit(1.0)).when(F.col("long"), F.col("covered") / F.col("grams"))), F.lit(0.0)).alias("score"),
    )
    # equal rows were counted together above
    return per.withColumn("row", F.explode(F.sequence(F.lit(1), F.col("rows").cast("int")))).select("doc_id", F.col("n_words").cast("long").alias("n_words"), "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def oracle() -> str:
    """The same rows in DuckDB's SQL over ``documents`` (ids without repeats)."""
    rows = [f"({tid}, {i}, '{' '.join(w[i : i + K])}', '{label}', {len(w) - K + 1}, {str(tid < len(PHRASES)).lower()})" for tid, (label, text) in enumerate((*PHRASES, *GRANTS)) for w in [text.split(" ")] for i in range(len(w) - K + 1)]
    return f"""
WITH t(tid, tplace, gram, label, grams, phrase) AS (VALUES {", ".join(rows)}),
d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
e AS (SELECT doc_id, unnest(w) AS a, unnest(list_concat(w[2:], [''])) AS b, unnest(range(len(w))) AS place FROM d),
h AS (SELECT e.doc_id, t.*, e.place, e.place - t.tplace AS diagonal FROM e JOIN t ON e.a || ' ' || e.b = t.gram),
v AS (SELECT doc_id, tid, label, grams, phrase, diagonal, min(place) AS low, max(place) AS high FROM h GROUP BY ALL),
s AS (SELECT *, CASE WHEN phrase OR diagonal - lag(diagonal) OVER (PARTITION BY doc_id, tid ORDER BY diagonal) > {GAP} THEN 1 ELSE 0 END AS apart FROM v),
i AS (SELECT *, sum(apart) OVER (PARTITION BY doc_id, tid ORDER BY diagonal) AS span FROM s),
c AS (SELECT i.doc_id, i.tid, i.label, i.grams, i.phrase, i.span, count(DISTINCT h.tplace) AS covered, min(i.low) AS low, max(i.high) AS high, min(i.diagonal) AS diagonal
      FROM i JOIN h ON h.doc_id = i.doc_id AND h.tid = i.tid AND h.diagonal = i.diagonal GROUP BY 1, 2, 3, 4, 5, 6),
f AS (SELECT *, phrase AND covered = grams AS whole, NOT phrase AND covered >= {COVERAGE} * grams AND high - low + {K} <= 1.5 * grams + {SLACK} AS long FROM c),
r AS (SELECT doc_id, count(*) FILTER (whole) AS n_base, min(diagonal) FILTER (whole) AS first_word, max(diagonal) FILTER (whole) AS last_word,
             string_agg(DISTINCT label, ',' ORDER BY label) FILTER (whole) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) FILTER (whole OR long) AS labels,
             max(CASE WHEN whole THEN 1.0::double WHEN long THEN covered::double / grams END) AS score FROM f GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::bigint AS n_words, coalesce(r.n_base, 0)::bigint AS n_base, r.first_word::bigint AS first_word, r.last_word::bigint AS last_word,
       coalesce(r.base_labels, '') AS base_labels, coalesce(r.labels, '') AS labels, coalesce(r.score, 0)::double AS score
FROM d LEFT JOIN r USING (doc_id)
"""
