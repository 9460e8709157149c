"""Licence scans by diagonal voting: word k-grams of every text are joined to
their places in licence templates; places on one diagonal (text position less
template position) are one placement of the template. DataFrame and SQL
functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialize, read_table

GRAM_WORDS = 2

#: Phrases that label a text wherever their words stand consecutively.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

#: Opening words of public licence notices, found with gaps and changes too.
NOTICES = {
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files": "mit-grant",
    "redistribution and use in source and binary forms with or without modification are permitted provided that": "bsd-terms",
    "you may not use this file except in compliance with the license you may obtain a copy of the license at": "apache-notice",
    "this program is free software you can redistribute it and or modify it under the terms of the": "gpl-notice",
    "this work is licensed under a creative commons attribution 4 0 international license": "cc-by-notice",
}

#: Diagonals this near are one placement: words were put in or left out.
DRIFT = 2

#: Share of a notice's k-grams that a placement must hold to label the text.
NOTICE_SHARE = 0.6

#: `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z. lower() also folds other letters, which makes no
    difference to ASCII phrases but for the two that fold to ASCII."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(text.contains("\u212a") | text.contains("\u0130"), F.translate(text, upper, upper.lower())).otherwise(F.lower(text))


def templates(spark: SparkSession) -> DataFrame:
    """(gram, tid, place, words, label, exact): a row for each k-gram of each
    template; place -1 is a mark that every text carries once. This is a fixed
    table of about a hundred rows, so it is broadcast."""
    rows = [(text.split(), label, exact) for kind, exact in ((PHRASES, True), (NOTICES, False)) for text, label in kind.items()]
    parts = ["select 0L gram, -1 tid, -1 place, cast(array() as array<string>) words, cast(null as string) label, false exact"]
    for tid, (words, label, exact) in enumerate(rows):
        listed = "array(" + ", ".join(f"'{w}'" for w in words) + ")"
        for place in range(len(words) - GRAM_WORDS + 1):
            pair = ", ".join(f"'{w}'" for w in words[place : place + GRAM_WORDS])
            parts.append(f"select xxhash64({pair}), {tid}, {place}, {listed}, '{label}', {str(exact).lower()}")
    return spark.sql(" union all ".join(parts))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, places (structs of label,
    start and n words of each base phrase), notices (structs of label, start, n
    and share of each notice placement) and the best share of any template.

    Null, empty and wordless texts have no words, places or notices; repeated
    rows stay repeated; ids may be null; other columns are not read.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"), F.xxhash64(text).alias("k1"), F.xxhash64(F.lit("text"), text).alias("k2"),
        F.regexp_extract_all(ascii_lower(text), F.lit(WORD), F.lit(0)).alias("words"))
    grams = F.zip_with(F.slice("words", 1, F.greatest(F.size("words") - 1, F.lit(0))),
                       F.slice("words", 2, F.greatest(F.size("words") - 1, F.lit(0))), lambda a, b: F.xxhash64(a, b))
    rolled = rows.select("doc_id", "k1", "k2", "words", F.posexplode(F.concat(F.array(F.lit(0).cast("long")), grams)).alias("pos", "gram"))
    known = templates(spark).withColumnRenamed("words", "phrase")
    met = rolled.join(F.broadcast(known), "gram").where((F.col("place") >= 0) | (F.col("pos") == 0))
    # pos counts from 1 behind the mark: the placement's first word, from 0, is its diagonal.
    diagonal = F.col("pos") - 1 - F.col("place")
    gram_there = F.slice("words", F.greatest(F.col("pos"), F.lit(1)), GRAM_WORDS) == F.slice("phrase", F.greatest(F.col("place") + 1, F.lit(1)), GRAM_WORDS)
    votes = met.where((F.col("place") < 0) | gram_there).select(
        "doc_id", "k1", "k2", "tid", "label", "exact", "place", diagonal.alias("diagonal"),
        F.size("words").alias("n_words"), (F.size("phrase") - GRAM_WORDS + 1).alias("grams"))
    # A row per text and per placement: stored, as three branches read it and the scan is the dear part.
    lines = materialize(votes.groupBy("doc_id", "k1", "k2", "tid", "label", "exact", "diagonal", "n_words", "grams").agg(
        F.collect_set("place").alias("placed"), F.count("*").alias("times")), "diagonals")
    base = lines.where(F.col("exact") & (F.size("placed") == F.col("grams")))
    marks = lines.where("tid < 0")
    # Neighbouring diagonals of one notice run together.
    by_notice = Window.partitionBy("doc_id", "k1", "k2", "tid").orderBy("diagonal")
    near = lines.where("tid >= 0 and not exact").withColumn(
        "fresh", F.coalesce(F.col("diagonal") - F.lag("diagonal").over(by_notice) > DRIFT, F.lit(True)).cast("int"))
    near = near.withColumn("cluster", F.sum("fresh").over(by_notice))
    merged = near.groupBy("doc_id", "k1", "k2", "tid", "cluster", "label", "n_words", "grams").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("placed")))).alias("held"),
        F.min(F.col("diagonal") + F.array_min("placed")).alias("first"),
        F.max(F.col("diagonal") + F.array_max("placed") + GRAM_WORDS).alias("stop"))
    share = F.col("held") / F.col("grams")
    no_place = F.lit(None).cast("struct<label:string,start:bigint,n:bigint>")
    no_notice = F.lit(None).cast("struct<label:string,start:bigint,n:bigint,share:double>")
    key = ["doc_id", "k1", "k2", "n_words"]
    every = (
        marks.select(*key, "times", no_place.alias("place"), no_notice.alias("notice"))
        .unionAll(base.select(*key, F.lit(None).cast("long"), F.struct(
            F.col("label"), F.col("diagonal").cast("long").alias("start"), (F.col("grams") + GRAM_WORDS - 1).cast("long").alias("n")), no_notice))
        .unionAll(merged.select(*key, F.lit(None).cast("long"), no_place, F.struct(
            F.col("label"), F.col("first").cast("long").alias("start"), (F.col("stop") - F.col("first")).cast("long").alias("n"), share.alias("share"))))
    )
    found = every.groupBy(*key).agg(
        F.max("times").alias("times"), F.sort_array(F.collect_list("place")).alias("places"), F.sort_array(F.collect_list("notice")).alias("notices"))
    best = F.when(F.size("places") > 0, F.lit(1.0)).otherwise(F.coalesce(F.array_max(F.transform("notices", lambda x: x["share"])), F.lit(0.0)))
    return found.select("doc_id", "n_words", "places", "notices", best.alias("score"), F.explode(F.sequence(F.lit(1), F.col("times"))).alias("_")).drop("_")


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    starts = F.transform("places", lambda p: p["start"])
    base = F.array_distinct(F.transform("places", lambda p: p["label"]))
    more = F.transform(F.filter("notices", lambda x: x["share"] >= NOTICE_SHARE), lambda x: x["label"])
    return found.select(
        "doc_id", F.col("n_words").cast("long").alias("n_words"), F.size("places").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        F.array_join(F.array_sort(base), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat(base, more))), ",").alias("labels"), "score")


def _op8_sql() -> str:
    rows = [(t, label, exact) for kind, exact in ((PHRASES, True), (NOTICES, False)) for t, label in kind.items()]
    listed = ", ".join(f"('{t}', '{label}', {exact})" for t, label, exact in rows)
    return rf"""
WITH t0(phrase, label, exact) AS (VALUES {listed}),
t AS (SELECT label, exact, string_split(phrase, ' ') AS p FROM t0),
d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
w AS (SELECT doc_id, ws, unnest(range(1, len(ws))) AS i FROM d WHERE len(ws) > 1),
tg AS (SELECT label, exact, p, unnest(range(1, len(p))) AS j FROM t),
tp AS (SELECT label, exact, len(p) - 1 AS grams, j, p[j] AS a, p[j + 1] AS b FROM tg),
g AS (SELECT doc_id, i, ws[i] AS a, ws[i + 1] AS b FROM w),
v AS (SELECT DISTINCT doc_id, label, exact, grams, i - j AS diag, j FROM g JOIN tp USING (a, b)),
base AS (SELECT doc_id, label, diag FROM v WHERE exact GROUP BY doc_id, label, diag, grams HAVING count(*) = grams),
ln AS (SELECT DISTINCT doc_id, label, grams, diag FROM v WHERE NOT exact),
lf AS (SELECT *, CASE WHEN diag - lag(diag) OVER (PARTITION BY doc_id, label ORDER BY diag) <= {DRIFT} THEN 0 ELSE 1 END AS fresh FROM ln),
lc AS (SELECT *, sum(fresh) OVER (PARTITION BY doc_id, label ORDER BY diag) AS cl FROM lf),
nt AS (SELECT doc_id, label, cl, count(DISTINCT j) / any_value(grams)::DOUBLE AS share
  FROM lc JOIN (SELECT doc_id, label, diag, j FROM v WHERE NOT exact) USING (doc_id, label, diag) GROUP BY doc_id, label, cl),
bs AS (SELECT doc_id, count(*) AS n, min(diag) AS f, max(diag) AS l, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM base GROUP BY doc_id),
ns AS (SELECT doc_id, max(share) AS share FROM nt GROUP BY doc_id),
al AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM (
  SELECT doc_id, label FROM base UNION ALL SELECT doc_id, label FROM nt WHERE share >= {NOTICE_SHARE}) GROUP BY doc_id)
SELECT d.doc_id, len(ws)::BIGINT AS n_words, coalesce(bs.n, 0)::BIGINT AS n_base, bs.f::BIGINT AS first_word, bs.l::BIGINT AS last_word,
  coalesce(bs.labels, '') AS base_labels, coalesce(al.labels, '') AS labels,
  CASE WHEN bs.n > 0 THEN 1.0 ELSE coalesce(ns.share, 0.0) END::DOUBLE AS score
FROM d LEFT JOIN bs USING (doc_id) LEFT JOIN ns USING (doc_id) LEFT JOIN al USING (doc_id)
"""


OP8_SQL = _op8_sql()
