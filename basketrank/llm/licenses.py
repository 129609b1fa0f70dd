"""License scans by diagonal voting, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import id_and_text

#: Words of a text after A-Z are lower-cased: runs of ASCII letters and digits and of anything beyond ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Length of the rolling word grams. The shortest phrase has two words.
GRAM = 2
#: A span is made of neighbouring diagonals (words inserted or left out): at most half of the template's words apart, and so many.
DRIFT = 8
#: Share of a template's grams that a span must have for its label.
THRESHOLD = 0.8

# Phrases whose every place is counted, with their labels.
PHRASES = (("cc-by", "cc by"), ("gpl", "general public license"), ("reserved", "all rights reserved"))
# Usual wordings of license notices, with their labels.
NOTICES = (
    ("apache-2.0", "licensed under the apache license version 2.0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that"),
    ("boost-1.0", "boost software license version 1.0"),
    ("cc-by-nc", "licensed under cc by nc"),
    ("cc-by-sa", "licensed under cc by sa"),
    ("cc0", "cc0 1.0 universal public domain dedication"),
    ("epl", "eclipse public license"),
    ("gpl", "gnu general public license version"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("lgpl", "gnu lesser general public license"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("mpl", "mozilla public license version"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
)

# Further headers, grants, identifiers and passages of the licenses' own texts.
WORDINGS = (
    ("agpl", "gnu affero general public license"),
    ("agpl", "spdx license identifier agpl"),
    ("apache-2.0", "apache license 2.0"),
    ("apache-2.0", "apache license version 2.0"),
    ("apache-2.0", "spdx license identifier apache"),
    ("apache-2.0", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("apache-2.0", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied"),
    ("bsd", "bsd 2 clause"),
    ("bsd", "bsd 3 clause"),
    ("bsd", "spdx license identifier bsd"),
    ("bsd", "the bsd license"),
    ("bsd", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    ("bsd", "nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("boost-1.0", "boost software license 1.0"),
    ("boost-1.0", "spdx license identifier bsl"),
    ("cc-by-nc", "creative commons attribution noncommercial"),
    ("cc-by-nc", "identifier cc by nc"),
    ("cc-by-sa", "creative commons attribution sharealike"),
    ("cc-by-sa", "identifier cc by sa"),
    ("cc0", "spdx license identifier cc0"),
    ("epl", "spdx license identifier epl"),
    ("gpl", "gnu gpl"),
    ("gpl", "spdx license identifier gpl"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("isc", "spdx license identifier isc"),
    ("isc", "the software is provided as is and the author disclaims all warranties with regard to this software"),
    ("lgpl", "gnu lgpl"),
    ("lgpl", "spdx license identifier lgpl"),
    ("mit", "spdx license identifier mit"),
    ("mit", "the mit license"),
    ("mit", "mit license mit"),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("mit", "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement"),
    ("mpl", "mozilla public license v 2.0"),
    ("mpl", "mozilla public license 2.0"),
    ("mpl", "spdx license identifier mpl"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license"),
    ("unlicense", "anyone is free to copy modify publish use compile sell or distribute this software"),
    ("unlicense", "spdx license identifier unlicense"),
)


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(WORD), F.lit(0))


def grams_of(words: Column) -> Column:
    """The text of every rolling gram, in order; none if there are fewer words than ``GRAM``."""
    starts = F.slice(words, F.lit(1), F.greatest(F.size(words) - (GRAM - 1), F.lit(0)))
    return F.transform(starts, lambda word, i: F.concat_ws(" ", word, *(F.get(words, i + n) for n in range(1, GRAM))))


def template_grams(spark: SparkSession, phrases=PHRASES, notices=NOTICES + WORDINGS) -> DataFrame:
    """``(template, label, base, length, place, gram, hash)``; ``length`` counts grams, 63 at most."""
    rows = [(label, text, True) for label, text in phrases] + [(label, text, False) for label, text in notices]
    listed = F.array(*[
        F.struct(F.lit(i).alias("template"), F.lit(label).alias("label"), F.lit(base).alias("base"), F.lit(text).alias("text"))
        for i, (label, text, base) in enumerate(rows)
    ])
    grams = spark.range(1).select(F.inline(listed)).withColumn("grams", grams_of(words_of(F.col("text"))))
    return grams.select(
        "template", "label", "base", F.size("grams").alias("length"), F.posexplode("grams").alias("place", "gram")
    ).withColumn("hash", F.xxhash64("gram"))


def in_order(votes: Column, length: Column) -> Column:
    """The most of ``votes`` (place in the text, place in the template) that follow each other in both."""
    ordered = F.array_sort(F.transform(votes, lambda v: F.struct(v["pos"].alias("pos"), (-v["place"]).alias("back"))))
    # For each place the longest sequence that ends there; votes of one place in the text come last place first.
    return F.array_max(F.aggregate(
        ordered, F.array_repeat(F.lit(0), length),
        lambda best, v: F.transform(best, lambda n, i: F.when(
            i == -v["back"], F.greatest(n, 1 + F.coalesce(F.array_max(F.slice(best, F.lit(1), i)), F.lit(0)))
        ).otherwise(n)),
    ))


def license_spans(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", phrases=PHRASES, notices=NOTICES + WORDINGS) -> DataFrame:
    """``(row, <id_col>, n_words, template, label, base, start, stop, first, last, coverage)``.

    A row for each span: words ``start`` (from 0) up to ``stop``, and the share of the template's grams that it has in
    the template's order, each once; of spans that share diagonals the best is kept, the first of equal ones;
    ``first`` and ``last`` are its outer diagonals. Each exact place of a phrase is a span. Rows of the input are told
    apart by ``row``, whatever their ids; each has also a row without a template.
    """
    spark = df.sparkSession
    words = id_and_text(df, id_col, text_col).select(
        F.monotonically_increasing_id().alias("row"), "id", words_of(F.col("text")).alias("words")
    )
    # A place of -1 keeps rows that no template meets.
    nothing = F.array(F.struct(F.lit(-1).alias("pos"), F.lit("").alias("gram")))
    grams = F.transform(grams_of(F.col("words")), lambda gram, i: F.struct(i.alias("pos"), gram.alias("gram")))
    rolled = words.select("row", "id", F.size("words").alias("n_words"), F.inline(F.concat(nothing, grams))).withColumn("hash", F.xxhash64("gram"))
    templates = template_grams(spark, phrases, notices)
    none = templates.limit(0).unionByName(
        spark.range(1).select(
            F.lit(-1).alias("template"), F.lit("").alias("label"), F.lit(False).alias("base"), F.lit(1).alias("length"),
            F.lit(-1).alias("place"), F.lit("").alias("gram"), F.xxhash64(F.lit("")).alias("hash"),
        )
    )
    # The templates are fixed: a few hundred grams. Equal hashes are verified by the grams themselves.
    found = rolled.join(F.broadcast(templates.unionByName(none)), ["hash", "gram"])
    # A diagonal meets a place of the template once, so that the sum of their bits is the set of its places.
    diagonals = found.groupBy(
        "row", "id", "n_words", "template", "label", "base", "length", (F.col("pos") - F.col("place")).alias("diagonal")
    ).agg(
        F.count("*").alias("votes"), F.sum(F.expr("shiftleft(1L, greatest(place, 0))")).alias("met"),
        F.min("pos").alias("start"), (F.max("pos") + GRAM).alias("stop"),
    )
    own = Window.partitionBy("row", "template").orderBy("diagonal")
    # Every diagonal is judged with its neighbours, and so also by itself. Phrases are exact: only a diagonal with all
    # votes is a place, and each is taken by itself.
    drift = F.when(F.col("base"), F.lit(0).cast("long")).otherwise(F.least(F.lit(DRIFT), F.floor((F.col("length") + GRAM - 1) / 2)))
    near = F.filter(
        F.collect_list(F.struct("diagonal", "met", "start", "stop")).over(own.rangeBetween(0, DRIFT)),
        lambda other: other["diagonal"] <= F.col("diagonal") + F.col("drift"),
    )
    votes = F.flatten(F.transform(F.col("near"), lambda other: F.transform(
        F.filter(F.sequence(F.lit(0), F.col("length") - 1), lambda place: F.getbit(other["met"], place) == 1),
        lambda place: F.struct((other["diagonal"] + place).alias("pos"), place.alias("place")),
    )))
    share = F.when(F.size("near") == 1, F.col("votes")).otherwise(in_order(votes, F.col("length"))) / F.col("length")
    judged = (
        diagonals.where(~F.col("base") | (F.col("votes") == F.col("length"))).withColumn("drift", drift).withColumn("near", near)
        .withColumn("coverage", F.when(F.col("template") < 0, 0.0).otherwise(share))
    )
    before = F.coalesce(F.max("coverage").over(own.rangeBetween(-DRIFT, -1)), F.lit(-1.0))
    after = F.coalesce(F.max("coverage").over(own.rangeBetween(1, DRIFT)), F.lit(-1.0))
    spans = judged.withColumn("before", before).withColumn("after", after).where("base OR (coverage > before AND coverage >= after)").select(
        "row", "id", "n_words", "template", "label", "base",
        F.array_min(F.transform("near", lambda other: other["start"])).alias("start"), F.array_max(F.transform("near", lambda other: other["stop"])).alias("stop"),
        F.col("diagonal").alias("first"),
        F.array_max(F.transform("near", lambda other: other["diagonal"])).alias("last"), "coverage",
    )
    columns = ("row", F.col("id").alias(id_col), "n_words", "template", "label", "base", "start", "stop", "first", "last", "coverage")
    return spans.select(*columns)


def license_scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(<id_col>, n_words, n_base, first_word, last_word, base_labels, labels, score)`` of each row.

    All rolling word grams of the whole text are joined with those of the templates; each meeting is a vote for the
    diagonal (place in the text less place in the template), neighbouring diagonals are merged, and a span gives its
    label if ``THRESHOLD`` of the template's different grams stand in it in their order. ``n_base`` counts the places where
    a phrase stands word for word, ``first_word`` and ``last_word`` are their smallest and largest start (null if none).
    ``score`` is the best coverage of any span, 1 where a phrase stands. Labels are distinct, sorted, joined by commas.
    Null and empty texts have no words and no labels; null ids stay null; repeated rows are scanned each; an empty table
    gives an empty one.
    """
    spans = license_spans(df, id_col, text_col)
    base, hit = F.col("base"), F.col("coverage") >= THRESHOLD

    def labels(which: Column) -> Column:
        return F.array_join(F.array_sort(F.collect_set(F.when(which, F.col("label")))), ",")

    return spans.groupBy("row", id_col, "n_words").agg(
        F.count(F.when(base, 1)).alias("n_base"),
        F.min(F.when(base, F.col("first").cast("long"))).alias("first_word"),
        F.max(F.when(base, F.col("last").cast("long"))).alias("last_word"),
        labels(base).alias("base_labels"), labels(base | hit).alias("labels"), F.max("coverage").alias("score"),
    ).select(id_col, F.col("n_words").cast("long").alias("n_words"), "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def oracle_sql() -> str:
    """The same scan of ``documents`` in DuckDB."""
    def listed(rows, base, first):
        return ", ".join(f"({first + i}, '{label}', '{text}', {base})" for i, (label, text) in enumerate(rows))

    values = f"{listed(PHRASES, 'TRUE', 0)}, {listed(NOTICES + WORDINGS, 'FALSE', len(PHRASES))}"
    return rf"""
    WITH words AS (
      SELECT row_number() OVER () AS row, doc_id,
             regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS words
      FROM documents),
    grams AS (SELECT row, doc_id, unnest(range(1, len(words))) AS i, words FROM words),
    rolled AS (SELECT row, i - 1 AS pos, words[i] || ' ' || words[i + 1] AS gram FROM grams),
    texts AS (SELECT template, label, base, regexp_extract_all(text, '{WORD}') AS words FROM (VALUES {values}) v(template, label, text, base)),
    places AS (SELECT template, label, base, len(words) - 1 AS length, unnest(range(1, len(words))) AS i, words FROM texts),
    templates AS (SELECT template, label, base, length, i - 1 AS place, words[i] || ' ' || words[i + 1] AS gram FROM places),
    diagonals AS (
      SELECT row, template, label, base, length, pos - place AS diagonal, count(*) AS votes,
             list({{'pos': pos, 'back': -place}}) AS met, least({DRIFT}, (length + 1) // 2) AS drift
      FROM rolled JOIN templates USING (gram) GROUP BY row, template, label, base, length, pos - place),
    neighbours AS (
      SELECT *, list_sort(list_filter(flatten(list(met) OVER near), lambda v: v.pos + v.back <= diagonal + drift)) AS found
      FROM diagonals WHERE NOT base
      WINDOW near AS (PARTITION BY row, template ORDER BY diagonal RANGE BETWEEN CURRENT ROW AND {DRIFT} FOLLOWING)),
    judged AS (
      -- for each place the longest sequence that ends there, beginning with zeros
      SELECT row, label, base, length, NULL::BIGINT AS first, list_max(list_reduce(
               list_concat([list_transform(range(length), lambda i: 0::BIGINT)], list_transform(found, lambda v: [(-v.back)::BIGINT])),
               lambda best, v: list_concat(best[1:v[1]], [greatest(best[v[1] + 1], 1 + coalesce(list_max(best[1:v[1]]), 0))], best[v[1] + 2:])
             ))::DOUBLE / length AS coverage
      FROM neighbours),
    spans AS (
      SELECT row, label, base, 0 AS places, first, coverage FROM judged
      UNION ALL
      SELECT row, label, base, 1 AS places, diagonal AS first, 1.0::DOUBLE AS coverage FROM diagonals WHERE base AND votes = length),
    scans AS (
      SELECT row, coalesce(sum(places) FILTER (base), 0)::BIGINT AS n_base, min(first) FILTER (base) AS first_word,
             max(first) FILTER (base) AS last_word,
             coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base), '') AS base_labels,
             coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base OR coverage >= {THRESHOLD}), '') AS labels,
             max(coverage) AS score
      FROM spans GROUP BY row)
    SELECT doc_id, len(words) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
           coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0::DOUBLE) AS score
    FROM words LEFT JOIN scans USING (row)
    """
