"""License scans by diagonal voting.

Every rolling word k-gram of a document is joined with the k-grams of license templates. A hit at
document word i and template word j votes for the diagonal i - j: words that follow a template vote
for one diagonal, an inserted or dropped word moves the rest to a neighbouring one. Votes are added up per
diagonal, neighbouring diagonals are merged into spans, and a span counts when it holds enough of its
template's k-grams, each once and in the template's order. The base phrases are templates too, of which every k-gram must be hit.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import cut, numbered, table, whole_text
from ledgerlake.llm.words import words_of

#: Words of a k-gram: of phrases, and of the longer templates.
PHRASE_GRAM, TEXT_GRAM = 2, 4
#: Share of a template's k-grams that a span must hold, and how far neighbouring diagonals may lie apart.
COVERAGE = 0.6
DRIFT = 6

# The base phrases with their labels.
PHRASES = (
    ("mit license", "mit"),
    ("apache license", "apache"),
    ("general public license", "gpl"),
)

# Short notices and the opening passages of well-known licenses.
TEXTS = (
    ("released under the mit license", "mit"),
    (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation "
        "files the software to deal in the software without restriction including without limitation the rights to use copy modify "
        "merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is "
        "furnished to do so",
        "mit",
    ),
    ("licensed under the apache license version 2 0", "apache"),
    (
        "you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org "
        "licenses license 2 0 unless required by applicable law or agreed to in writing software distributed under the license is "
        "distributed on an as is basis without warranties or conditions of any kind either express or implied",
        "apache",
    ),
    ("this work is licensed under the gnu general public license version 3", "gpl"),
    (
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as "
        "published by the free software foundation either version 3 of the license or at your option any later version",
        "gpl",
    ),
    (
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following "
        "conditions are met redistributions of source code must retain the above copyright notice this list of conditions and the "
        "following disclaimer",
        "bsd",
    ),
    (
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided "
        "that the above copyright notice and this permission notice appear in all copies",
        "isc",
    ),
    ("this source code form is subject to the terms of the mozilla public license v 2 0", "mpl"),
    ("licensed under cc by 4 0", "cc-by"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("licensed under cc by sa 4 0", "cc-by-sa"),
    ("this work is licensed under a creative commons attribution 4 0 international license", "cc-by"),
)


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[bytes, ...]
    k: int
    base: bool

    def grams(self) -> list[bytes]:
        return [b" ".join(self.words[i : i + self.k]) for i in range(len(self.words) - self.k + 1)]


def templates() -> list[Template]:
    out = [Template(label, tuple(words_of(text.encode())), PHRASE_GRAM, True) for text, label in PHRASES]
    return out + [Template(label, tuple(words_of(text.encode())), TEXT_GRAM, False) for text, label in TEXTS]


def gram_hash(gram: bytes) -> int:
    return int(np.uint64(xxhash.xxh64_intdigest(gram)).view(np.int64))


def template_grams(spark: SparkSession, every: list[Template]) -> DataFrame:
    """template, k, hash, at: the place of every k-gram of every template."""
    rows = [(n, t.k, gram_hash(g), at) for n, t in enumerate(every) for at, g in enumerate(t.grams())]
    return spark.createDataFrame(rows, "template int, k int, hash long, at long")


def template_sizes(spark: SparkSession, every: list[Template]) -> DataFrame:
    rows = [(n, t.label, t.base, t.k, len(t.grams())) for n, t in enumerate(every)]
    return spark.createDataFrame(rows, "template int, label string, base boolean, k int, grams int")


def _grams(vocabulary: frozenset[bytes], ks: tuple[int, ...]):
    """n_words and the (k, hash, at) of rolling k-grams. A k-gram with a word that no template has can't
    join, so only grams of template words are hashed and sent."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, rows = [], []
            for text in batch.column(2).cast(pa.binary()).to_pylist():
                words = words_of(text)
                known = np.fromiter(map(vocabulary.__contains__, words), np.bool_, len(words))
                found = []
                for k in ks:
                    if len(words) >= k and known.any():
                        runs = np.convolve(known, np.ones(k, np.int32), "valid")
                        found += [{"k": k, "hash": gram_hash(b" ".join(words[i : i + k])), "at": i} for i in np.flatnonzero(runs == k).tolist()]
                counts.append(len(words))
                rows.append(found)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(counts, pa.int64()), pa.array(rows, pa.list_(pa.struct([("k", pa.int32()), ("hash", pa.int64()), ("at", pa.int64())])))],
                names=["rid", "doc_id", "n_words", "grams"],
            )

    return run


def spans(grams: DataFrame, every: list[Template]) -> DataFrame:
    """rid, label, base, first, last, coverage: the verified spans.

    ``grams``: rid and grams. The votes of a diagonal are added up before diagonals are compared, so the
    rows that windows see are diagonals, not hits.
    """
    spark = grams.sparkSession
    hits = grams.select("rid", F.explode("grams").alias("g")).select("rid", "g.k", "g.hash", F.col("g.at").alias("i"))
    # the templates are a fixed list of a few hundred k-grams
    joined = hits.join(F.broadcast(template_grams(spark, every)), ["k", "hash"])
    diagonal = joined.groupBy("rid", "template", (F.col("i") - F.col("at")).alias("diagonal")).agg(
        F.countDistinct("at").alias("votes"), F.min("i").alias("first"), F.max("i").alias("last"), F.collect_set(F.struct("i", "at")).alias("hits")
    )
    diagonal = diagonal.join(F.broadcast(template_sizes(spark, every)), "template")
    exact = diagonal.where("base and votes = grams").select("rid", "label", "base", "first", (F.col("last") + F.col("k") - 1).alias("last"), F.lit(1.0).alias("coverage"))
    order = Window.partitionBy("rid", "template").orderBy("diagonal")
    far = F.col("diagonal") - F.lag("diagonal").over(order) > DRIFT
    run = ["rid", "template", "run"]
    same = Window.partitionBy(*run)
    runs = (
        diagonal.where("not base")
        .withColumn("run", F.sum(F.when(far, 1).otherwise(0)).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        .withColumn("wide", F.max("last").over(same) - F.min("first").over(same) >= 2 * (F.col("grams") + DRIFT))
    )
    near = runs.where("not wide").groupBy(*run, "label", "k", "grams").agg(F.flatten(F.collect_list("hits")).alias("hits"))
    # a run much longer than its template may hold many copies: each diagonal with those up to a template's length after it
    longest = max(len(t.words) for t in every)
    after = F.flatten(F.collect_list("hits").over(same.orderBy("diagonal").rangeBetween(0, longest - 1)))
    wide = runs.where("wide").withColumn("hits", after)
    wide = wide.withColumn("hits", F.expr("filter(hits, h -> h.i - h.at < diagonal + grams + k - 1)"))
    parts = [x.select(*run, "label", "k", "grams", "hits") for x in (near, wide)]
    places = F.size(F.array_distinct("hits.at"))
    likely = parts[0].unionByName(parts[1]).where(places / F.col("grams") >= COVERAGE)
    schema = "rid long, template int, run long, label string, first long, last long, coverage double"
    found = likely.mapInArrow(_in_order, schema).where(F.col("coverage") >= COVERAGE)
    found = found.groupBy(*run, "label").agg(F.max(F.struct("coverage", (-F.col("first")).alias("first"), "last")).alias("best"))
    return exact.unionByName(
        found.select("rid", "label", F.lit(False).alias("base"), (-F.col("best.first")).alias("first"), "best.last", "best.coverage")
    )


def in_order(hits: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The most hits (document word, template word) in which both words go up, so that no place counts twice."""
    hits = sorted(hits, key=lambda h: (h[0], -h[1]))
    ends: list[int] = []  # the lowest template word that ends a chain of each length
    last: list[int] = []  # the hit that has it
    earlier: list[int] = []
    for n, (_, at) in enumerate(hits):
        place = bisect_left(ends, at)
        earlier.append(last[place - 1] if place else -1)
        ends[place : place + 1], last[place : place + 1] = [at], [n]
    out, n = [], last[-1] if last else -1
    while n >= 0:
        out.append(hits[n])
        n = earlier[n]
    return out[::-1]


def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rid, template, run, label, k, grams, hits = batch.columns
        chains = [in_order([(h["i"], h["at"]) for h in own]) for own in hits.to_pylist()]
        first = pa.array([c[0][0] for c in chains], pa.int64())
        last = pa.array([c[-1][0] + n - 1 for c, n in zip(chains, k.to_pylist(), strict=True)], pa.int64())
        coverage = pa.array([len(c) / n for c, n in zip(chains, grams.to_pylist(), strict=True)], pa.float64())
        yield pa.RecordBatch.from_arrays(
            [rid, template, run, label, first, last, coverage], names=["rid", "template", "run", "label", "first", "last", "coverage"]
        )


def scan(docs: DataFrame, every: list[Template] | None = None) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score for every row of ``docs``.

    ``n_base``, ``first_word`` and ``last_word`` count the places of base phrases and their starts; the
    label lists are sorted and distinct; ``score`` is the highest coverage of a span, 0 without one. A null
    or empty text has no words and no places. Repeated rows and rows with a null id are rows of their own.
    Other columns are ignored; an empty table gives an empty result.
    """
    every = every or templates()
    rows = numbered(docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text("text").alias("text"))).select("rid", "doc_id", "text")
    vocabulary = frozenset(w for t in every for w in t.words)
    schema = "rid long, doc_id long, n_words long, grams array<struct<k:int,hash:long,at:long>>"
    grams = cut(rows.mapInArrow(_grams(vocabulary, tuple(sorted({t.k for t in every}))), schema))
    found = spans(grams.where(F.size("grams") > 0).select("rid", "grams"), every)
    base = F.col("base")
    names = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    per_row = found.groupBy("rid").agg(
        F.count(F.when(base, 1)).alias("n_base"),
        F.min(F.when(base, F.col("first"))).alias("first_word"),
        F.max(F.when(base, F.col("first"))).alias("last_word"),
        names(F.when(base, F.col("label"))).alias("base_labels"),
        names(F.col("label")).alias("labels"),
        F.max("coverage").alias("score"),
    )
    out = grams.select("rid", "doc_id", "n_words").join(per_row, "rid", "left")
    return out.select(
        "doc_id",
        "n_words",
        F.coalesce("n_base", F.lit(0).cast("long")).alias("n_base"),
        "first_word",
        "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )


def _values() -> str:
    return ", ".join(
        f"({n}, '{t.label}', {str(t.base).lower()}, {t.k}, {len(t.grams())}, string_split('{b' '.join(t.words).decode()}', ' '))"
        for n, t in enumerate(templates())
    )


SQL = rf"""
WITH w AS (
  SELECT row_number() OVER () AS rid, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
),
t AS (SELECT * FROM (VALUES {_values()}) AS t(template, label, base, k, grams, words)),
tg AS (SELECT template, k, i - 1 AS pos, array_to_string(words[i:i + k - 1], ' ') AS g FROM (SELECT *, unnest(range(1, grams + 1)) AS i FROM t)),
dg AS (
  SELECT rid, k, i - 1 AS i, array_to_string(w[i:i + k - 1], ' ') AS g
  FROM (SELECT rid, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (SELECT DISTINCT k FROM t) WHERE len(w) >= k)
),
diagonal AS (
  SELECT rid, template, i - pos AS diagonal, count(DISTINCT pos) AS votes, min(i) AS first, max(i) AS last
  FROM dg JOIN tg USING (k, g) GROUP BY rid, template, i - pos
),
typed AS (SELECT * FROM diagonal JOIN (SELECT template, label, base, k, grams FROM t) USING (template)),
stepped AS (
  SELECT *, coalesce(diagonal - lag(diagonal) OVER (PARTITION BY rid, template ORDER BY diagonal) > {DRIFT}, false)::INT AS far FROM typed WHERE NOT base
),
runs AS (SELECT *, sum(far) OVER (PARTITION BY rid, template ORDER BY diagonal) AS run FROM stepped),
merged AS (
  SELECT rid, label, grams, sum(votes) AS votes, min(first) AS first, max(last) AS last FROM runs GROUP BY rid, template, run, label, grams
),
spans AS (
  SELECT rid, label, true AS base, first, 1.0::DOUBLE AS coverage FROM typed WHERE base AND votes = grams
  UNION ALL
  SELECT rid, label, false, first, least(1.0::DOUBLE, votes / grams) FROM merged
  WHERE least(1.0::DOUBLE, votes / grams) >= {COVERAGE} AND last - first < 2 * (grams + {DRIFT})
),
per AS (
  SELECT rid, count(*) FILTER (base) AS n_base, min(first) FILTER (base) AS first_word, max(first) FILTER (base) AS last_word,
    array_to_string(list_sort(list(DISTINCT label) FILTER (base)), ',') AS base_labels, array_to_string(list_sort(list(DISTINCT label)), ',') AS labels,
    max(coverage) AS score
  FROM spans GROUP BY rid
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0) AS score
FROM w LEFT JOIN per USING (rid)
"""


def op1_diagonal_licenses(spark, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
