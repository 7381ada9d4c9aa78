"""License scans: phrases in place, and an exact set-similarity join of text blocks with templates.

Native. Blocks are windows of 64 words at steps of 32, so any 32 words in a row lie in one. Block and
template tokens are ordered by their frequency over the whole corpus, rarest first. A block meets a
template when it holds at least `share` of the template's distinct words; such a block must share a
token with the template's prefix (prefix filter), be long enough (length filter) and have enough tokens
after the first common one (positional filter). The template side is fixed and small, so the join runs
inside each row without a shuffle; only the frequencies of template words are gathered.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .support import documents, whole_text

#: Phrases that must stand word by word, and their labels (fixed values of the contract).
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

#: License statements as templates. At most 32 words each.
TEMPLATES = (
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("apache", "licensed under the apache license version 2 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under the creative commons attribution sharealike license"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related rights"),
    ("public-domain", "this is free and unencumbered software released into the public domain"),
)
SHARE, BLOCK, STEP = 0.9, 64, 32
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: str | Column = "text") -> Column:
    """ASCII-lower-cased words; the separators are all ASCII characters but letters and digits."""
    return F.filter(F.split(F.translate(whole_text(text), UPPER, LOWER), NOT_WORD), lambda w: w != "")


def needed(template: str, share: float = SHARE) -> int:
    return math.ceil(share * len(set(template.split())) - 1e-9)


def frequencies(docs: DataFrame, text_col: str, templates) -> dict[str, int]:
    """In how many rows of the whole table each template word occurs. At most as many entries as the templates have words."""
    vocabulary = sorted({w for _, t in templates for w in t.split()})
    mine = F.array_distinct(F.filter(words_of(text_col), lambda w: w.isin(vocabulary)))
    counted = docs.select(F.explode(mine).alias("w")).groupBy("w").count().collect()
    return dict.fromkeys(vocabulary, 0) | {r["w"]: r["count"] for r in counted}


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates=TEMPLATES, phrases=PHRASES, share: float = SHARE) -> DataFrame:
    """One row per row of docs: id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    score is the largest share of a template's words found in one block, from `share` up, 1 where a
    phrase stands, else 0. Null and empty texts have no words, empty labels and score 0. Repeated rows
    get the same result each. Only id and text are read; an empty table gives no rows.
    """
    found = frequencies(docs, text_col, templates)
    order = sorted(found, key=lambda w: (found[w], w))
    rank = {w: i for i, w in enumerate(order)}
    sides, prefixes = [], set()
    for label, text in templates:
        ranks = sorted(rank[w] for w in set(text.split()))
        need = needed(text, share)
        prefix = ranks[: len(ranks) - need + 1]
        prefixes |= {order[r] for r in prefix}
        sides.append(F.struct(F.lit(label).alias("label"), F.array(*map(F.lit, ranks)).alias("ranks"), F.array(*map(F.lit, prefix)).alias("prefix"), F.lit(need).alias("need")))
    ranks_of = F.create_map(*(F.lit(x) for w in order for x in (w, rank[w])))

    def base(words: Column, phrase: str) -> Column:
        parts = phrase.split()
        starts = F.sequence(F.lit(0), F.size(words) - len(parts))

        def stands(i: Column) -> Column:
            out = F.get(words, i) == parts[0]
            for k, part in enumerate(parts[1:], 1):
                out = out & (F.get(words, i + k) == part)
            return out

        none = F.array().cast("array<int>")
        return F.when((F.size(words) >= len(parts)) & F.array_contains(words, parts[-1]), F.filter(starts, stands)).otherwise(none)

    def met(block: Column) -> Column:
        tokens = F.array_sort(F.array_distinct(F.transform(F.filter(block, lambda w: w.isin(order)), lambda w: F.element_at(ranks_of, w))))

        def meets(t: Column) -> Column:
            common = F.array_intersect(tokens, t["prefix"])
            left = F.least(F.size(t["ranks"]) - F.array_position(t["ranks"], common[0]), F.size(tokens) - F.array_position(tokens, common[0])) + 1
            return (F.size(tokens) >= t["need"]) & (F.size(common) > 0) & (left >= t["need"]) & (F.size(F.array_intersect(tokens, t["ranks"])) >= t["need"])

        return F.transform(F.filter(F.array(*sides), meets), lambda t: F.struct(t["label"].alias("label"), (F.size(F.array_intersect(tokens, t["ranks"])) / F.size(t["ranks"])).alias("share")))

    starts = F.sequence(F.lit(0), F.greatest(F.size("words") - STEP - 1, F.lit(0)), F.lit(STEP))
    blocks = F.transform(starts, lambda s: F.slice("words", s + 1, BLOCK))
    likely = F.filter(blocks, lambda b: F.exists(b, lambda w: w.isin(sorted(prefixes))))
    none = F.array().cast("array<struct<label:string,share:double>>")
    rows = docs.select(F.col(id_col).alias("id"), words_of(text_col).alias("words"))
    rows = rows.withColumn("hits", F.when(F.exists("words", lambda w: w.isin(sorted(prefixes))), F.flatten(F.transform(likely, met))).otherwise(none))
    places = rows.select("id", F.size("words").cast("long").alias("n_words"), "hits", *(base(F.col("words"), p).alias(f"at{i}") for i, (p, _) in enumerate(phrases)))
    every = F.concat(*(f"at{i}" for i in range(len(phrases))))
    base_labels = F.filter(F.array(*(F.when(F.size(f"at{i}") > 0, F.lit(label)) for i, (_, label) in enumerate(phrases))), lambda x: x.isNotNull())
    return places.withColumn("every", every).withColumn("base", base_labels).select(
        F.col("id").alias(id_col), "n_words", F.size("every").cast("long").alias("n_base"),
        F.array_min("every").cast("long").alias("first_word"), F.array_max("every").cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct("base")), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat("base", F.transform("hits", lambda h: h["label"])))), ",").alias("labels"),
        F.when(F.size("every") > 0, F.lit(1.0)).otherwise(F.coalesce(F.array_max(F.transform("hits", lambda h: h["share"])), F.lit(0.0))).alias("score"),
    )


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(documents(spark, sf_dir))


_TEMPLATE_ROWS = ", ".join(f"('{label}', {sorted(set(text.split()))}, {needed(text)})" for label, text in TEMPLATES)
_PHRASE_ROWS = ", ".join(f"('{label}', {text.split()})" for text, label in PHRASES)

ORACLE = rf"""
WITH t(label, toks, need) AS (VALUES {_TEMPLATE_ROWS}), ph(label, toks) AS (VALUES {_PHRASE_ROWS}),
d AS (
  SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents
), b AS (
  SELECT r, ph.label, unnest(list_filter(range(0, greatest(len(w) - len(toks) + 1, 0)), lambda i: w[i + 1 : i + len(toks)] = toks)) AS pos FROM d, ph
), bs AS (
  SELECT r, count(*) AS n_base, min(pos) AS first_word, max(pos) AS last_word, list(DISTINCT label) AS labels FROM b GROUP BY r
), k AS (
  SELECT r, list_distinct(w[s + 1 : s + {BLOCK}]) AS bw FROM (SELECT r, w, unnest(range(0, greatest(len(w) - {STEP}, 1), {STEP})) AS s FROM d)
), m AS (
  SELECT r, list(DISTINCT label) AS labels, max(n / len(toks)) AS share
  FROM (SELECT r, t.label, t.need, t.toks, len(list_intersect(bw, toks)) AS n FROM k, t) WHERE n >= need GROUP BY r
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
  coalesce(array_to_string(list_sort(bs.labels), ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(bs.labels, []), coalesce(m.labels, [])))), ','), '') AS labels,
  CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(m.share, 0.0)::DOUBLE END AS score
FROM d LEFT JOIN bs ON d.r = bs.r LEFT JOIN m ON d.r = m.r
"""
