"""TF-IDF, Jaccard, trigram and embedding similarity as relational plans.

Terms are exploded and aggregated; a pair is scored only where documents of one block share a term. The
norm of each document and the document frequency of each term are aggregates, never collected.
"""

from __future__ import annotations

import math
from collections import Counter
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from loomwright.durable import stored
from loomwright.functions.rules import let, text_of
from loomwright.operators import search_index, term_weights, tiles
from loomwright.operators.windows import top_per_key

TERM = "[a-z0-9]{2,}"
#: Letters and numbers of any script.
WORD = r"[\p{L}\p{N}_]{2,}"
# The tokens of lexical grounding, words that do not count, and hints of a negative or positive finding.
TOKEN = r"[a-z][a-z0-9_\-/]{2,}"
STOPWORDS = (
    "the", "and", "for", "with", "that", "this", "from", "into", "when", "then", "than",
    "have", "has", "had", "was", "were", "are", "is", "be", "been", "being", "will", "would",
    "can", "could", "should", "may", "might", "not", "you", "your", "they", "their", "them",
    "our", "nous", "vous", "avec", "sans", "dans", "pour", "sur", "par", "les", "des", "une",
    "est", "sont", "été", "être", "cela", "ceci", "comme", "plus", "moins", "very", "also",
    "image", "description", "text", "figure", "technical", "issue", "github", "url", "none",
)
NEGATIVE = (
    "not", "no", "never", "without", "cannot", "can't", "failed", "fail", "fails",
    "error", "errors", "missing", "none", "disabled", "disable", "wrong",
    "pas", "sans", "jamais", "erreur", "echec", "manquant",
)
POSITIVE = (
    "works", "working", "ok", "fixed", "resolved", "success", "enabled", "available",
    "correct", "valid", "supported", "stable", "fonctionne", "corrige", "actif",
)


def terms(text: Column, pattern: str = TERM) -> Column:
    return F.regexp_extract_all(F.lower(text_of(text)), F.lit(pattern), F.lit(0))


def weights(docs: DataFrame, block: str, id_col: str, text_col: str, pattern: str = TERM, most_terms: int | None = None) -> DataFrame:
    """(block, id, terms, w, singles): L2-normalised tf * (ln((1 + n) / (1 + df)) + 1), n and df within the block, a row a document; see term_weights.

    With most_terms only so many terms of a block count, the most frequent ones, ties by the term."""
    rows = docs.select(F.col(block).alias("block"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return term_weights.weighed(rows, terms(F.col("text"), pattern), most_terms)[0]


def related(docs: DataFrame, block: str, id_col: str, text_col: str, k: int = 3, least: float = 0.4, pattern: str = TERM, most_terms: int | None = None, only: DataFrame | None = None) -> DataFrame:
    """(id, related, sim, rank): for each document the k nearest of its block by cosine, from `least` up, ties by id.

    Ids are unique in a block; rows without a block or an id take no part. With `only`, a table of ids, for these documents alone: where their terms
    are few enough for every task to hold, no others are compared with each other. See tiles for the join."""
    vecs = tiles.vectors(weights(docs, block, id_col, text_col, pattern, most_terms))
    if only is None:
        near = tiles.nearest_above(vecs, k, least)
    else:
        only = stored(only.select(F.col(only.columns[0]).alias("id")).where("id is not null").distinct(), "only")
        own = stored(vecs.join(only, "id", "left_semi"), "own")
        few = (own.agg(F.sum(F.size("terms"))).first()[0] or 0) <= tiles.HELD
        near = tiles.nearest_to(vecs, own, k, least) if few else tiles.nearest_above(vecs, k, least).join(only, "id", "left_semi")
    near = near.select(F.col("id").alias("i"), F.col("other").alias("j"), F.round("dot", 6).alias("sim"))
    return top_per_key(near, ["i"], [F.desc("sim"), F.col("j")], k, "rank").select(F.col("i").alias(id_col), F.col("j").alias("related"), "sim", "rank")


def attached(docs: DataFrame, block: str, id_col: str, text_col: str, valid: Column, k: int = 3, least: float = 0.4, pattern: str = WORD, most_terms: int | None = 5000, out: str = "related_ids") -> DataFrame:
    """docs with the ids related to each as an array, nearest first. Only valid documents count and are related; others, and those without any, have an empty array.

    A null in `valid` counts as valid."""
    ok = F.coalesce(valid, F.lit(True))
    found = related(docs.where(ok), block, id_col, text_col, k, least, pattern, most_terms)
    lists = found.groupBy(F.col(id_col).alias("_id")).agg(F.array_sort(F.collect_list(F.struct("rank", "related"))).alias("_related"))
    none = F.array().cast(f"array<{docs.schema[id_col].dataType.simpleString()}>")
    both = docs.withColumn("_ok", ok).join(lists, F.col(id_col) == F.col("_id"), "left")
    return both.withColumn(out, F.when(F.col("_ok"), F.coalesce(F.col("_related.related"), none)).otherwise(none)).drop("_ok", "_id", "_related")


def titled(title: Column, body: Column) -> Column:
    """The text of an issue for search: its title above its body."""
    return F.concat(text_of(title), F.lit("\n"), text_of(body))


def headed(path: Column, kind: Column, body: Column) -> Column:
    """The text of a file for search: its path and type above its body."""
    return F.concat(text_of(path), F.lit("\n["), text_of(kind), F.lit("]\n"), text_of(body))


def search(queries: DataFrame, query_id: str, query_text: str, docs: DataFrame, id_col: str, text_col: str, k: int = 5, pattern: str = TERM, most_terms: int | None = None) -> DataFrame:
    """(query, id, sim, rank): the k best documents of each query; df and n come from the documents. Builds an index for this call; see search_index for one that several queries share."""
    index = search_index.build(docs, id_col, text_col, pattern, most_terms)
    return search_index.search(queries, query_id, query_text, index, id_col, pattern, k)


def tokens(text: Column) -> Column:
    """Words of three characters or more, without stop words and plain numbers."""
    return F.filter(terms(text, TOKEN), lambda t: ~t.isin(*STOPWORDS) & ~t.rlike("^[0-9]+$"))


def overlap_ratio(a: Column, b: Column) -> Column:
    """Share of a's distinct tokens that are in b; 0 without tokens. Takes token arrays."""
    return let(F.array_distinct(a), lambda own: F.when(F.size(own) == 0, F.lit(0.0)).otherwise(F.size(F.array_intersect(own, b)) / F.size(own)))


def jaccard(a: Column, b: Column) -> Column:
    """Jaccard of two token arrays; 0 where both are empty."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, F.lit(0.0)).otherwise(F.size(F.array_intersect(a, b)) / union)


def _plain(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text_of(text)), r"\s+", " "))


def trigrams(text: Column) -> Column:
    t = _plain(text)
    # One pass over the text: a character is taken at a time, with the two after it.
    return F.regexp_extract_all(t, F.lit("(?s)(?=(.{3}))."), F.lit(1))


def trigram_counts(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, gram, c, norm): the counts of a text's trigrams and their length as a vector."""
    counts = df.select(F.col(id_col).alias("id"), F.explode(trigrams(F.col(text_col))).alias("gram")).groupBy("id", "gram").agg(F.count(F.lit(1)).alias("c"))
    return counts.withColumn("norm", F.sqrt(F.sum(F.col("c") * F.col("c")).over(Window.partitionBy("id"))))


@F.pandas_udf(DoubleType())
def _trigram_cosine(a: pd.Series, b: pd.Series) -> pd.Series:
    def one(x: str, y: str) -> float | None:
        p, q = (Counter(t[i : i + 3] for i in range(len(t) - 2)) for t in (x, y))
        dot = sum(n * q[g] for g, n in p.items() if g in q)
        return dot / (math.sqrt(sum(n * n for n in p.values())) * math.sqrt(sum(n * n for n in q.values()))) if dot else 0.0

    return pd.Series([one(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")


def semantic_lite(pairs: DataFrame, keys: list[str], a: str, b: str, out: str = "semantic") -> DataFrame:
    """pairs with 0.7 of the tokens' Jaccard and 0.3 of the trigrams' cosine of two texts; 0 where neither has tokens.

    A pair alone under its keys is counted in its row. Where several pairs share their keys, their trigrams count together, by rows of keys and trigram."""
    own = Window.partitionBy(*keys)
    pairs = pairs.withColumn("_n", F.count(F.lit(1)).over(own))
    known = reduce(lambda x, y: x & y, (F.col(k).isNotNull() for k in keys))
    alone = pairs.where((F.col("_n") == 1) & known).withColumn("_cosine", _trigram_cosine(_plain(F.col(a)), _plain(F.col(b))))
    several = pairs.where((F.col("_n") > 1) | ~known)

    def counted(column: str, name: str) -> DataFrame:
        return several.select(*keys, F.explode(trigrams(F.col(column))).alias("_g")).groupBy(*keys, "_g").agg(F.count(F.lit(1)).alias(name))

    left, right = counted(a, "_x"), counted(b, "_y")
    both = left.join(right, [*keys, "_g"], "full_outer").groupBy(*keys).agg((F.sum(F.col("_x") * F.col("_y")) / (F.sqrt(F.sum(F.col("_x") * F.col("_x"))) * F.sqrt(F.sum(F.col("_y") * F.col("_y"))))).alias("_cosine"))
    every = alone.unionByName(several.join(both, keys, "left").select(*alone.columns))

    def value(t: Column) -> Column:
        return F.when((F.size(t["a"]) == 0) & (F.size(t["b"]) == 0), F.lit(0.0)).otherwise(F.least(F.lit(1.0), 0.7 * jaccard(t["a"], t["b"]) + 0.3 * F.coalesce(F.col("_cosine"), F.lit(0.0))))

    return every.withColumn(out, let(F.struct(tokens(F.col(a)).alias("a"), tokens(F.col(b)).alias("b")), value)).drop("_n", "_cosine")


def polarity(toks: Column) -> Column:
    """struct(sign, magnitude) of a token array."""
    diff = F.size(F.filter(toks, lambda t: t.isin(*POSITIVE))) - F.size(F.filter(toks, lambda t: t.isin(*NEGATIVE)))
    return let(diff, lambda d: F.struct(F.signum(d.cast("double")).cast("int").alias("sign"), F.when(F.size(toks) == 0, F.lit(0.0)).otherwise(F.least(F.lit(1.0), F.abs(d) / F.size(toks) * 5.0)).alias("magnitude")))


def contradiction(premise: Column, hypothesis: Column) -> Column:
    """How likely two token arrays disagree: opposite polarity over shared tokens."""
    def value(x: Column) -> Column:
        overlap, p, h = x["overlap"], x["p"], x["h"]
        opposite = (p["sign"] * h["sign"]) == -1
        return F.when(opposite & (overlap >= 0.2), 0.6 * overlap + 0.4 * ((p["magnitude"] + h["magnitude"]) / 2.0)).when(overlap < 0.1, 0.0).otherwise(0.15 * overlap)

    told = let(F.struct(overlap_ratio(hypothesis, premise).alias("overlap"), polarity(premise).alias("p"), polarity(hypothesis).alias("h")), value)
    return F.when(F.size(hypothesis) == 0, F.lit(0.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), told)))


def coherence(lexical: Column, semantic: Column, against: Column, alpha: float = 0.4, beta: float = 0.6, gamma: float = 0.8) -> Column:
    """Weighted support, drawn down by the share of contradiction; without a semantic score the lexical one stands alone."""
    base = F.when(semantic.isNull(), lexical).otherwise((alpha * lexical + beta * semantic) / (alpha + beta))
    penalty = F.greatest(F.lit(0.0), F.least(F.lit(1.0), gamma * F.coalesce(against, F.lit(0.0))))
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), base * (1.0 - penalty)))


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two numeric arrays, summed in double."""
    dot = F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)
    norm = [F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))) for v in (a, b)]
    return dot / (norm[0] * norm[1])
