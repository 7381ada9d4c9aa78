"""Toxicity by weak supervision.

Words and word beginnings that stand out in toxic rows of the training fold are dealt to lexicon voters;
pattern voters look at marks and capitals. A generative label model, a mixture of toxic and clean texts,
estimates from the votes alone how often each voter is right and how voters hang together, and gives each
text a posterior label. A linear classifier over the words is fitted to these labels and scores all texts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .support import documents, whole_text
from .textscan import IS_SPACE, TO_LOWER, U64, Table, buffers, mixed, row_blocks, span_hashes, word_spans, released

#: Labelled rows that lexicons and models are fitted on at most, taken in the order of a hash of their id.
SAMPLE = 20_000
#: Lexicon voters, entries of all lexicons, word features of the classifier, rows in which a feature must occur, score from which a text is toxic.
VOTERS, LEXICON, FEATURES, LEAST, LIMIT = 12, 240, 2000, 4, 0.7
#: A feature counts whose toxic share would come by chance less often than e to the minus this.
CERTAIN = 10.0
#: Share of toxic rows among the rows of a lexicon's word.
SURE = 0.95
#: Lengths in bytes of the word beginnings that count as features.
BEGINNINGS = (4, 6)
#: Bytes of letters as they are, all others as a space.
AS_GAP = np.full(256, 32, np.uint8)
AS_GAP[[*range(65, 91), *range(97, 123), *range(128, 256)]] = [*range(65, 91), *range(97, 123), *range(128, 256)]


def lowered(raw: np.ndarray) -> np.ndarray:
    """UTF-8 with the letters of ASCII and Latin-1 in lower case."""
    low = TO_LOWER[raw]
    if len(raw) > 1:
        accented = (raw[:-1] == 0xC3) & (raw[1:] >= 0x80) & (raw[1:] <= 0x9E) & (raw[1:] != 0x97)
        low[1:][accented] += 0x20
    return low


def often(beginnings: np.ndarray, rows: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features for beginnings that two, and that three, different words of a row share: their hashes and rows."""
    order = np.lexsort((words, beginnings, rows))
    p, r, w = beginnings[order], rows[order], words[order]
    start = np.ones(len(p), bool)
    start[1:] = (p[1:] != p[:-1]) | (r[1:] != r[:-1])
    differs = start.copy()
    differs[1:] |= w[1:] != w[:-1]
    group = np.cumsum(start) - 1
    kinds = np.bincount(group[differs], minlength=int(start.sum())) if len(p) else np.zeros(0, np.int64)
    p, r = p[start], r[start]
    return np.concatenate([mixed(p[kinds > k] + U64(k)) for k in (1, 2)]), np.concatenate([r[kinds > k] for k in (1, 2)])


def features(column: pa.Array, limit: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks of rows of a text column: (first, last, feature hashes, the row of each, patterns of the rows).

    Features are words of letters in lower case, their beginnings, and beginnings that several words share. Patterns are the shares of exclamation
    marks, of capitals among ASCII letters, and of repeated characters."""
    data, offsets = buffers(column)
    for a, b in row_blocks(offsets, limit):
        raw = data[offsets[a] : offsets[b]]
        place = offsets[a : b + 1] - offsets[a]
        gaps = AS_GAP[raw]
        low = lowered(raw)
        starts, ends, before = word_spans(gaps, place)
        row = np.repeat(np.arange(b - a), np.diff(before))
        words = span_hashes(low, starts, ends)
        found, rows = [words], [row]
        for k in BEGINNINGS:
            long = ends - starts > k
            found.append(span_hashes(low, starts[long], starts[long] + k) + U64(k))
            rows.append(row[long])
            more, at = often(found[-1], rows[-1], words[long])
            found.append(more)
            rows.append(at)
        size = np.maximum(np.diff(place), 1)

        def share(what: np.ndarray, size=size, place=place) -> np.ndarray:
            return np.diff(np.concatenate(([0], np.cumsum(what)))[place]) / size

        upper = (raw >= 65) & (raw <= 90)
        again = np.zeros(len(raw), bool)
        if len(raw) > 2:
            again[2:] = (raw[2:] == raw[1:-1]) & (raw[1:-1] == raw[:-2]) & ~IS_SPACE[raw[2:]]
        yield a, b, np.concatenate(found), np.concatenate(rows), np.stack([share(raw == 33), share(upper), share(again)], 1)


def _label_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(feature, toxic rows, rows) of a task; a row with feature 0 counts the rows."""
    for b in batches:
        toxic = b.column(0).to_numpy().astype(np.int64)
        for first, last, found, rows, _ in features(b.column(1)):
            pairs = np.unique(np.stack([found, rows.astype(U64)], 1), axis=0) if len(found) else np.zeros((0, 2), U64)
            names, which = np.unique(pairs[:, 0], return_inverse=True)
            y = toxic[first:last]
            hits = np.bincount(which, y[pairs[:, 1].astype(np.int64)], len(names)).astype(np.int64)
            n = np.bincount(which, minlength=len(names))
            yield pa.record_batch([pa.array(np.append(names, U64(0)).view(np.int64)), pa.array(np.append(hits, y.sum())), pa.array(np.append(n, len(y)).astype(np.int64))], ["f", "toxic", "n"])


def incidence(column: pa.Array, table: Table, width: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Blocks of rows as (first, last, row by feature incidence of the table's features, patterns)."""
    for first, last, found, rows, patterns in features(column):
        at = table.find(found)
        x = np.zeros((last - first, width), bool)
        x[rows[at >= 0], at[at >= 0]] = True
        yield first, last, x, patterns


def votes_of(x: np.ndarray, patterns: np.ndarray, model: Model) -> np.ndarray:
    """-1 clean, 0 none, 1 toxic. A lexicon voter says toxic where one of its words stands; one voter says clean where no
    lexicon has a word; the pattern voters say toxic or clean outside the middle of what the sample shows."""
    lexicon = np.stack([x[:, model.voter == j].any(1) for j in range(VOTERS)], 1)
    clean = -(~lexicon.any(1, keepdims=True)).astype(np.int8)
    pattern = (patterns > model.high).astype(np.int8) - (patterns <= model.low).astype(np.int8)
    return np.concatenate([lexicon.astype(np.int8), clean, pattern], 1)


@dataclass
class Model:
    """Features by hash, the lexicon voter of each (-1: none), pattern bounds, and the classifier."""

    names: np.ndarray
    voter: np.ndarray
    high: np.ndarray
    low: np.ndarray
    weights: np.ndarray | None = None
    bias: float = 0.0


def label_model(votes: np.ndarray, prior: float, steps: int = 50) -> np.ndarray:
    """Posterior of toxic for each row of votes, by expectation maximisation.

    Votes of a class are normal with the class's means, the voters' accuracies, and covariances that both classes
    share, the voters' correlations, drawn towards the diagonal. It starts from the sum of the lexicon votes.
    """
    v = votes.astype(np.float64)
    n, k = v.shape
    q = np.where((votes[:, :VOTERS] > 0).any(1), 0.9, prior / 4)
    for _ in range(steps):
        share = np.clip(q.mean(), 1e-4, 1 - 1e-4)
        means = np.stack([((1 - q) @ v) / max((1 - q).sum(), 1e-9), (q @ v) / max(q.sum(), 1e-9)])
        spread = np.zeros((k, k))
        for c, w in enumerate((1 - q, q)):
            d = v - means[c]
            spread += (d * w[:, None]).T @ d
        spread /= n
        spread = 0.7 * spread + np.diag(0.3 * np.diag(spread) + 0.02)
        inverse = np.linalg.inv(spread)
        slope = inverse @ (means[1] - means[0])
        z = v @ slope - (means[1] + means[0]) @ slope / 2 + math.log(share / (1 - share))
        new = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        done = np.abs(new - q).max() < 1e-4
        q = new
        if done:
            break
    return q


def linear_classifier(x: np.ndarray, q: np.ndarray, ridge: float = 3e-3, steps: int = 400) -> tuple[np.ndarray, float]:
    """Logistic regression of posterior labels on incidence, by accelerated gradient steps."""
    x = x.astype(np.float32)
    n, k = x.shape
    w, b = np.zeros(k, np.float32), 0.0
    look, look_b = w.copy(), b
    width = 4.0 / (1 + x.sum(1).mean())
    for t in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ look + look_b, -30, 30)))
        g = (p - q).astype(np.float32)
        w_new, b_new = look - width * (x.T @ g / n + ridge / n * 10 * look), look_b - width * float(g.mean())
        speed = t / (t + 3)
        look, look_b = w_new + speed * (w_new - w), b_new + speed * (b_new - b)
        w, b = w_new, b_new
    return w, float(b)


def fitted(docs: DataFrame, labels: DataFrame, folds: int = 3, held: int = 1, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """The model of labelled rows outside the held fold, at most `sample` of them."""
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("_id")).agg(F.max(label_col).cast("int").alias("toxic"))
    known = known.where(F.crc32(F.col("_id").cast("string")) % folds != held).orderBy(F.xxhash64("_id"), "_id").limit(sample)
    # At most `sample` pairs of an id and a bit.
    rows = docs.select(F.col(id_col).alias("id"), whole_text(text_col).alias("text")).join(F.broadcast(known), F.col("id") == F.col("_id")).select("toxic", "text")
    rows = rows.dropDuplicates(["text"])  # a copied text speaks once
    counted = rows.mapInArrow(released(_label_counts), "f long, toxic long, n long").groupBy("f").agg(F.sum("toxic").alias("toxic"), F.sum("n").alias("n"))
    total = counted.where("f = 0").first()
    if total is None or not 0 < total["toxic"] < total["n"]:
        share = 0.0 if total is None or not total["n"] else total["toxic"] / total["n"]
        return Model(np.zeros(0, U64), np.zeros(0, np.int64), np.zeros(3), np.zeros(3), np.zeros(0, np.float32), math.log((share + 0.01) / (1.01 - share)))
    prior = total["toxic"] / total["n"]
    rate = F.col("toxic") / F.col("n")
    # n times the divergence of a feature's toxic share from the prior: minus the log of the chance of so uneven a count.
    against = F.when(rate > 0, rate * F.log(rate / prior)).otherwise(0.0) + F.when(rate < 1, (1 - rate) * F.log((1 - rate) / (1 - prior))).otherwise(0.0)
    strength = counted.where((F.col("f") != 0) & (F.col("n") >= LEAST)).select("f", "toxic", "n", (F.col("n") * against).alias("strength"))
    top = strength.where(F.col("strength") > CERTAIN).orderBy(F.desc("strength"), "f").limit(FEATURES).collect()
    names = np.array([r["f"] for r in top], np.int64).view(U64)
    voter = np.full(len(names), -1, np.int64)
    strong = [i for i, r in enumerate(top) if r["toxic"] >= SURE * r["n"]][:LEXICON]
    voter[strong] = np.arange(len(strong)) % VOTERS
    model = Model(names, voter, np.zeros(3), np.zeros(3))

    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Table.build(model.names)
        for b in batches:
            for first, last, x, patterns in incidence(b.column(1), table, len(model.names)):
                packed = np.packbits(x, axis=1)
                yield pa.record_batch([pa.array([r.tobytes() for r in packed], pa.binary()), pa.array(list(patterns), pa.list_(pa.float64()))], ["x", "patterns"])

    sample_rows = rows.mapInArrow(released(gathered), "x binary, patterns array<double>").toArrow()
    x = np.unpackbits(np.frombuffer(b"".join(sample_rows.column("x").to_pylist()), np.uint8).reshape(len(sample_rows), -1), axis=1)[:, : len(names)].astype(bool)
    patterns = np.array(sample_rows.column("patterns").to_pylist())
    order = np.lexsort(np.concatenate([patterns.T, x[:, ::-1][:, -64:].T]))  # rows come in any order; sums do not depend on it beyond rounding
    x, patterns = x[order], patterns[order]
    model.high, model.low = np.quantile(patterns, 0.995, 0), np.quantile(patterns, 0.5, 0)
    posterior = label_model(votes_of(x, patterns, model), prior)
    model.weights, model.bias = linear_classifier(x, posterior)
    return model


def scorer(model: Model):
    """A function from a text column without nulls to scores."""
    table = Table.build(model.names)

    def score(column: pa.Array) -> np.ndarray:
        out = []
        for first, last, found, rows, _ in features(column):
            at = table.find(found)
            hit = at >= 0
            seen = np.unique(rows[hit] * max(len(model.names), 1) + at[hit])
            z = np.bincount(seen // max(len(model.names), 1), model.weights[seen % max(len(model.names), 1)], last - first) + model.bias
            out.append(1 / (1 + np.exp(-np.clip(z, -30, 30))))
        return np.concatenate(out) if out else np.zeros(0)

    return score


def scores(docs: DataFrame, model: Model, folds: int = 3, held: int = 1, id_col: str = "doc_id", text_col: str = "text", limit: float = LIMIT) -> DataFrame:
    """(id, held_out, score, predicted) for each row of docs.

    Null and empty texts get the score of a text without features. A null id belongs to the fold of the empty text.
    Repeated rows are scored each. Only id and text are read, so other columns may have any name; an empty table gives
    no rows. Without labels of both kinds every score is the share of toxic rows, smoothed.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = scorer(model)
        for b in batches:
            yield pa.record_batch([b.column(0), b.column(1), pa.array(score(b.column(2)))], ["id", "held_out", "score"])

    fold = F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % folds == held
    rows = docs.select(F.col(id_col).alias("id"), fold.alias("held_out"), whole_text(text_col).alias("text"))
    out = rows.mapInArrow(released(run), f"id {rows.schema['id'].dataType.simpleString()}, held_out boolean, score double")
    return out.select(F.col("id").alias(id_col), "held_out", "score", (F.col("score") >= limit).cast("int").alias("predicted"))


def clean_rows(docs: DataFrame, model: Model, text_col: str = "text", limit: float = LIMIT) -> DataFrame:
    """docs without the rows whose text scores `limit` or more; all columns as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = scorer(model)
        for b in batches:
            yield b.filter(pa.array(score(pc.fill_null(b.column(text_col), "")) < limit))

    return docs.mapInArrow(released(run), docs.schema)


def labels_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return scores(docs, fitted(docs, labels_table(spark, sf_dir)))
