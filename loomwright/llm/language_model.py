"""Scores of whole texts under a log-bilinear neural model trained by noise-contrastive estimation.

The VECTORS * sqrt(tokens) most frequent training words of LEAST or more counts have context vectors and an output
vector of their own, so the model grows with the corpus. Each training task reads SPLIT tokens or more for each of
these words: tasks times vectors, which is what the averaging shuffles, stays in proportion to the corpus. The model predicts the next word from the two before it in three steps, each a
softmax over a few choices: the class (a most frequent word, the end, or a bucket of words by their ending),
the bucket's group (or its rest), and the word in the group. Every task trains on all tokens of its split, in
numpy, and hands on the rows it touched; these are averaged by touches. Scoring normalises every step. All other
words are known by their bucket's rest alone and have their share of it by their counts.
"""

from __future__ import annotations

import io
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .support import documents, local_file, publish, whole_text, written
from .textscan import TO_LOWER, U64, Table, buffers, hashes_with_tails, row_blocks, splitmix, word_spans

#: Class 0 ends (and begins) a text, then the frequent words, then the buckets of other words.
WORD_CLASSES, BUCKETS = 127, 64
CLASSES = 1 + WORD_CLASSES + BUCKETS
#: Width of the vectors, words of context, tokens in a step, noise classes in a step, step width, seed.
WIDTH, CONTEXT, BATCH, NOISE, RATE, SEED = 24, 2, 1024, 64, 0.2, 7
#: Words whose counts every task holds; the counts of all others are joined. Smoothing of the base and of the buckets.
HELD, SMOOTH = 1 << 20, 0.1
#: Words with vectors of their own for each square root of the tokens, the least count of such a word, the tokens
#: of a training task for each such word; what the squared gradients of a row begin with.
VECTORS, LEAST, SPLIT, PAST = 4, 10, 64, 3.0
#: The least product of factors that still has all digits of a float32.
LOWEST = 1e-30


@dataclass
class Tokens:
    """The words of a block of rows: hashes, buckets, and for each row the number of words before it."""

    first: int
    last: int
    hashes: np.ndarray
    bucket: np.ndarray
    before: np.ndarray


def tokens(column: pa.Array, limit: int = 1 << 21) -> Iterator[Tokens]:
    """Blocks of rows of a text column as words between ASCII white space, A-Z lower-cased."""
    data, offsets = buffers(column)
    for a, b in row_blocks(offsets, limit):
        low = TO_LOWER[data[offsets[a] : offsets[b]]]
        starts, ends, before = word_spans(low, offsets[a : b + 1] - offsets[a])
        hashes, endings = hashes_with_tails(low, starts, ends, 3)
        yield Tokens(a, b, hashes, (endings % U64(BUCKETS)).astype(np.int32), before)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0

    def rows() -> pa.RecordBatch:
        h = np.concatenate([x for x, _ in held])
        order = np.argsort(h)
        h = h[order]
        first = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
        bucket = np.concatenate([x for _, x in held])[order[first]]
        return pa.record_batch([pa.array(h[first].view(np.int64)), pa.array(bucket), pa.array(np.diff(np.append(first, len(h))))], ["h", "bucket", "c"])

    for b in batches:
        for t in tokens(b.column(0)):
            held.append((t.hashes, t.bucket))
            size += len(t.hashes)
            if size > 1 << 22:
                yield rows()
                held.clear()
                size = 0
    if size:
        yield rows()


class Layout:
    """Where the vectors are. A word's number: 0 the end, then the frequent words, the buckets' rests, and all other
    words with vectors, by bucket and falling count. The matrix has a row of each number for each place of the
    context, and an output row for each class, group or rest, and word; the last column has the biases."""

    def __init__(self, frequent: np.ndarray, frequent_c: np.ndarray, words: np.ndarray, bucket: np.ndarray, c: np.ndarray, ends: int, rest: np.ndarray):
        self.parts = (frequent, frequent_c, words, bucket, c, np.array(ends), rest)
        self.frequent, self.keys = len(frequent), np.concatenate((frequent, words))
        size = np.bincount(bucket, minlength=BUCKETS)
        self.step = max(1, math.isqrt(int(size.max())))
        groups = -(-size // self.step)
        #: Output rows of a bucket's groups and, last, its rest; words of each group.
        self.nodes = CLASSES + np.concatenate(([0], np.cumsum(groups + 1)))
        inside = np.arange(len(words)) - np.repeat(np.cumsum(size) - size, size)
        node = self.nodes[bucket] + inside // self.step
        self.first_word = int(self.nodes[-1])
        self.numbers = CLASSES + len(words)
        self.cls = np.concatenate((np.arange(CLASSES), 1 + WORD_CLASSES + bucket)).astype(np.int32)
        self.node = np.concatenate((np.zeros(1 + WORD_CLASSES, np.int64), self.nodes[1:] - 1, node))
        self.group_first = np.searchsorted(node, np.arange(self.first_word), "left")
        self.group_last = np.searchsorted(node, np.arange(self.first_word), "right")
        class_c = np.concatenate(([ends], frequent_c, np.zeros(WORD_CLASSES - len(frequent)), np.bincount(bucket, c, BUCKETS) + rest)) + SMOOTH
        node_c = np.bincount(node - CLASSES, c, self.first_word - CLASSES)
        node_c[self.nodes[1:] - 1 - CLASSES] = rest
        #: Shares of the choices of each step among all tokens that reach it.
        self.priors = [x / x.sum() for x in (class_c, node_c + SMOOTH, c + SMOOTH) if len(x)]

    def packed(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, *self.parts)
        return out.getvalue()

    @classmethod
    def opened(cls, name: str) -> Layout:
        with np.load(local_file(name)) as got:
            x = [got[f"arr_{i}"] for i in range(7)]
        return cls(*x[:5], int(x[5]), x[6])

    def matrix(self) -> np.ndarray:
        return initial(np.concatenate(self.priors), self.numbers)

    def number(self, t: Tokens, table: Table) -> np.ndarray:
        found = table.find(t.hashes)
        own = np.where(found < self.frequent, found + 1, found - self.frequent + CLASSES)
        return np.where(found >= 0, own, 1 + WORD_CLASSES + t.bucket).astype(np.int32)


def sequences(t: Tokens, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(target, one before, two before) of all tokens of a block with an end after each row, and where each row's tokens begin."""
    n = len(t.before) - 1
    ends = t.before[1:] + np.arange(n)
    target = np.zeros(len(classes) + n, np.int32)
    inside = np.ones(len(target), bool)
    inside[ends] = False
    target[inside] = classes
    begins = t.before[:-1] + np.arange(n)
    one, two = np.zeros_like(target), np.zeros_like(target)
    one[1:], two[2:] = target[:-1], target[:-2]
    one[begins] = 0
    two[begins] = 0
    second = begins[begins + 1 < len(target)] + 1
    two[second] = 0
    return np.stack((target, one, two)), begins


def initial(prior: np.ndarray, numbers: int = CLASSES) -> np.ndarray:
    """Small fixed vectors, and biases at the log frequencies; context rows have none."""
    rows = CONTEXT * numbers + len(prior)
    p = np.zeros((rows, WIDTH + 1), np.float32)
    for i in range(0, rows, 1 << 16):
        n = min(rows - i, 1 << 16)
        p[i : i + n, :WIDTH] = ((splitmix(n * WIDTH, SEED + i) >> U64(40)).astype(np.float32) / (1 << 24) - 0.5).reshape(n, WIDTH) * 0.2
    p[CONTEXT * numbers :, WIDTH] = np.log(prior)
    return p


def unpacked(p: np.ndarray, numbers: int = CLASSES) -> tuple[tuple[np.ndarray, ...], np.ndarray, np.ndarray]:
    """(context vectors by place, output vectors, biases)."""
    return tuple(p[k * numbers : (k + 1) * numbers, :WIDTH] for k in range(CONTEXT)), p[CONTEXT * numbers :, :WIDTH], p[CONTEXT * numbers :, WIDTH]


class Trainer:
    """Steps of noise-contrastive estimation with noise shared in a step; only touched rows change, and a row's step
    width falls with its gradients so far."""

    def __init__(self, layout: Layout):
        self.layout, start = layout, layout.matrix()
        self.begin = CONTEXT * layout.numbers
        #: Vector, bias and a 0, so that two numbers at a time can be added as a complex one; squared gradients so far; touches.
        self.p = np.concatenate((start, np.zeros((len(start), 1), np.float32)), 1)
        self.squares, self.touches = np.full(len(start), PAST, np.float32), np.zeros(len(start), np.int64)
        self.cumulated = [np.cumsum(x) for x in layout.priors]
        self.log_noise = [(np.log(x) + math.log(NOISE)).astype(np.float32) for x in layout.priors]
        self.draw = np.random.Generator(np.random.PCG64(SEED))

    def contrast(self, k: int, offset: int, chosen: np.ndarray, hidden: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of step k of the prediction, from hidden vectors with a 1 behind them: the gradient of hidden, and output rows with their gradients."""
        log_noise = self.log_noise[k]
        noise = np.minimum(np.searchsorted(self.cumulated[k], self.draw.random(NOISE)), len(log_noise) - 1)
        rows = self.begin + offset + np.concatenate((chosen, noise))
        goal, other = self.p.take(rows[: len(chosen)], 0), self.p.take(rows[len(chosen) :], 0)
        goal[:, WIDTH] -= log_noise[chosen]
        against = -other
        against[:, WIDTH] += log_noise[noise]
        with np.errstate(over="ignore"):  # beyond the range of exp the shares are 0
            up = 1 / (1 + np.exp(np.einsum("ij,ij->i", hidden, goal)))
            down = hidden @ against.T
            np.exp(down, out=down)
        down += 1
        np.divide(-1, down, out=down)
        grad = np.empty((len(rows), WIDTH + 2), np.float32)
        np.multiply(up[:, None], hidden, out=grad[: len(chosen)])
        pushed = grad[len(chosen) :]
        pushed[:] = 0
        for i in range(0, len(chosen), 256):
            pushed += down[i : i + 256].T @ hidden[i : i + 256]
        goal *= up[:, None]
        goal += down @ other
        return goal, rows, grad

    def step(self, target: np.ndarray, one: np.ndarray, two: np.ndarray) -> None:
        of = self.layout
        two = of.numbers + two
        hidden = self.p.take(one, 0)
        hidden += self.p.take(two, 0)
        hidden[:, WIDTH] = 1
        back, r, g = self.contrast(0, 0, of.cls[target], hidden)
        rows, grads = [r], [g]
        inside, known = np.flatnonzero(target > WORD_CLASSES), np.flatnonzero(target >= CLASSES)
        for k, offset, at, chosen in ((1, CLASSES, inside, of.node[target[inside]] - CLASSES), (2, of.first_word, known, target[known] - CLASSES)):
            if len(at):
                more, r, g = self.contrast(k, offset, chosen, hidden.take(at, 0))
                back[at] += more
                rows.append(r)
                grads.append(g)
        back[:, WIDTH] = 0  # context rows have no bias
        for part in (one, two):
            self.add(part, back)
        self.add(np.concatenate(rows), np.concatenate(grads))

    def add(self, rows: np.ndarray, grads: np.ndarray) -> None:
        # Row and place in one number, which sorts faster than places by rows; rows with one number keep their order.
        keys = rows.astype(np.int64) << 32
        keys |= np.arange(len(rows))
        keys.sort()
        order, r = keys & 0xFFFFFFFF, keys >> 32
        starts = np.flatnonzero(np.concatenate(([True], r[1:] != r[:-1])))
        g = np.add.reduceat(grads.view(np.complex64).take(order, 0), starts, axis=0).view(np.float32)
        u = r[starts]
        squares = self.squares[u] + np.einsum("ij,ij->i", g, g) / WIDTH
        self.squares[u] = squares
        self.touches[u] += np.diff(starts, append=len(r))
        g *= (RATE / np.sqrt(squares))[:, None]
        g += self.p.take(u, 0)
        self.p[u] = g


def _train(name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trainer, rest = None, np.zeros((3, 0), np.int32)
        for b in batches:
            if trainer is None:
                layout = Layout.opened(name)
                table, trainer = Table.build(layout.keys), Trainer(layout)
            for t in tokens(b.column(0)):
                rows, _ = sequences(t, layout.number(t, table))
                rest = np.concatenate((rest, rows), 1)
                full = rest.shape[1] - rest.shape[1] % BATCH
                for i in range(0, full, BATCH):
                    trainer.step(*rest[:, i : i + BATCH])
                rest = rest[:, full:]
        if rest.shape[1]:
            trainer.step(*rest)
        if trainer is not None:
            at = np.flatnonzero(trainer.touches)
            for i in range(0, len(at), 1 << 14):
                u = at[i : i + (1 << 14)]
                half = trainer.p[u, : WIDTH + 1].astype(np.float16)
                yield pa.record_batch([pa.array(u), pa.array(trainer.touches[u]), _binary(half)], ["i", "w", "v"])

    return run


def _binary(rows: np.ndarray) -> pa.Array:
    """Each row's bytes."""
    size = rows.shape[1] * rows.itemsize
    return pa.BinaryArray.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(np.arange(0, (len(rows) + 1) * size, size, dtype=np.int32)), pa.py_buffer(np.ascontiguousarray(rows))])


def _rows(column: pa.Array) -> np.ndarray:
    """The rows that _binary took, of one array."""
    data, offsets = buffers(column)
    return np.frombuffer(data[offsets[0] : offsets[-1]].tobytes(), np.float16).reshape(-1, WIDTH + 1)


def _average(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows of a partition, which has all rows of its numbers: the averages by touches."""
    held = [(b.column(0).to_numpy(), b.column(1).to_numpy(), _rows(b.column(2))) for b in batches if len(b)]
    if held:
        i, which = np.unique(np.concatenate([x for x, _, _ in held]), return_inverse=True)
        total, weight, done = np.zeros((len(i), WIDTH + 1), np.float64), np.zeros(len(i)), 0
        for x, w, v in held:
            at = which[done : done + len(x)]
            np.add.at(weight, at, w)
            np.add.at(total, at, v.astype(np.float64) * w[:, None])
            done += len(x)
        mean = (total / weight[:, None]).astype(np.float16)
        for k in range(0, len(i), 1 << 14):
            yield pa.record_batch([pa.array(i[k : k + (1 << 14)]), _binary(mean[k : k + (1 << 14)])], ["i", "v"])


@dataclass
class Model:
    """What scoring needs: files of parameters and words, counts over the training text and of the buckets' rests."""

    p_file: str
    layout_file: str
    total: int
    distinct: int
    ends: int
    bucket_log: np.ndarray
    held_file: str


def _score(m: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        layout = Layout.opened(m.layout_file)
        table = Table.build(layout.keys)
        # Slots of a hash table, and the count at each.
        held_slots, held_counts = np.asarray(np.memmap(local_file(m.held_file), np.int64, "r")).reshape(2, -1)
        held = Table(held_slots.view(U64), held_counts)
        context, out, bias = unpacked(np.asarray(np.memmap(local_file(m.p_file), np.float32, "r")).reshape(-1, WIDTH + 1), layout.numbers)
        context, out, bias = tuple(map(np.ascontiguousarray, context)), np.ascontiguousarray(out), np.ascontiguousarray(bias)
        uid = TaskContext.get().partitionId() << 33
        log_end = math.log10(m.ends + SMOOTH)
        for b in batches:
            for t in tokens(b.column(2)):
                number = layout.number(t, table)
                rows, begins = sequences(t, number)
                logs = log_probabilities(np.stack((layout.cls[rows[0]], rows[1], rows[2])), context, out, bias)
                logs += log_inside(layout, rows, context, out, bias)
                # Counts of the words that every task holds; others are left to the join.
                found = held.find(t.hashes)
                known = found >= 0
                counts = np.log10(np.maximum(found, 1) + SMOOTH) * known
                other = (number > WORD_CLASSES) & (number < CLASSES)
                places = t.before
                count_sum = sums(counts, places)
                bucket_counts = sums(counts * other, places)
                bucket_base = sums(m.bucket_log[np.maximum(t.bucket, 0)] * other, places)
                new = ~known
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(new)))[places], pa.int32()), pa.array(t.hashes[new].view(np.int64)))
                n = np.diff(places)
                model = sums(logs, np.append(begins, len(logs)))
                yield pa.record_batch([
                    pa.array(uid + np.arange(len(n))), b.column(0)[t.first : t.last], b.column(1)[t.first : t.last], pa.array(n + 1),
                    pa.array(sums(known.astype(np.float64), places).astype(np.int64)), pa.array(count_sum + log_end), pa.array(model + bucket_counts - bucket_base), lists,
                ], ["uid", "id", "held_out", "n_tokens", "n_known", "held_log", "model_log", "others"])
                uid += len(n)

    return run


def sums(values: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Sums of values between places, each over its own run, so long batches lose no digits."""
    out = np.zeros(len(places) - 1)
    full = places[1:] > places[:-1]
    if full.any():
        out[full] = np.add.reduceat(values.astype(np.float64), places[:-1][full])
    return out


def log_softmax(hidden: np.ndarray, out: np.ndarray, bias: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Of each row of hidden the logarithm of its chosen output's share among all outputs."""
    s = hidden @ out.T
    s += bias
    if s.max(initial=0) > 60:  # exp of float32 ends at 88
        s -= s.max(1, keepdims=True)
    got = s[np.arange(len(s)), chosen]
    return got - np.log(np.exp(s, out=s) @ np.ones(len(bias), np.float32))


def log_probabilities(rows: np.ndarray, context: np.ndarray, out: np.ndarray, bias: np.ndarray, block: int = 1 << 8, held: int = 1 << 16) -> np.ndarray:
    """log10 of each token's class after its context, normalised over all classes.

    A class's share is the product of what the words one and two before and its bias give it, so the exponentials are
    taken once for each different word among held tokens. Shares too small for such a product are taken from the sums instead."""
    target, one, two = rows
    out, bias = np.ascontiguousarray(out[:CLASSES]), bias[:CLASSES]
    result, place, every = np.empty(len(target)), np.zeros(len(context[0]), np.int32), np.exp(bias - bias.max())

    def factors(numbers: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The factors of each different number, and where those of each number are."""
        place[numbers] = 1
        kinds = np.flatnonzero(place)
        place[kinds] = np.arange(len(kinds))
        which = place[numbers]
        place[kinds] = 0
        e = np.empty((len(kinds), CLASSES), np.float32)
        for i in range(0, len(kinds), 1 << 10):
            s = vectors.take(kinds[i : i + (1 << 10)], 0) @ out.T
            if s.max() > 30:  # products of two stay in the range of float32
                s -= s.max(1, keepdims=True)
            np.exp(s, out=e[i : i + (1 << 10)])
        return e, which

    for a in range(0, len(target), held):
        (e1, w1), (e2, w2) = factors(one[a : a + held], context[0]), factors(two[a : a + held], context[1])
        for i in range(0, len(w1), block):
            share = e1.take(w1[i : i + block], 0)
            share *= e2.take(w2[i : i + block], 0)
            t = target[a + i : a + i + len(share)]
            got = share[np.arange(len(share)), t] * every[t]
            low = np.flatnonzero(got < LOWEST)
            got[low] = 1
            with np.errstate(divide="ignore", over="ignore"):  # all factors of a low one may be 0
                logs = np.log(got / (share @ every))
            if len(low):
                at = a + i + low
                logs[low] = log_softmax(context[0][one[at]] + context[1][two[at]], out, bias, target[at])
            result[a + i : a + i + len(share)] = logs
    return result / math.log(10)


def log_inside(layout: Layout, rows: np.ndarray, context: tuple[np.ndarray, ...], out: np.ndarray, bias: np.ndarray, block: int = 1 << 10) -> np.ndarray:
    """log10 of each token's group or rest in its bucket, and of its word in the group, normalised over their neighbours."""
    target, one, two = rows
    result = np.zeros(len(target))

    def chosen(at: np.ndarray, parent: np.ndarray, choice: np.ndarray, first: np.ndarray, last: np.ndarray) -> None:
        """Adds to the tokens at: the choice of each among the output rows from first to last of its parent."""
        order = np.argsort(parent)
        at, parent, choice = at[order], parent[order], choice[order]
        begins = np.flatnonzero(np.diff(parent, prepend=-1, append=-1))
        logs = np.empty(len(at))
        for k in range(0, len(at), 1 << 16):  # bounds the hidden vectors held at once
            hidden = context[0].take(one[at[k : k + (1 << 16)]], 0)
            hidden += context[1].take(two[at[k : k + (1 << 16)]], 0)
            to = k + len(hidden)
            cuts = [k, *begins[np.searchsorted(begins, k, "right") : np.searchsorted(begins, to, "left")].tolist(), to]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                f, e = first[parent[a]], last[parent[a]]
                for i in range(a, b, block):
                    j = min(i + block, b)
                    logs[i:j] = log_softmax(hidden[i - k : j - k], out[f:e], bias[f:e], choice[i:j] - f)
        result[at] += logs

    at = np.flatnonzero(target > WORD_CLASSES)
    chosen(at, layout.cls[target[at]] - WORD_CLASSES - 1, layout.node[target[at]], layout.nodes[:-1], layout.nodes[1:])
    at = np.flatnonzero(target >= CLASSES)
    chosen(at, layout.node[target[at]], target[at] - CLASSES + layout.first_word, layout.group_first + layout.first_word, layout.group_last + layout.first_word)
    return result / math.log(10)


def held_out_fold(id_col: str, folds: int = 10):
    """Rows whose crc32 of the id as text leaves no remainder; a null id is the empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % folds == 0


def scored(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 10) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) for each row of docs.

    A null text is the empty text: one token, the end. Repeated rows are scored each, and counted each in training.
    A word is known by 64 bits of its hash. Without training rows, counts are 0 and the model is uniform. Only id and
    text are read, so other columns may have any name. An empty table gives no rows.
    """
    rows = docs.select(F.col(id_col).alias("id"), held_out_fold(id_col, folds).alias("held_out"), whole_text(text_col).alias("text"))
    train = rows.where(~F.col("held_out"))
    counts = written(train.select("text").mapInArrow(_count, "h long, bucket int, c long").groupBy("h").agg(F.first("bucket").alias("bucket"), F.sum("c").alias("c")), "counts")
    ends = train.count()
    n, v = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    total, distinct = n + ends, v + (ends > 0)
    top = counts.orderBy(F.desc("c"), "h").limit(WORD_CLASSES).collect()
    frequent = np.array([r["h"] for r in top], np.int64).view(U64)
    size = int(VECTORS * math.sqrt(total))
    own = counts.where(F.col("c") >= max(LEAST, _count_above(counts, size))).toArrow()
    h, at, c = own.column("h").to_numpy().view(U64), own.column("bucket").to_numpy(), own.column("c").to_numpy()
    inside = ~np.isin(h, frequent)
    h, at, c = h[inside], at[inside], c[inside]
    order = np.lexsort((h, -c, at))
    h, at, c = h[order], at[order], c[order]
    # Counts of the buckets' rests: without the frequent words and those with vectors of their own.
    weight, kinds = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for r in counts.groupBy("bucket").agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("v")).collect():
        weight[r["bucket"]], kinds[r["bucket"]] = r["c"], r["v"]
    for r in top:
        weight[r["bucket"]] -= r["c"]
        kinds[r["bucket"]] -= 1
    weight -= np.bincount(at, c, BUCKETS)
    kinds -= np.bincount(at, minlength=BUCKETS)
    spark = docs.sparkSession
    layout = Layout(frequent, np.array([r["c"] for r in top], np.int64), h, at, c, ends, weight)
    words_file = publish(spark, layout.packed(), "words")
    tasks = max(1, total // (SPLIT * max(size, 1)))
    learned = train.select("text").coalesce(tasks).mapInArrow(_train(words_file), "i long, w long, v binary")
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    averaged = written(learned.repartition(parts, "i").mapInArrow(_average, "i long, v binary"), "averages")
    p = layout.matrix()
    for b in averaged.toArrow().to_batches():
        if len(b):
            p[b.column(0).to_numpy()] = _rows(b.column(1))
    m = Model(publish(spark, memoryview(p).cast("B"), "model"), words_file, total, distinct, ends, np.log10(weight + SMOOTH * (kinds + 1)), publish(spark, _held(counts), "counts"))
    del p
    kind = rows.schema["id"].dataType.simpleString()
    first = written(rows.mapInArrow(_score(m), f"uid long, id {kind}, held_out boolean, n_tokens long, n_known long, held_log double, model_log double, others array<long>"), "scores")
    joined = first.select("uid", F.explode("others").alias("h")).join(counts.select("h", "c"), "h", "left")
    others = joined.groupBy("uid").agg(F.sum(F.log10(F.coalesce("c", F.lit(0)) + F.lit(SMOOTH))).alias("log"), F.count("c").alias("known"))
    end_known = int(ends > 0)
    more = F.coalesce("log", F.lit(0.0))
    return first.drop("others").join(others, "uid", "left").select(
        F.col("id").alias(id_col), "held_out", "n_tokens", (F.col("n_known") + F.coalesce("known", F.lit(0)) + end_known).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("held_log") + more - F.col("n_tokens") * F.lit(math.log10(total + SMOOTH * (distinct + 1)))).alias("base_score"), (F.col("model_log") + more).alias("score"),
    )


def _count_above(counts: DataFrame, most: int) -> int:
    """The least count from which there are at most so many words."""
    least, size = 1 << 62, 0
    for r in counts.groupBy("c").count().orderBy(F.desc("c")).toLocalIterator():
        if size + r["count"] > most:
            break
        least, size = r["c"], size + r["count"]
    return least


def _held(counts: DataFrame) -> bytes:
    """The counts of the most frequent words, at most HELD (all words above the count that fits), as a hash table: its slots, then the count at each."""
    got = counts.where(F.col("c") >= F.lit(_count_above(counts, HELD))).select("h", "c").toArrow()
    table = Table.build(got.column("h").to_numpy().view(U64), 2)
    return table.slots.tobytes() + np.append(got.column("c").to_numpy(), 0)[table.rows].astype(np.int64).tobytes()


def op2_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(documents(spark, sf_dir))
