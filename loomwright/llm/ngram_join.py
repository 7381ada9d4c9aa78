"""N-gram Jaccard join: which documents' word 5-gram sets have a Jaccard of 0.8 or more.

The product of the document by n-gram incidence matrix with its transpose, in blocks of n-grams and of
pairs. Equal sets are one row of the matrix. A pair can only reach the threshold if it shares one of the
first n - ceil(0.8 n) + 1 n-grams of each in one global order (here: rare ones first, then by hash), so
only those columns are dealt out. In each column the rows are first multiplied with one of them, a star;
rows that are connected by then need no product with each other. What is left in columns with several
components is paired under bounds from the set sizes and from the places of the n-gram in both sets, and
not again where an earlier common n-gram is known; pairs whose parity signatures differ too much are
discarded, and the overlaps of the others are accumulated, block by block. So no column is expanded into
all its pairs, and no link between different texts is lost.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .components import roots
from .support import documents, durable, local_file, publish, whole_text, written
from .textscan import U64, mixed, released, within, word_hashes

#: Words in an n-gram; the threshold as a fraction; an n-gram in so many different sets is frequent;
#: how many frequent ones are remembered, and in a bit map of which size (a power of two).
WORDS, NUM, DEN, FREQUENT, REMEMBERED, MAP_BITS = 5, 4, 5, 32, 1 << 20, 24
#: Rows of a column from which its n-gram is dealt out late; n-grams before its own that a row of an open column knows.
WIDE, BEFORE = 12, 3
#: Ids that are sent to every task at most, to pick texts; more are joined by a shuffle.
SENT = 100_000
FACTORS = mixed(np.arange(1, WORDS + 1, dtype=U64)) | U64(1)


def ngram_sets(column: pa.Array) -> Iterator[np.ndarray]:
    """For each row of a text column its set of n-gram hashes, sorted. Fewer words than an n-gram are one n-gram."""
    for first, last, words, before in word_hashes(column):
        grams = np.zeros(0, U64)
        with np.errstate(over="ignore"):
            if len(words) >= WORDS:
                grams = words[: len(words) - WORDS + 1] * FACTORS[0]
                for k in range(1, WORDS):
                    grams = grams + words[k : len(words) - WORDS + 1 + k] * FACTORS[k]
                grams = mixed(grams)
            for i in range(last - first):
                a, b = before[i], before[i + 1]
                if b - a >= WORDS:
                    yield np.unique(grams[a : b - WORDS + 1])
                elif b > a:
                    yield mixed((words[a:b] * FACTORS[: b - a]).sum(keepdims=True, dtype=U64) + U64(int(b - a)))
                else:
                    yield grams[:0]


def set_key(grams: np.ndarray) -> tuple[int, int]:
    """128 bits of a set, as two signed numbers."""
    raw = hashlib.blake2b(grams.tobytes(), digest_size=16).digest()
    return int.from_bytes(raw[:8], "little", signed=True), int.from_bytes(raw[8:], "little", signed=True)


def _survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each document with its set's size and key (and, once in a batch, its signature), and rows for n-grams that several different sets of a block hold."""
    for b in batches:
        n, k1, k2, held, seen, signed, size = [], [], [], [], set(), [], 0
        for grams in ngram_sets(b.column(1)):
            key = set_key(grams)
            n.append(len(grams))
            k1.append(key[0])
            k2.append(key[1])
            signed.append(None if key in seen else np.array(signature(grams), np.int64).tobytes())
            if key not in seen:
                seen.add(key)
                held.append(grams)
                size += len(grams)
                if size > 1 << 21:
                    yield _repeated(held, b.column(0).type)
                    held, size = [], 0
        rows = len(n)
        yield pa.record_batch([b.column(0), pa.array(n, pa.int64()), pa.array(k1, pa.int64()), pa.array(k2, pa.int64()), pa.array(signed, pa.binary()), pa.nulls(rows, pa.int64())], SURVEY)
        yield _repeated(held, b.column(0).type)


def _repeated(held: list[np.ndarray], id_type: pa.DataType) -> pa.RecordBatch:
    """Survey rows of the n-grams that several of the sets hold."""
    grams, count = np.unique(np.concatenate(held) if held else np.zeros(0, U64), return_counts=True)
    often = count > 1
    grams, count = grams[often].view(np.int64), count[often]
    none = pa.nulls(len(grams), pa.int64())
    return pa.record_batch([pa.nulls(len(grams), id_type), pa.array(count, pa.int64()), none, none, pa.nulls(len(grams), pa.binary()), pa.array(grams, pa.int64())], SURVEY)


SURVEY = ["id", "n", "k1", "k2", "sig", "gram"]


def _node(key: tuple[int, int], shared: frozenset[int]) -> int:
    return key[1] if key[0] in shared else key[0]


def prefix_of(grams: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """The n-grams of which a set must share one with any set that reaches the threshold with it."""
    bits = (grams >> U64(64 - MAP_BITS)).astype(np.int64)
    late = (frequent[bits >> 3] >> (bits & 7).astype(np.uint8)) & 1
    order = np.argsort(late, kind="stable")
    return grams[order[: len(grams) - -(-NUM * len(grams) // DEN) + 1]]


def signature(grams: np.ndarray) -> tuple[int, ...]:
    """Parities of the set's members, about four bits for each: sets differ in at least as many members as their signatures in bits."""
    bits = 1 << min(max((4 * len(grams) - 1).bit_length(), 9), 16)
    odd = np.bincount((grams & U64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return tuple(np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64).tolist())


def differing(a: np.ndarray, b: np.ndarray) -> int:
    """In how many bits two signatures (as arrays) differ; the longer one is folded to the length of the other, which keeps its parities."""
    while len(a) > len(b):
        a = a[: len(a) // 2] ^ a[len(a) // 2 :]
    while len(b) > len(a):
        b = b[: len(b) // 2] ^ b[len(b) // 2 :]
    return int(np.bitwise_count((a ^ b).view(U64)).sum())  # of signed numbers it would count the bits of the absolute value


def _close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of pairs with sizes and signatures, those whose signatures let them reach the threshold."""
    for b in batches:
        n, m = b.column(2).to_numpy(), b.column(3).to_numpy()
        most = (n + m) * (DEN - NUM) // (DEN + NUM)
        left, right = b.column(4), b.column(5)
        good = np.fromiter((differing(np.frombuffer(left[k].as_buffer(), np.int64), np.frombuffer(right[k].as_buffer(), np.int64)) <= most[k] for k in range(len(n))), bool, len(n))
        yield pa.record_batch([b.column(0).filter(pa.array(good)), b.column(1).filter(pa.array(good))], ["a", "b"])


def _columns(frequent_file: str, shared: frozenset[int], grams_only: bool = False):
    """Rows of the columns that each set is dealt to, equal sets of a batch once; on demand the n-grams alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = np.asarray(np.memmap(local_file(frequent_file), np.uint8, "r"))
        for b in batches:
            grams, sides, seen, held = [], [], set(), 0
            for s in ngram_sets(b.column(0)):
                if not len(s) or (key := set_key(s)) in seen:
                    continue
                seen.add(key)
                p = prefix_of(s, frequent)
                grams.append(p)
                sides.append((_node(key, shared), len(s)))
                held += len(p)
                if held > 1 << 19:
                    yield _gram_rows(grams) if grams_only else _column_rows(grams, sides)
                    grams, sides, held = [], [], 0
            if held:
                yield _gram_rows(grams) if grams_only else _column_rows(grams, sides)

    return run


def _gram_rows(grams) -> pa.RecordBatch:
    return pa.record_batch([pa.array(np.concatenate(grams).view(np.int64))], ["gram"])


def _column_rows(grams, sides) -> pa.RecordBatch:
    """Rows of n-gram, node, set size and the n-gram's place in the set."""
    lens = np.array([len(g) for g in grams])
    side = np.repeat(np.array(sides, np.int64), lens, axis=0)
    return pa.record_batch([pa.array(np.concatenate(grams).view(np.int64)), *(pa.array(np.ascontiguousarray(side[:, i])) for i in range(2)), pa.array(within(lens))], NAMES)


NAMES = ["gram", "node", "n", "place"]
COLUMN = ", ".join(f"{name} long" for name in NAMES)


def _prefix(n: Column) -> Column:
    """How many n-grams of a set of size n are dealt out, as prefix_of takes them."""
    return n - F.ceil(n * NUM / F.lit(DEN)) + 1


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by column and node, those of columns with several nodes, each once.

    A column may run over many batches; only its first row is kept until a second node comes."""
    first, last, told = None, None, False  # the open column's first row, the last (gram, node), whether the first row is out
    for b in batches:
        rows = np.stack([c.to_numpy() for c in b.columns])
        gram, node = rows[0], rows[1]
        if not len(gram):
            continue
        same, again = np.empty(len(gram), bool), np.empty(len(gram), bool)
        same[1:] = gram[1:] == gram[:-1]
        again[1:] = same[1:] & (node[1:] == node[:-1])
        same[0] = last is not None and gram[0] == last[0]
        again[0] = same[0] and node[0] == last[1]
        begin = np.flatnonzero(~same)
        which = np.cumsum(~same)  # 0: the column that was open
        several = np.bincount(which[same & ~again], minlength=len(begin) + 1) > 0
        out = same & ~again
        out[begin] = several[1:]
        parts = [rows[:, out]]
        if several[0] and not told:
            parts.insert(0, first[:, None])
            told = True
        table = np.concatenate(parts, 1)
        if table.shape[1]:
            yield pa.record_batch([pa.array(np.ascontiguousarray(c)) for c in table], NAMES)
        if len(begin):
            first, told = rows[:, begin[-1]].copy(), bool(several[-1])
        last = (gram[-1], node[-1])


def _sets(shared: frozenset[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            nodes, raw, held = [], [], 0
            for s in ngram_sets(b.column(0)):
                nodes.append(_node(set_key(s), shared))
                raw.append(s.tobytes())
                held += s.nbytes
                if held > 1 << 23:
                    yield pa.record_batch([pa.array(nodes, pa.int64()), pa.array(raw, pa.binary())], ["node", "grams"])
                    nodes, raw, held = [], [], 0
            yield pa.record_batch([pa.array(nodes, pa.int64()), pa.array(raw, pa.binary())], ["node", "grams"])

    return run


def _overlaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A block of pairs: for each run of pairs with one left set, the incidence of the right sets times the left one."""
    for b in batches:
        a, other = b.column(0).to_numpy(), b.column(1).to_numpy()
        left, right = b.column(2), b.column(3)
        good = np.zeros(len(a), bool)
        cuts = np.flatnonzero(np.concatenate(([True], a[1:] != a[:-1], [True]))) if len(a) else np.zeros(1, np.int64)
        for i, j in zip(cuts[:-1], cuts[1:], strict=True):
            one = np.frombuffer(left[int(i)].as_buffer(), U64)
            for k in range(int(i), int(j)):
                many = np.frombuffer(right[k].as_buffer(), U64)
                at = np.minimum(np.searchsorted(one, many), len(one) - 1)
                both = int((one[at] == many).sum())
                good[k] = DEN * both >= NUM * (len(one) + len(many) - both)
        yield pa.record_batch([pa.array(a[good]), pa.array(other[good])], ["a", "b"])


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id) for each row of docs.

    component_id is the smallest id reachable by links, the row's own included. Null and empty texts have no n-grams
    and link with nothing: their component is their own id. Rows with equal sets are linked, repeated rows too. Null ids
    count as larger than others; a component of null ids alone has none. Only id and text are read, so other columns may
    have any name. An empty table gives no rows.
    """
    found, _ = _grouped(docs, id_col, text_col)
    own = F.when(F.col("n") == 0, F.col("id")).otherwise(F.col("component_id"))
    return found.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), own.alias("component_id"))


def _grouped(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, frozenset[int]]:
    """(id, n, node, root, component_id) for each row: its set, and its group by a name that is never null; and the first halves of keys that several sets share."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), whole_text(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    survey = written(rows.mapInArrow(released(_survey), f"id {kind}, n long, k1 long, k2 long, sig binary, gram long"), "survey")
    sets = survey.where("gram is null")

    # A set goes by the first half of its key; where sets share it, by the second.
    twice = sets.groupBy("k1").agg(F.min("k2").alias("lo"), F.max("k2").alias("hi")).where("lo < hi").select("k1").collect()
    shared = frozenset(r["k1"] for r in twice)
    node = F.when(F.col("k1").isin(sorted(shared)), F.col("k2")).otherwise(F.col("k1")) if shared else F.col("k1")
    members = sets.select("id", "n", node.alias("node"))
    signed = sets.where("n > 0").select("id", "n", node.alias("node"), "sig")
    nodes = written(signed.groupBy("node").agg(F.min("id").alias("rep"), F.min("n").alias("n"), F.first("sig", ignorenulls=True).alias("sig")), "nodes")

    # Which n-grams of the prefixes are frequent is counted exactly, so that the columns dealt out stay small.
    early = _frequent(survey.where("gram is not null").groupBy("gram").agg(F.sum("n").alias("n")).where(F.col("n") >= FREQUENT))
    prefixes = rows.select("text").mapInArrow(released(_columns(early, shared, grams_only=True)), "gram long").groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    late = _frequent(prefixes.where(F.col("n") > WIDE), early)
    # One shuffle of the columns; most hold one row and end in the task that reads them.
    columns = rows.select("text").mapInArrow(released(_columns(late, shared)), COLUMN).repartition("gram").sortWithinPartitions("gram", "node")
    block = written(columns.mapInArrow(released(_shared), COLUMN), "columns")

    def linked(pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) that reach the threshold."""
        ends = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        wanted = written(nodes.join(ends, "node").select(F.col("rep").alias("id")), "wanted")
        wanted = F.broadcast(wanted) if wanted.count() <= SENT else wanted
        texts = rows.join(wanted, rows["id"].eqNullSafe(wanted["id"]), "left_semi").select("text")
        grams = texts.mapInArrow(released(_sets(shared)), "node long, grams binary")
        right = pairs.join(grams, pairs["b"] == grams["node"]).select("a", "b", F.col("grams").alias("right"))
        both = right.join(grams.select(F.col("node").alias("a"), F.col("grams").alias("left")), "a").select("a", "b", "left", "right")
        return written(both.mapInArrow(released(_overlaps), "a long, b long"), "links")

    def star(open_columns: DataFrame) -> DataFrame:
        """Pairs of a row with the leads of its columns, of leads that it shares an eighth of its columns with.

        The lead of a column is its row that meets most others in all columns: the text that others were copied from."""
        width = open_columns.groupBy("gram").agg(F.count(F.lit(1)).alias("width"))
        weight = open_columns.join(width, "gram").groupBy("node").agg(F.sum("width").alias("weight"))
        lead = open_columns.join(weight, "node").groupBy("gram").agg(F.max(F.struct("weight", "node", "n")).alias("lead"))
        ends = open_columns.join(lead, "gram").select(F.col("lead.node").alias("a"), F.col("node").alias("b"), F.col("lead.n").alias("an"), F.col("n").alias("bn"))
        ends = ends.where((F.col("a") != F.col("b")) & (NUM * F.greatest("an", "bn") <= DEN * F.least("an", "bn")))
        counted = ends.groupBy("a", "b").agg(F.count(F.lit(1)).alias("both"), F.first("bn").alias("bn"))
        return counted.where(F.col("both") * 8 >= _prefix(F.col("bn"))).select("a", "b")

    def split_columns(found: DataFrame) -> DataFrame:
        """The rows of columns where more than one component is left, with their components."""
        placed = block.join(found, "node", "left").withColumn("root", F.coalesce("root", "node"))
        split = placed.groupBy("gram").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi").select("gram")
        return written(placed.join(split, "gram"), "rest")

    tried = written(star(block), "pairs")
    links = linked(tried)
    rest = split_columns(roots(links))
    again = written(star(rest).join(tried, ["a", "b"], "left_anti"), "pairs")
    links = links.unionByName(linked(again))
    found = roots(links)
    tried = tried.unionByName(again)
    tried = tried.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    rest = split_columns(found)

    # Columns where more than one component is left: each pair meets at its first common n-gram, and again only where
    # the BEFORE open n-grams in front of that have none in common. All that two components share is in open columns.
    ahead = Window.partitionBy("node").orderBy("place")
    rest = rest.select("*", *(F.lag("gram", k).over(ahead).alias(f"p{k}") for k in range(1, BEFORE + 1)))
    step = F.floor(F.log("n") / F.log(F.lit(DEN / NUM))).cast("int")
    x = rest.withColumn("step", F.explode(F.array(step, step + 1))).alias("x")
    y = rest.withColumn("step", step).alias("y")
    # x is the smaller; sizes within the threshold lie in one step or in two next to each other.
    smaller = (F.col("x.n") < F.col("y.n")) | ((F.col("x.n") == F.col("y.n")) & (F.col("x.node") < F.col("y.node")))
    least = F.ceil(NUM * (F.col("x.n") + F.col("y.n")) / F.lit(NUM + DEN))
    # What the two can share from their first common n-gram on.
    behind = F.least(F.col("x.n") - F.col("x.place"), F.col("y.n") - F.col("y.place"))
    earlier = reduce(or_, (F.col(f"x.p{i}") == F.col(f"y.p{j}") for i in range(1, BEFORE + 1) for j in range(1, BEFORE + 1)))
    close = (
        (F.col("x.gram") == F.col("y.gram")) & (F.col("x.step") == F.col("y.step")) & (F.col("x.root") != F.col("y.root")) & smaller
        & (NUM * F.col("y.n") <= DEN * F.col("x.n")) & (behind >= least) & ~F.coalesce(earlier, F.lit(False))
    )
    met = x.join(y, close).select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct()
    met = met.join(tried, ["a", "b"], "left_anti")
    signed = met.join(nodes.select(F.col("node").alias("a"), "n", F.col("sig").alias("left")), "a").join(nodes.select(F.col("node").alias("b"), F.col("n").alias("m"), F.col("sig").alias("right")), "b")
    pairs = written(signed.select("a", "b", "n", "m", "left", "right").mapInArrow(released(_close), "a long, b long"), "pairs")
    if pairs.limit(1).count():
        found = roots(links.unionByName(linked(pairs)))

    labels = nodes.join(found, "node", "left").withColumn("root", F.coalesce("root", "node"))
    smallest = labels.groupBy("root").agg(F.min("rep").alias("component_id"))
    classes = labels.join(smallest, "root").select("node", "root", "component_id")
    return members.join(classes, "node", "left").select("id", "n", "node", "root", "component_id"), shared


def _frequent(counted: DataFrame, before: str | None = None) -> str:
    """Publish the bit map of frequent n-grams, over an earlier one if given. It has a fixed size, whatever the corpus, and changes the order of n-grams, never a result."""
    place = F.shiftrightunsigned("gram", 64 - MAP_BITS)
    top = counted.orderBy(F.desc("n"), "gram").limit(REMEMBERED).select(place.cast("int").alias("place")).distinct().toArrow()
    bits = np.fromfile(local_file(before), np.uint8) if before else np.zeros(1 << MAP_BITS - 3, np.uint8)
    at = top.column("place").to_numpy()
    np.bitwise_or.at(bits, at >> 3, (1 << (at & 7)).astype(np.uint8))
    return publish(counted.sparkSession, bits.tobytes(), "frequent")


def kept_of_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with one row of each group: that of the smallest id, which names the component; null ids come last.

    Rows without n-grams are no group's and stay, repeated ones too. Where rows share an id, or have none, they are told
    apart by their sets, so a row stays or goes by its own group; of rows with one id and one set, one stays.
    Columns may have any name.
    """
    found, shared = _grouped(docs, id_col, text_col)
    found = written(found.select("id", "n", "node", "root"), "groups")
    place = F.struct(F.col("id").isNull().alias("none"), F.col("id").alias("id"), F.col("node").alias("node"))
    first = found.where("n > 0").groupBy("root").agg(F.min(place).alias("first")).select("first.id", "first.node")
    first = written(first, "first")
    several = found.groupBy("id").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1 or id is null").select(F.col("id").alias("other"))
    several = written(several, "several")
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")).withColumn("key", F.col("row").getField(id_col))
    gone = found.where("n > 0 and id is not null").join(first, ["id", "node"], "left_anti").select(F.col("id").alias("other"))
    if several.limit(1).count() == 0:
        return rows.join(gone, F.col("key") == F.col("other"), "left_anti").select("row.*")

    again = F.col("key").eqNullSafe(F.col("other"))
    alone = rows.join(several, again, "left_anti").join(gone.distinct(), F.col("key") == F.col("other"), "left_anti")
    known = rows.join(several, again, "left_semi").withColumn("sha", F.sha2(whole_text(F.col("row").getField(text_col)), 256))
    texts = known.select("sha", whole_text(F.col("row").getField(text_col)).alias("text")).dropDuplicates(["sha"])
    nodes = texts.mapInArrow(released(_named(shared)), "sha string, n long, node long").select(F.col("sha").alias("other_sha"), "n", "node")
    named = known.join(nodes, F.col("sha") == F.col("other_sha"))
    first = first.select(F.col("id").alias("first_id"), F.col("node").alias("first_node"))
    one = named.where("n > 0").join(first, F.col("key").eqNullSafe(F.col("first_id")) & (F.col("node") == F.col("first_node")), "left_semi").dropDuplicates(["key", "node"])
    return alone.select("row.*").unionByName(one.select("row.*")).unionByName(named.where("n = 0").select("row.*"))


def _named(shared: frozenset[int]):
    """(name, text) to (name, size and node of its set)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [(len(s), _node(set_key(s), shared)) for s in ngram_sets(b.column(1))]
            yield pa.record_batch([b.column(0), pa.array([n for n, _ in sets], pa.int64()), pa.array([node for _, node in sets], pa.int64())], ["sha", "n", "node"])

    return run


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(documents(spark, sf_dir))
