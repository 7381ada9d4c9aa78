"""Spot-signature fingerprints of documents.

Native. Each anchor (a common word of one of four languages, or the start of a line) is followed by a
chain of the next two content words, over other anchors where they stand between; anchor and chain make
a signature. Where no anchor comes for more than RUN content words, each of them starts a signature with
the words after it, so that the whole text counts. A document's fingerprint is the sorted set of its
64-bit signature hashes. near_links compares distinct fingerprints partitioned by set length, through Jaccard
pruned by the lengths and by rare signatures; the registered query compares each with two given ones and
needs no partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .support import documents, durable, whole_text

#: Common words of English, French, German and Spanish.
ANCHORS = (
    "the of and to in a is that it for on was be with as by at are an from this he his not or have had they you which one we were her all she there would their "
    "de la le les et des en un une du que qui dans il elle pour pas au sur ce se est par sont avec "
    "der die und das den von zu mit sich ist im dem nicht ein eine auf auch als es an werden aus er hat sie nach bei "
    "el los y las del por con no una su para como más pero sus al lo o este sí porque"
).split()

#: The length of a chain, the likeness from which documents are near, and the marks used inside a text.
CHAIN, NEAR = 2, 0.8
#: The content words after an anchor from which anchors are sparse; ranges of ids for each shuffle partition.
RUN, RANGES = 8, 8
LINE, MARK = "\u0001", "\u0002"


def with_signatures(rows: DataFrame, text_col: str, out: str) -> DataFrame:
    """rows with the sorted distinct signature hashes of a text; every text with more than white space has one at least.
    A text of symbols alone is hashed as it is."""
    plain = F.regexp_replace(F.lower(text_col), r"[^\p{L}\p{N}\n]+", " ")
    lines = F.concat(F.lit(LINE + " "), F.regexp_replace(plain, r" ?\n[ \n]*", f" {LINE} "))
    words = F.filter(F.split(lines, " "), lambda w: w != "")
    marked = F.transform(words, lambda w: F.when(w.isin([*ANCHORS, LINE]), F.concat(F.lit(MARK), w)).otherwise(w))
    # Parts between marks: the anchor, then the content words up to the next anchor.
    parts = F.slice(F.split(F.array_join(marked, " "), MARK), 2, 1 << 30)

    def head(part: Column) -> Column:
        anchor = F.substring_index(F.rtrim(part), " ", 1)
        content = F.when(F.instr(part, " ") > 0, F.substring(part, F.instr(part, " ") + 1, F.lit(1 << 30))).otherwise("")
        return F.struct(anchor.alias("anchor"), F.rtrim(F.substring_index(content, " ", CHAIN)).alias("words"))

    def signature(x: Column, i: Column) -> Column:
        after = (F.coalesce(F.get("_heads", i + k)["words"], F.lit("")) for k in range(1, CHAIN + 1))
        joined = F.concat_ws(" ", *(F.when(h != "", h) for h in (x["words"], *after)))
        chain = F.substring_index(joined, " ", CHAIN)
        return F.when((chain != "") | (x["anchor"] != LINE), F.xxhash64(F.concat_ws(" ", x["anchor"], chain)))

    # Runs without anchors: every content word with the CHAIN words after it.
    runs = F.filter(F.transform(parts, lambda p: F.split(F.rtrim(p), " ")), lambda ws: F.size(ws) > RUN + 1)
    inside = F.flatten(F.transform(runs, lambda ws: F.transform(F.sequence(F.lit(2), F.size(ws) - CHAIN), lambda i: F.xxhash64(F.array_join(F.slice(ws, i, CHAIN + 1), " ")))))

    # _heads is a column of its own, used several times, so it is computed once for each row.
    headed = rows.withColumn("_heads", F.transform(parts, head)).withColumn("_runs", inside)
    found = F.array_sort(F.array_distinct(F.concat(F.array_compact(F.transform("_heads", signature)), "_runs")))
    signed = headed.withColumn(out, found).drop("_heads", "_runs")
    return signed.withColumn(out, F.when((F.size(out) == 0) & F.col(text_col).rlike(r"\S"), F.array(F.xxhash64(text_col))).otherwise(F.col(out)))


def as_text(sigs: Column) -> Column:
    """A signature set as text: 16 hex digits each, in ascending order of the signed hashes."""
    return F.array_join(F.transform(sigs, lambda x: F.lpad(F.hex(x), 16, "0")), "")


def length_class(sigs: Column, near: float = NEAR) -> Column:
    """The partition of a set by its length: sets with Jaccard of `near` or more lie in one class or two next to each other."""
    return F.when(F.size(sigs) > 0, F.floor(F.log(F.size(sigs).cast("double")) / F.log(F.lit(1 / near)))).otherwise(F.lit(-1)).cast("int")


def likeness(a: Column, b: Column, least: float = 0.0) -> Column:
    """Jaccard of two signature sets; 0 without comparing where the lengths keep it below `least`. Two empty sets are alike."""
    small, large = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    common = F.size(F.array_intersect(a, b))
    return (
        F.when(large == 0, F.lit(1.0))
        .when((small == 0) | (small < large * F.lit(least)), F.lit(0.0))
        .otherwise(common / (small + large - common))
    )


def members(rows: DataFrame, id_col: str, sigs_col: str) -> DataFrame:
    """(id, class_id) of every id: the least id whose signature set is the same. Empty sets are one class; null ids are in none."""
    sets = rows.select(F.col(id_col).alias("id"), F.col(sigs_col).alias("s")).where("id is not null")
    return sets.join(sets.groupBy("s").agg(F.min("id").alias("class_id")), "s").select("id", "class_id").distinct()


def near_links(rows: DataFrame, id_col: str, sigs_col: str, near: float = NEAR) -> DataFrame:
    """(a, b, likeness), a < b, of the pairs of classes, as in `members`, whose sets differ and have a Jaccard of `near` or more.

    Each distinct set is one row, so copies and empty sets, however many, add nothing. A set meets those of its length class and the
    next. Hashes stand in one global order, the rarest first, and pairs that reach `near` share one of the first n - ceil(near n) + 1
    of each; a hash of one set alone links nothing. Signatures that a whole corpus shares come last and are seldom met.
    A row with a null set takes no part. Sets need not be sorted; their members are distinct."""
    sets = durable(rows.select(F.col(id_col).alias("id"), F.col(sigs_col).alias("s")).where("id is not null and size(s) > 0").groupBy("s").agg(F.min("id").alias("id")))
    each = sets.select("id", F.explode("s").alias("h"))
    ordered = each.join(each.groupBy("h").agg(F.count(F.lit(1)).alias("n")), "h").groupBy("id").agg(F.sort_array(F.collect_list(F.struct("n", "h"))).alias("o"))
    n = F.size("o")
    lead = F.slice("o", F.lit(1), (n - F.ceil(n * F.lit(near) - F.lit(1e-9)) + 1).cast("int"))
    led = durable(ordered.select("id", length_class(F.col("o"), near).alias("class"), F.explode(F.transform(F.filter(lead, lambda x: x["n"] > 1), lambda x: x["h"])).alias("h")))
    low = led.select(F.col("id").alias("x"), "h", F.explode(F.array(F.col("class"), F.col("class") + 1)).alias("class"))
    met = low.join(led.withColumnRenamed("id", "y"), ["class", "h"]).where("x != y")
    pairs = met.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
    both = pairs.join(sets.select(F.col("id").alias("a"), F.col("s").alias("sa")), "a").join(sets.select(F.col("id").alias("b"), F.col("s").alias("sb")), "b")
    return both.select("a", "b", likeness(F.col("sa"), F.col("sb"), near).alias("likeness")).where(F.col("likeness") >= near)


def near_pairs(rows: DataFrame, id_col: str, sigs_col: str, near: float = NEAR) -> DataFrame:
    """(a, b, likeness), a < b, of all pairs of ids whose signature sets have a Jaccard of `near` or more. A null id is in no pair.

    This writes out near_links for every member, so n copies make n squared pairs; large tables take near_links and members."""
    of = durable(members(rows, id_col, sigs_col))
    links = near_links(rows, id_col, sigs_col, near)
    x, y = of.select(F.col("id").alias("x"), F.col("class_id").alias("a")), of.select(F.col("id").alias("y"), F.col("class_id").alias("b"))
    across = links.join(x, "a").join(y, "b").select("x", "y", "likeness")
    inside = x.join(y, F.col("a") == F.col("b")).where("x < y").select("x", "y", F.lit(1.0).alias("likeness"))
    return across.unionByName(inside).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), "likeness").where("a != b").distinct()


def ranges(docs: DataFrame, id_col: str) -> list:
    """The least ids, ascending, of RANGES ranges of about equally many ids for each shuffle partition; none for a table without ids."""
    ids = docs.select(F.col(id_col).alias("id")).where("id is not null")
    count = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1) * RANGES
    least = ids.repartitionByRange(count, "id").groupBy(F.spark_partition_id()).agg(F.min("id").alias("id"))
    return sorted(r["id"] for r in least.collect())


def with_next(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text, s, next) for each row: its signatures, and text and signatures of the next document in ascending id.

    Rows are dealt out once, by ranges of ids, and each range also gets the first row of the one after it (the last range
    that of the first). Inside a range the next document is what comes before in descending order."""
    least = ranges(docs, id_col)
    bounds = F.array(*map(F.lit, least[1:]))
    at = F.size(F.filter(bounds, lambda x: x <= F.col("id"))) if len(least) > 1 else F.lit(0)
    rows = docs.select(F.col(id_col).alias("id"), whole_text(text_col).alias("text"))
    rows = rows.withColumn("range", F.when(F.col("id").isNull(), F.lit(max(len(least) - 1, 0))).otherwise(at))
    kind = docs.schema[id_col].dataType
    # One id for each range, so no more than RANGES for each shuffle partition. Without ids the first document is the least text.
    if least:
        heads = docs.sparkSession.createDataFrame([(x, (k - 1) % len(least)) for k, x in enumerate(least)], T.StructType([T.StructField("head", kind), T.StructField("to", T.IntegerType())]))
        heads = rows.join(F.broadcast(heads), F.col("id") == F.col("head")).groupBy("id", "to").agg(F.min("text").alias("text"))
    else:
        heads = rows.groupBy("id", F.lit(0).alias("to")).agg(F.min("text").alias("text"))
    extra = heads.select("id", "text", F.col("to").alias("range"), F.lit(True).alias("extra"))
    count = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    dealt = with_signatures(rows.withColumn("extra", F.lit(False)).unionByName(extra).repartition(count, "range"), "text", "s")
    w = Window.partitionBy("range").orderBy(F.desc("extra"), F.desc_nulls_first("id"), F.desc("text"))
    stands = F.col("extra") | F.lead("extra").over(w).isNull() | ~F.lead("id").over(w).eqNullSafe(F.col("id"))
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    chained = dealt.withColumn("stands", stands).withColumn("next", F.last(F.when(F.col("stands"), F.struct("text", "s")), ignorenulls=True).over(before))
    return chained.where(~F.col("extra")).select("id", "text", "s", "next")


def fingerprinted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, with their likeness and that to the next document.

    The edited text has the last floor(n/2) code points replaced by the first as many of the next document in
    ascending id, after the last the first. A null text is the empty text: no signatures, likeness 1 to another
    empty text and 0 to others. Of rows that share an id, the one with the smallest text stands for the id as a
    next document, and each keeps its own row. Null ids are one id that comes last. Ids may be of any type that
    has an order. Only id and text are read.
    """
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("next.text"), F.lit(1), half))
    rows = with_next(docs, id_col, text_col).select("id", n.cast("long").alias("n_chars"), "s", F.col("next.s").alias("next_sigs"), edited.alias("edited"))
    return with_signatures(rows, "edited", "e").select(
        F.col("id").alias(id_col), "n_chars", F.sha2("edited", 256).alias("edited_sha256"), as_text(F.col("s")).alias("fingerprint"), as_text(F.col("e")).alias("edited_fingerprint"),
        likeness(F.col("s"), F.col("e")).alias("near_edited"), likeness(F.col("s"), F.col("next_sigs")).alias("near_next"), length_class(F.col("s")).alias("length_class"),
    )


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprinted(documents(spark, sf_dir))
