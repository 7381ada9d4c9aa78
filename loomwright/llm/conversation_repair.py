"""Structure repair of conversations by signatures.

The rows of a conversation, in order, are one letter each: the role's initial and the row's first fault. Equal
strings are one signature, solved once by memoised recursion over (row, state); counts, cost and audit join back
to the conversations, and the audit is replayed over the rows to give the repaired text.

Rows are dealt out by ranges of (conversation, turn), so a conversation of many rows lies in many tasks until its
letters are put together; a first row with a role and text is found by one aggregate and met again by its unique
place, never by the repeated text. The SHA-256 of a repaired conversation can only be computed from its first byte
to its last, so there, and only there, one task streams a conversation, holding one batch of rows and the audit.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .support import written

#: Costs of the edits: keep, rerole, delete, insert; and of a truncated row that stays.
KEEP, REROLE, DELETE, INSERT, CUT = 0, 2, 3, 2, 1

#: Letters of a row, by the role's initial (s, u, a, other): sound, truncated, blank, duplicate.
SOUND, TRUNCATED, BLANK, DUPLICATE = "suax", "SUAX", "0123", "4567"

#: ASCII white space.
SPACES = " \t\n\x0b\x0c\r"

#: States of what is written so far: nothing, one s, ends with u, ends with a (or is whole).
START, SYSTEM, USER, ASSISTANT = range(4)

#: The state after a u or an a that is rewritten or inserted, and its role.
NEXT = (USER, USER, ASSISTANT, USER)
ROLE = {USER: "user", ASSISTANT: "assistant"}


def kept_state(state: int, initial: str) -> int | None:
    """The state after a row is kept, None where its role may not stand there."""
    if initial == "s":
        return SYSTEM if state == START else None
    if initial == "u":
        return USER if state != USER else None
    return ASSISTANT if initial == "a" and state == USER else None


def initial_of(letter: str) -> str:
    """s, u, a or x of any letter."""
    for kind in (SOUND, TRUNCATED, BLANK, DUPLICATE):
        if letter in kind:
            return SOUND[kind.index(letter)]
    raise ValueError(letter)


def solve(signature: str) -> tuple[int, str]:
    """The least cost of edits that give s?(ua)+ or nothing, and their initials; of equal costs the least string.

    Edits that may begin a rest differ in their initial, so the least string is found by taking the least initial
    of those that reach the least cost. best(row, state) is the recursion; it is asked from the last row back, so
    that it finds the next row's values in its memo and never goes deeper than the inserts before one row.
    """
    n = len(signature)
    never = 1 << 60
    memo: list[list[tuple[int, str]]] = [[(never, "")] * 4 for _ in range(n + 1)]

    def moved(row: int, state: int) -> tuple[int, str]:
        """The best that begins with no insert."""
        if row == n:
            return (0, "") if state in (START, ASSISTANT) else (never, "")
        letter = signature[row]
        found = [(DELETE + memo[row + 1][state][0], "D")]
        if letter in SOUND or letter in TRUNCATED:
            stays = CUT if letter in TRUNCATED else 0
            after = kept_state(state, initial_of(letter))
            if after is not None:
                found.append((KEEP + stays + memo[row + 1][after][0], "K"))
            found.append((REROLE + stays + memo[row + 1][NEXT[state]][0], "R"))
        return min(found)

    for row in range(n, -1, -1):
        plain = [moved(row, s) for s in range(4)]

        def best(state: int, inserts: int = 2, plain=plain) -> tuple[int, str]:
            """Inserts only alternate between u and a: after two the state repeats, or START and SYSTEM have become USER."""
            if not inserts:
                return plain[state]
            return min(plain[state], (INSERT + best(NEXT[state], inserts - 1)[0], "I"))

        memo[row] = [best(s) for s in range(4)]

    audit, row, state = [], 0, START
    while True:
        cost, edit = memo[row][state]
        if not edit:
            return memo[0][START][0], "".join(audit)
        audit.append(edit)
        if edit == "I":
            state = NEXT[state]
            continue
        if edit == "K":
            state = kept_state(state, initial_of(signature[row]))
        elif edit == "R":
            state = NEXT[state]
        row += 1


def solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """signature to its counts, cost and audit."""
    for b in batches:
        signatures = b.column(0).to_pylist()
        rows = []
        for s in signatures:
            initials = "".join(map(initial_of, s))
            illegal = sum(initials[i : i + 2] not in ("su", "ua", "au") for i in range(len(s) - 1))
            rows.append((*(sum(s.count(c) for c in kind) for kind in (BLANK, DUPLICATE, TRUNCATED)), illegal, *solve(s)))
        columns = zip(*rows, strict=True) if rows else [()] * 6
        kinds = [pa.int64()] * 5 + [pa.string()]
        yield pa.record_batch([b.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], ["signature", "blank", "duplicate", "truncated", "illegal", "cost", "audit"])


def replayed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (conv, audit) or (conv, role, text), each conversation's audit before its rows, to (conv, repaired_sha256).

    The audit's edits are taken as the rows come: inserts before a row are written first, inserts left over at the end.
    """
    conv, audit, at, state, lines, digest, open_ = None, "", 0, START, 0, None, False
    done: list[tuple] = []

    def write(role: str, text: str) -> None:
        nonlocal lines
        digest.update((("\n" if lines else "") + role + ":" + text).encode())
        lines += 1

    def inserts() -> None:
        nonlocal at, state
        while at < len(audit) and audit[at] == "I":
            state = NEXT[state]
            write(ROLE[state], "")
            at += 1

    def close() -> None:
        if open_:
            inserts()
            done.append((conv, digest.hexdigest()))

    def flush(kind: pa.DataType) -> pa.RecordBatch:
        out = pa.record_batch([pa.array([d[0] for d in done], kind), pa.array([d[1] for d in done], pa.string())], ["conv", "repaired_sha256"])
        done.clear()
        return out

    kind = None
    for b in batches:
        kind = b.column(0).type
        for c, a, role, text in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
            if a is not None:
                close()
                conv, audit, at, state, lines, digest, open_ = c, a, 0, START, 0, hashlib.sha256(), True
                continue
            inserts()
            edit = audit[at]
            at += 1
            if edit == "K":
                state = kept_state(state, role[0])
                write(role, text)
            elif edit == "R":
                state = NEXT[state]
                write(ROLE[state], text)
        if done:
            yield flush(kind)
    close()
    if done:
        yield flush(kind)


def damaged(talks: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv, turn, role, text) after the damage that crc32 of `conv:turn` modulo 20 names; null ids, roles and texts are one space, but conv and turn stay null."""
    spaced = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.pmod(F.crc32(F.concat(spaced(conv_col), F.lit(":"), spaced(turn_col)).cast("binary")), F.lit(20))
    rows = talks.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), spaced(role_col).alias("role"), spaced(text_col).alias("text"), kind.alias("kind")).where("kind != 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")
    return rows.select("conv", "turn", role.alias("role"), text.alias("text"), copies).drop("copy")


def letter(initial: Column, fault: Column) -> Column:
    """The letter of a row: fault 0 sound, 1 truncated, 2 blank, 3 duplicate."""
    place = F.when(initial == "s", 1).when(initial == "u", 2).when(initial == "a", 3).otherwise(4)
    kinds = F.when(fault == 0, SOUND).when(fault == 1, TRUNCATED).when(fault == 2, BLANK).otherwise(DUPLICATE)
    return F.substring(kinds, place, F.lit(1))


def repaired(talks: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row for each conversation of talks: gaps, faults, cost, audit and repaired_sha256 after damaged().

    Rows of a conversation stand by turn (null first), rows of one turn by role, then the
    SHA-256 of the text; a repeated row therefore
    follows its like. Rows without a conversation id are one conversation, whose id is null. A role without a first
    character has no initial, so it is illegal beside any row and cannot be kept. A conversation that loses all rows has
    zeros, no audit and the hash of the empty string. Other columns are not read; an empty table gives no rows.
    """
    order = ("conv", "turn", "role", "h")
    hashed = damaged(talks, conv_col, turn_col, role_col, text_col).withColumn("h", F.unhex(F.sha2("text", 256)))
    # The last key only parts rows that are equal, so that no number of them is one task's.
    placed = hashed.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(*order, "tie").sortWithinPartitions(*order)
    ends = F.right(F.rtrim("text", F.lit(SPACES)), F.lit(1))
    fault = F.when(ends == "", 2).when(~ends.rlike("[.!?]"), 1).otherwise(0)
    rows = placed.select("conv", "turn", "role", "text", "h", F.monotonically_increasing_id().alias("place"), F.left("role", F.lit(1)).alias("initial"), fault.alias("fault"))
    rows = written(rows, "rows")

    firsts = rows.groupBy("conv", "role", "h").agg(F.min("place").alias("place")).select("place", F.lit(True).alias("first"))
    faults = rows.select("conv", "place", "initial", "fault").join(firsts, "place", "left")
    seen = F.when((F.col("fault") != 2) & F.col("first").isNull(), 3).otherwise(F.col("fault"))
    lettered = faults.select("conv", "place", letter(F.col("initial"), seen).alias("letter"))
    joined = lambda items, field: F.array_join(F.transform(F.array_sort(F.collect_list(items)), lambda x: x[field]), "")
    parts = lettered.groupBy("conv", F.shiftright("place", 33).alias("part")).agg(joined(F.struct("place", "letter"), "letter").alias("letters"))
    signed = parts.groupBy("conv").agg(joined(F.struct("part", "letters"), "letters").alias("signature"))
    signed = written(signed, "signatures")
    answers = signed.select("signature").distinct().mapInArrow(solved, "signature string, blank long, duplicate long, truncated long, illegal long, cost long, audit string")
    audited = written(signed.join(answers, "signature").drop("signature"), "audits")

    empty = F.lit(None).cast("string")
    stream = audited.select("conv", "audit", empty.alias("role"), empty.alias("text"), F.lit(-1).cast("long").alias("place")).unionByName(rows.select("conv", empty.alias("audit"), "role", "text", "place"))
    stream = stream.repartition("conv").sortWithinPartitions("conv", "place").select("conv", "audit", "role", "text")
    kind = rows.schema["conv"].dataType.simpleString()
    hashes = stream.mapInArrow(replayed, f"conv {kind}, repaired_sha256 string")

    # Distinct turns first, then one row for each conversation: both combine on the map side.
    turns = rows.groupBy("conv", "turn").agg(F.count(F.lit(1)).alias("n")).groupBy("conv").agg((F.max("turn") - F.min("turn") + 1 - F.count("turn")).alias("gaps"))
    every = talks.select(F.col(conv_col).alias("conv")).distinct()
    whole = every
    for side in (turns, audited, hashes):
        s = side.withColumnRenamed("conv", "other")
        whole = whole.join(s, F.col("conv").eqNullSafe(F.col("other")), "left").drop("other")
    zero = lambda c: F.coalesce(F.col(c).cast("long"), F.lit(0).cast("long")).alias(c)
    return whole.select(F.col("conv").alias(conv_col), *map(zero, ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")), F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repaired(spark.read.parquet(f"{sf_dir.rstrip('/')}/conversations.parquet"))


#: The best rest from each state is a struct of cost, audit and text, which compares by cost, then audit.
ORACLE = r"""
WITH RECURSIVE k AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations
), c AS (
  SELECT *, xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(1, length(key) + 1), lambda i: CAST(ord(substr(key, i, 1)) AS BIGINT))),
    lambda h, b: list_reduce(list_prepend(xor(h, b), [CAST(1 AS BIGINT), 1, 1, 1, 1, 1, 1, 1]), lambda x, i: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END)))) % 20 AS kind FROM k
), g AS (
  SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM (SELECT *, unnest(CASE kind WHEN 0 THEN [] WHEN 3 THEN [0, 1] ELSE [0] END) AS copy FROM c)
), o AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS i, substr(role, 1, 1) AS ini, regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS ends FROM g
), f AS (
  SELECT *, CASE WHEN ends = '' THEN 'b' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'd' WHEN ends NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault,
    lag(ini) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM o
), n AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE fault = 'b') AS blank, count(*) FILTER (WHERE fault = 'd') AS duplicate,
    count(*) FILTER (WHERE fault = 't') AS truncated, count(*) FILTER (WHERE i > 1 AND before || ini NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n FROM f GROUP BY conv_id
), r AS (
  SELECT conv_id, n AS i, {'c': 0, 'a': '', 't': ''} AS z, {'c': 4, 'a': 'II', 't': 'user:' || chr(10) || 'assistant:' || chr(10)} AS s,
    {'c': 2, 'a': 'I', 't': 'assistant:' || chr(10)} AS u, {'c': 0, 'a': '', 't': ''} AS a FROM n
  UNION ALL
  SELECT conv_id, i - 1, list_min([mz, {'c': mu.c + 2, 'a': 'I' || mu.a, 't': 'user:' || chr(10) || mu.t}, {'c': ma.c + 4, 'a': 'II' || ma.a, 't': 'user:' || chr(10) || 'assistant:' || chr(10) || ma.t}]),
    list_min([ms, {'c': mu.c + 2, 'a': 'I' || mu.a, 't': 'user:' || chr(10) || mu.t}, {'c': ma.c + 4, 'a': 'II' || ma.a, 't': 'user:' || chr(10) || 'assistant:' || chr(10) || ma.t}]),
    list_min([mu, {'c': ma.c + 2, 'a': 'I' || ma.a, 't': 'assistant:' || chr(10) || ma.t}]),
    list_min([ma, {'c': mu.c + 2, 'a': 'I' || mu.a, 't': 'user:' || chr(10) || mu.t}])
  FROM (
    SELECT r.conv_id, r.i,
      list_min([{'c': z.c + 3, 'a': 'D' || z.a, 't': z.t}, {'c': u.c + 2 + w, 'a': 'R' || u.a, 't': 'user:' || text || chr(10) || u.t},
        CASE ini WHEN 's' THEN {'c': s.c + w, 'a': 'K' || s.a, 't': role || ':' || text || chr(10) || s.t} WHEN 'u' THEN {'c': u.c + w, 'a': 'K' || u.a, 't': role || ':' || text || chr(10) || u.t} END]) AS mz,
      list_min([{'c': s.c + 3, 'a': 'D' || s.a, 't': s.t}, {'c': u.c + 2 + w, 'a': 'R' || u.a, 't': 'user:' || text || chr(10) || u.t},
        CASE ini WHEN 'u' THEN {'c': u.c + w, 'a': 'K' || u.a, 't': role || ':' || text || chr(10) || u.t} END]) AS ms,
      list_min([{'c': u.c + 3, 'a': 'D' || u.a, 't': u.t}, {'c': a.c + 2 + w, 'a': 'R' || a.a, 't': 'assistant:' || text || chr(10) || a.t},
        CASE ini WHEN 'a' THEN {'c': a.c + w, 'a': 'K' || a.a, 't': role || ':' || text || chr(10) || a.t} END]) AS mu,
      list_min([{'c': a.c + 3, 'a': 'D' || a.a, 't': a.t}, {'c': u.c + 2 + w, 'a': 'R' || u.a, 't': 'user:' || text || chr(10) || u.t},
        CASE ini WHEN 'u' THEN {'c': u.c + w, 'a': 'K' || u.a, 't': role || ':' || text || chr(10) || u.t} END]) AS ma
    FROM r JOIN (SELECT *, CASE fault WHEN 't' THEN 1 WHEN '' THEN 0 ELSE 1000000 END AS w FROM f) AS f ON r.conv_id IS NOT DISTINCT FROM f.conv_id AND r.i = f.i
  )
), e AS (
  SELECT conv_id, z.c AS cost, z.a AS audit, z.t AS t FROM r WHERE i = 0
)
SELECT x.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  CAST(coalesce(cost, 0) AS BIGINT) AS cost, coalesce(audit, '') AS audit, sha256(CASE WHEN coalesce(t, '') = '' THEN '' ELSE substr(t, 1, length(t) - 1) END) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) AS x LEFT JOIN n ON x.conv_id IS NOT DISTINCT FROM n.conv_id LEFT JOIN e ON x.conv_id IS NOT DISTINCT FROM e.conv_id
"""
