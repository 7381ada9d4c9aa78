"""Byte-level BPE by ranks, as recursive relational queries of DuckDB inside each partition.

A task splits its texts by the vocabulary's pattern. Words that are no token themselves become rows (word, position,
token), one a byte; a recursive query joins neighbours to the merge table and contracts each word's leftmost pair of
least rank until no pair is left. Known words keep their ids, so a partition asks once for each. An ordered
aggregation over (text, place, id) rows joined to the vocabulary gives the bytes back.
"""

from __future__ import annotations

import base64
import hashlib
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .support import documents, whole_text
from .token_counts import pieces

#: Words of more bytes are contracted at all places of the least rank in a round.
LONG = 64

#: Rows that the rounds of one recursive query may add up to, and bytes of short words in one query.
ROUND_ROWS, WORD_BYTES = 1 << 22, 1 << 19

#: Words that a task remembers, characters encoded at once, characters of a piece of a long text.
KNOWN, CHARS, PIECE = 1 << 20, 1 << 21, 1 << 18

#: A symbol: neither letter, number nor space.
STAND_IN = "▓"

LEFTMOST = """
WITH RECURSIVE s AS (
  SELECT word, pos, tok, 0 AS step FROM letters
  UNION ALL
  SELECT * FROM (
    WITH p AS (
      SELECT *, lead(tok) OVER w AS nxt, lead(pos) OVER w AS nxt_pos FROM s WINDOW w AS (ORDER BY word, pos)
    ), c AS (
      SELECT p.word, p.nxt_pos, (CAST(m.merged AS BIGINT) << 32) + p.pos AS place FROM p JOIN merges m ON m.l = p.tok AND m.r = p.nxt WHERE p.nxt_pos > p.pos AND p.step < $rounds
    ), b AS (
      SELECT word, min(place) AS best, arg_min(nxt_pos, place) AS gone FROM c GROUP BY word
    )
    SELECT s.word, s.pos, CASE WHEN s.pos = (b.best & 4294967295) THEN CAST(b.best >> 32 AS INTEGER) ELSE s.tok END, s.step + 1 FROM s JOIN b ON s.word = b.word WHERE s.pos <> b.gone
  )
)
SELECT s.word, s.pos, s.tok, false AS odd FROM s JOIN (SELECT word, max(step) AS last FROM s GROUP BY word) z ON s.word = z.word AND s.step = z.last ORDER BY s.word, s.pos
"""

#: As LEFTMOST, but a round contracts every pair of the least rank that a run from the left reaches without overlap. That is
#: the same as one after the other unless a pair that a contraction makes has a lower rank still; odd says that one had.
ALL_PLACES = """
WITH RECURSIVE s AS (
  SELECT word, pos, tok, false AS odd, 0 AS step FROM letters
  UNION ALL
  SELECT * FROM (
    WITH p AS (
      SELECT *, row_number() OVER w AS nth, lead(tok) OVER w AS nxt, lead(pos) OVER w AS nxt_pos, lag(tok) OVER w AS before, lead(tok, 2) OVER w AS after FROM s WINDOW w AS (PARTITION BY word ORDER BY pos)
    ), c AS (
      SELECT p.*, m.merged, min(m.merged) OVER (PARTITION BY word) AS least FROM p JOIN merges m ON m.l = p.tok AND m.r = p.nxt WHERE p.step < $rounds
    ), i AS (
      SELECT *, nth - row_number() OVER (PARTITION BY word ORDER BY nth) AS run FROM c WHERE merged = least
    ), k AS (
      SELECT *, row_number() OVER (PARTITION BY word, run ORDER BY nth) % 2 = 1 AS chosen FROM i
    ), b AS (
      SELECT word, pos, nxt_pos, k.merged, coalesce(x.merged < k.merged OR y.merged < k.merged OR z.merged < k.merged, false) AS lower FROM k
      LEFT JOIN merges x ON x.l = k.before AND x.r = k.merged LEFT JOIN merges y ON y.l = k.merged AND y.r = k.merged LEFT JOIN merges z ON z.l = k.merged AND z.r = k.after WHERE chosen
    ), g AS (
      SELECT word, bool_or(coalesce(lower, false)) AS lower FROM b GROUP BY word
    )
    SELECT s.word, s.pos, coalesce(b.merged, s.tok), s.odd OR g.lower, s.step + 1 FROM s JOIN g ON s.word = g.word LEFT JOIN b ON s.word = b.word AND s.pos = b.pos
    WHERE NOT EXISTS (SELECT 1 FROM b AS o WHERE o.word = s.word AND o.nxt_pos = s.pos)
  )
)
SELECT word, pos, tok, odd FROM (SELECT *, max(step) OVER (PARTITION BY word) AS last FROM s) WHERE step = last ORDER BY word, pos
"""

DECODE = "SELECT slot, string_agg(spelled, '' ORDER BY place) AS spelled FROM ids JOIN tokens ON tokens.id = ids.id GROUP BY slot ORDER BY slot"


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank of a file with one base64 token and rank a line."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


@lru_cache(maxsize=2)
def newer(pattern: str) -> dict[int, str]:
    """Characters that the pattern's library here takes for letters or numbers and tiktoken does not, because their tables
    of Unicode differ, with their replacement by a symbol.

    Only what Python's own table does not know yet can differ. A probe is one token of a vocabulary made for it where
    tiktoken sees one match."""
    import regex
    import tiktoken

    unknown = regex.findall(r"[\p{L}\p{N}]", "".join(c for c in map(chr, range(0x110000)) if unicodedata.category(c) == "Cn"))
    probes = [lead + c for c in unknown for lead in "a1"]
    ranks = {bytes([b]): b for b in range(256)} | {p.encode(): 256 + i for i, p in enumerate(probes)}
    probe = tiktoken.Encoding("probe", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    whole = [len(x) == 1 for x in probe.encode_ordinary_batch(probes, num_threads=1)]
    return {ord(c): STAND_IN for i, c in enumerate(unknown) if not whole[2 * i] and not whole[2 * i + 1]}


class RankTables:
    """A vocabulary of ranks as tables of one DuckDB connection, and the words it has encoded."""

    def __init__(self, path: str, pattern: str, memory: str = "512MB"):
        import duckdb
        import regex

        self.ranks = read_ranks(path)
        self.pattern = regex.compile(pattern)
        self.stand_ins = newer(pattern)
        self.strange = frozenset(map(chr, self.stand_ins))
        # Few texts hold a character from here on, which is looked at before any set.
        self.late = re.compile(f"[{min(self.strange, default=chr(0x10FFFF))}-\U0010ffff]")
        self.byte = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        # Nothing is spilled to the executor's own disk.
        self.con = duckdb.connect(config={"threads": 1, "memory_limit": memory, "temp_directory": ""})
        halves = [(self.ranks[t[:k]], self.ranks[t[k:]], i) for t, i in self.ranks.items() for k in range(1, len(t)) if t[:k] in self.ranks and t[k:] in self.ranks]
        self._table("merges", pa.table([pa.array(c, pa.int32()) for c in (zip(*halves) if halves else ([], [], []))], ["l", "r", "merged"]))
        # A byte is spelled as the character of its number, since strings can be aggregated in order.
        self._table("tokens", pa.table({"id": pa.array(self.ranks.values(), pa.int32()), "spelled": [t.decode("latin-1") for t in self.ranks]}))
        self._forget()

    def _table(self, name: str, rows: pa.Table) -> None:
        self.con.register("given", rows)
        self.con.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
        self.con.unregister("given")

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.ids, self.starts, self.lens, self.used = np.empty(1 << 16, np.int32), np.empty(1 << 12, np.int64), np.empty(1 << 12, np.int64), 0

    def split(self, text: str) -> list[str]:
        """The matches of the pattern as tiktoken sees them."""
        if self.late.search(text) and not self.strange.isdisjoint(text):
            return [text[m.start() : m.end()] for m in self.pattern.finditer(text.translate(self.stand_ins))]
        return self.pattern.findall(text)

    def _ask(self, query: str, letters: pa.Table, rounds: int) -> pa.Table:
        self.con.register("letters", letters)
        try:
            return self.con.sql(query.replace("$rounds", str(rounds))).to_arrow_table()
        finally:
            self.con.unregister("letters")

    def merged(self, words: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
        """(word number, id) rows in the order of words and places, as pairs of arrays for disjoint sets of words."""
        found = []
        short, size = [], 0
        for n, w in enumerate(words):
            if len(w) > LONG:
                found.append(self._long(n, w))
                continue
            short.append(n)
            size += len(w)
            if size >= WORD_BYTES:
                found.append(self._short(words, short))
                short, size = [], 0
        if short:
            found.append(self._short(words, short))
        return found

    def _short(self, words: list[bytes], which: list[int]) -> tuple[np.ndarray, np.ndarray]:
        data = np.frombuffer(b"".join(words[n] for n in which), np.uint8)
        lens = np.array([len(words[n]) for n in which])
        letters = pa.table({"word": np.repeat(np.array(which, np.int32), lens), "pos": (np.arange(len(data)) - np.repeat(np.cumsum(lens) - lens, lens)).astype(np.int32), "tok": self.byte[data]})
        out = self._ask(LEFTMOST, letters, LONG)
        return out["word"].to_numpy(), out["tok"].to_numpy()

    def _long(self, n: int, word: bytes, query: str = ALL_PLACES) -> tuple[np.ndarray, np.ndarray]:
        """A query runs as many rounds as the bound of rows allows; the next begins with what it leaves."""
        tok = self.byte[np.frombuffer(word, np.uint8)]
        while True:
            size = len(tok)
            letters = pa.table({"word": np.full(size, n, np.int32), "pos": np.arange(size, dtype=np.int32), "tok": tok})
            out = self._ask(query, letters, max(1, min(256, ROUND_ROWS // size)))
            tok = out["tok"].to_numpy()
            if size and out["odd"][0].as_py():
                return self._long(n, word, LEFTMOST)
            if len(tok) == size:
                return np.full(size, n, np.int32), tok

    def _learn(self, new: list[str]) -> None:
        """Put words with their ids into the memory; a word that is a token itself has that id, as in the library."""
        spelled = [w.encode() for w in new]
        parts = [(np.array([n for n, s in enumerate(spelled) if s in self.ranks], np.int64), np.array([self.ranks[s] for s in spelled if s in self.ranks], np.int32))]
        rest = [n for n, s in enumerate(spelled) if s not in self.ranks]
        number = np.array(rest, np.int64)
        parts += [(number[word], tok) for word, tok in self.merged([spelled[n] for n in rest])]
        for word, tok in parts:
            if not len(tok):
                continue
            first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            count, base = len(first), len(self.known)
            self._room(self.used + len(tok), base + count)
            self.ids[self.used : self.used + len(tok)] = tok
            self.starts[base : base + count] = self.used + first
            self.lens[base : base + count] = np.diff(np.r_[first, len(tok)])
            self.used += len(tok)
            for n in word[first].tolist():
                self.known[new[n]] = len(self.known)

    def _room(self, ids: int, words: int) -> None:
        if ids > len(self.ids):
            self.ids = np.resize(self.ids, 2 * ids)
        if words > len(self.starts):
            self.starts, self.lens = np.resize(self.starts, 2 * words), np.resize(self.lens, 2 * words)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, and how many each has."""
        split = [self.split(t) for t in texts]
        words = [w for s in split for w in s]
        distinct = set(words)
        if len(self.known) + len(distinct) > KNOWN:
            self._forget()
        new = [w for w in distinct if w not in self.known]
        if new:
            self._learn(new)
        place = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        lens = self.lens[place]
        ends = np.cumsum(lens)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.ids[np.arange(total) + np.repeat(self.starts[place] - ends + lens, lens)]
        sizes = np.array([len(s) for s in split], np.int64)
        bounds = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(sizes)])]
        return ids, np.diff(bounds)

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """The bytes of consecutive runs of ids; an id outside the vocabulary is an error, as in the library."""
        slot = np.repeat(np.arange(len(counts), dtype=np.int32), counts)
        rows = pa.table({"slot": slot, "place": np.arange(len(ids), dtype=np.int64), "id": ids.astype(np.int32)})
        known = np.fromiter(self.ranks.values(), np.int64)
        if len(ids) and not np.isin(np.unique(ids), known).all():
            raise KeyError("an id is not in the vocabulary")
        self.con.register("ids", rows)
        try:
            got = self.con.sql(DECODE).to_arrow_table()
        finally:
            self.con.unregister("ids")
        out = [b""] * len(counts)
        for s, text in zip(got["slot"].to_pylist(), got["spelled"].to_pylist(), strict=True):
            out[s] = text.encode("latin-1")
        return out


@lru_cache(maxsize=2)
def tables(path: str, pattern: str) -> RankTables:
    return RankTables(path, pattern)


def round_trip(docs: DataFrame, path: str | None = None, pattern: str | None = None, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) for each row of docs, and with_ids also ids and decoded (binary).

    Null and empty texts have no tokens and the hashes of nothing. The strings of special tokens are ordinary text.
    Texts of more than PIECE characters are encoded in pieces cut before a mark or space that follows a letter or number,
    which gives the same ids; a run of letters alone stays whole. Repeated rows are encoded each, from the words
    that the task remembers (KNOWN at most, then it starts anew). Only id and text are read; an empty table
    gives no rows.
    """
    path = path or default_vocabulary()
    if pattern is None:
        import public_tokenizers

        pattern = public_tokenizers.PATTERN

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tables(path, pattern)
        for b in batches:
            texts = b.column(1).to_pylist()
            counts = [0] * len(texts)
            ids_sha, text_sha = [hashlib.sha256() for _ in texts], [hashlib.sha256() for _ in texts]
            kept: list[list] = [[[], []] for _ in texts] if with_ids else []
            group: list[str] = []
            owners: list[int] = []

            def flush(bpe=bpe, group=group, owners=owners, counts=counts, ids_sha=ids_sha, text_sha=text_sha, kept=kept) -> None:
                ids, sizes = bpe.encode(group)
                at = 0
                for owner, size, spelled in zip(owners, sizes.tolist(), bpe.decode(ids, sizes), strict=True):
                    counts[owner] += size
                    own = ids[at : at + size]
                    ids_sha[owner].update(own.astype("<u4").tobytes())
                    text_sha[owner].update(spelled)
                    if kept:
                        kept[owner][0].append(own)
                        kept[owner][1].append(spelled)
                    at += size
                group.clear()
                owners.clear()

            held = 0
            for i, text in enumerate(texts):
                for piece in pieces(text, PIECE):
                    group.append(piece)
                    owners.append(i)
                    held += len(piece)
                    if held >= CHARS:
                        flush()
                        held = 0
            if group:
                flush()
            columns = [b.column(0), pa.array(counts, pa.int64()), pa.array([h.hexdigest() for h in ids_sha]), pa.array([h.hexdigest() for h in text_sha])]
            names = ["id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                columns += [pa.array([np.concatenate([np.empty(0, np.int32), *k[0]]) for k in kept], pa.list_(pa.int32())), pa.array([b"".join(k[1]) for k in kept], pa.binary())]
                names += ["ids", "decoded"]
            yield pa.record_batch(columns, names)

    rows = docs.select(F.col(id_col).alias("id"), whole_text(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    out = rows.mapInArrow(encoded, f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>, decoded binary" if with_ids else ""))
    return out.withColumnRenamed("id", id_col)


def op11_rank_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(documents(spark, sf_dir))
