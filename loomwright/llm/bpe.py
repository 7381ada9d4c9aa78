"""BPE encoding and decoding through a minimal acyclic transducer lexicon.

The corpus's frequent words are compiled into one automaton with shared prefixes and suffixes; numbers
on its arcs add up to a word's place in a table of ready-made ids. The file lies in the shared folder,
Spark hands it to every executor, and tasks map it into memory. Words outside it are merged exactly, many
at once, by the vocabulary's own ranks.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .support import documents, local_file, publish, whole_text
from .textscan import U64, Table, Words, buffers, gathered, lower_words, released, row_blocks, span_hashes, within

NONE = np.int32(1 << 30)

#: Characters encoded at once (bytes, of texts made from a column), ids decoded at once, and words hashed or compared at once.
CHARS, IDS, SPANS = 1 << 20, 1 << 18, 1 << 16
GAP = re.compile(r"[\x20\x09-\x0D]")


def cut(text: str, limit: int) -> Iterator[str]:
    """The text in order, in pieces of at most limit characters where white space allows it; else the next white space ends a piece.

    Pieces but the first begin with ASCII white space: no word and no special token holds it, and it joins no letter when
    a text is normalised, so the ids of the pieces one after another are those of the text."""
    start = 0
    while len(text) - start > limit:
        to = max(text.rfind(c, start + 1, start + limit + 1) for c in " \n\t")
        if to < 0:
            later = GAP.search(text, start + limit + 1)
            if not later:
                break
            to = later.start()
        yield text[start:to]
        start = to
    yield text[start:]


def runs(column: pa.Array, limit: int = CHARS) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) of runs of rows of about limit bytes, one row at least: a batch's texts are never Python strings all at once."""
    for a, b in row_blocks(buffers(column)[1], limit):
        yield a, column.slice(a, b - a).to_pylist()


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class Vocabulary:
    """A word-level BPE file of the tokenizers library: byte symbols, word ends, ranked merges, no decoder."""

    def __init__(self, path: str):
        spec = json.loads(open(path, encoding="utf-8").read())
        model = spec["model"]
        if model["type"] != "BPE" or model["end_of_word_suffix"] != "</w>" or model["ignore_merges"] or spec["decoder"] or len(model["vocab"]) + len(spec["added_tokens"]) > 1 << 16:
            raise ValueError(f"{path}: not a word-level BPE file without decoder and with ids of 16 bits")
        from .token_counts import _byte_of

        vocab, end = model["vocab"], model["end_of_word_suffix"]
        symbol = {b: c for c, b in _byte_of().items()}
        self.path = path
        self.inner = np.array([vocab[symbol[b]] for b in range(256)], np.int32)
        self.final = np.array([vocab[symbol[b] + end] for b in range(256)], np.int32)
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int32)
        self.table = Table.build((left << 16 | right).astype(U64))
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        names = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        spelled = [(names.get(i, "") + " ").encode() for i in range(max(names) + 1)]
        self.name_lens = np.array([len(s) for s in spelled], np.int64)
        self.name_starts = np.cumsum(self.name_lens) - self.name_lens
        self.names = np.frombuffer(b"".join(spelled), np.uint8)

    @property
    def library(self):
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(self.path)
        tok.no_truncation()
        tok.no_padding()
        return tok

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of merging each pair, NONE where there is no merge or no symbol."""
        keys = (left.astype(np.int64) << 16 | (right.astype(np.int64) & 0xFFFF)).astype(U64)
        got = self.table.find(keys).astype(np.int32)
        got[(got < 0) | (left < 0) | (right < 0)] = NONE
        return got

    def merge(self, data: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Exact BPE of words given by their bytes: all ids in word order, and how many each word has."""
        n = len(starts)
        counts = np.ones(n, np.int64)
        found: list[tuple[np.ndarray, np.ndarray]] = []
        order = np.argsort(lens, kind="stable")
        at = 0
        while at < n:
            longest = int(lens[order[at]])
            if longest > 256:
                break
            # Words of like length side by side, so that little is padded.
            to = int(np.searchsorted(lens[order], longest + max(1, longest // 4), "right"))
            for a in range(at, to, 1 << 15):
                self._merge_rows(data, starts, lens, order[a : min(to, a + (1 << 15))], found)
            at = to
        for w in order[at:]:
            ids = self._merge_long(data[starts[w] : starts[w] + lens[w]])
            found.append((np.array([w]), np.array([ids], np.int32)))
        for who, ids in found:
            counts[who] = ids.shape[1]
        firsts = np.cumsum(counts) - counts
        out = np.empty(int(counts.sum()), np.int32)
        for who, ids in found:
            out[firsts[who][:, None] + np.arange(ids.shape[1])] = ids
        return out, counts

    def _merge_rows(self, data, starts, lens, rows, found) -> None:
        size = lens[rows]
        width = int(size.max())
        cols = np.arange(width)
        at = starts[rows][:, None] + np.minimum(cols, size[:, None] - 1)
        raw = data[at]
        sym = np.where(cols == size[:, None] - 1, self.final[raw], self.inner[raw])
        sym[cols >= size[:, None]] = -1
        rank = self.ranks(sym[:, :-1].ravel(), sym[:, 1:].ravel()).reshape(len(rows), width - 1)
        while True:
            if not sym.shape[1] - 1:
                self._finish(rows, size, sym, found)
                return
            best = rank.argmin(1)
            low = rank[np.arange(len(rows)), best]
            more = low < NONE
            if not more.all():
                self._finish(rows[~more], size[~more], sym[~more], found)
                rows, size, sym, rank, best, low = rows[more], size[more], sym[more], rank[more], best[more], low[more]
                if not len(rows):
                    return
            # Each row left merges one pair, so all get narrower by one.
            each, width = np.arange(len(rows)), sym.shape[1] - 1
            sym = sym[np.arange(width + 1) != best[:, None] + 1].reshape(len(rows), width)
            sym[each, best] = self.merged[low]
            rank = rank[np.arange(width) != best[:, None]].reshape(len(rows), width - 1)
            size = size - 1
            if width > 1:
                near = np.flatnonzero(best > 0)
                rank[near, best[near] - 1] = self.ranks(sym[near, best[near] - 1], sym[near, best[near]])
                near = np.flatnonzero(best < width - 1)
                rank[near, best[near]] = self.ranks(sym[near, best[near]], sym[near, best[near] + 1])

    @staticmethod
    def _finish(rows, size, sym, found) -> None:
        for k in np.unique(size):
            mine = size == k
            found.append((rows[mine], sym[mine, :k]))

    def _merge_long(self, raw: np.ndarray) -> list[int]:
        """One long word: pairs in a heap by rank, then place."""
        n = len(raw)
        sym = self.inner[raw].tolist()
        sym[-1] = int(self.final[raw[-1]])
        after, ahead = list(range(1, n + 1)), list(range(-1, n - 1))
        arr = np.array(sym, np.int32)
        first = self.ranks(arr[:-1], arr[1:]).tolist()
        heap = [(r, i, sym[i], sym[i + 1]) for i, r in enumerate(first) if r < NONE]
        heapq.heapify(heap)

        def push(i: int) -> None:
            j = after[i]
            if j < n:
                r = int(self.ranks(np.array([sym[i]]), np.array([sym[j]]))[0])
                if r < NONE:
                    heapq.heappush(heap, (r, i, sym[i], sym[j]))

        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i]
            if sym[i] != a or j >= n or sym[j] != b:
                continue
            sym[i], sym[j] = int(self.merged[r]), -1
            after[i] = after[j]
            if after[j] < n:
                ahead[after[j]] = i
            push(i)
            if ahead[i] >= 0:
                push(ahead[i])
        return [s for s in sym if s >= 0]

    def spelled(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of the tokens, each with a space after it."""
        out, at = np.empty(int(self.name_lens[ids].sum()), np.uint8), 0
        for i in range(0, len(ids), SPANS):
            part = ids[i : i + SPANS]
            run = gathered(self.names, self.name_starts[part], self.name_lens[part])
            out[at : at + len(run)] = run
            at += len(run)
        return out

    def decoded(self, ids: np.ndarray) -> Iterator[bytes]:
        """The tokens with a space between, in parts."""
        for i in range(0, len(ids), IDS):
            part = self.spelled(ids[i : i + IDS]).tobytes()
            yield part if i + IDS < len(ids) else part[:-1]


class Lexicon:
    """A minimal acyclic automaton over word bytes, read from a mapped file."""

    FIELDS = ("slots", "rows", "target", "skip", "final", "ids", "starts", "lens")

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.arcs = Table(arrays["slots"], arrays["rows"])
        self.target, self.skip, self.final = arrays["target"], arrays["skip"], arrays["final"]
        self.ids, self.starts, self.lens = arrays["ids"], arrays["starts"], arrays["lens"]

    @staticmethod
    def compiled(words: list[bytes], vocab: Vocabulary) -> bytes:
        """The file for a set of words: incremental minimisation over the sorted words, then numbered arcs."""
        words = sorted({w for w in words if w})
        nodes: list[dict[int, int]] = [{}]
        accepts = [False]
        register: dict[tuple, int] = {}
        path: list[tuple[int, int, int]] = []  # (parent, byte, child) of the last word

        def settle(down_to: int) -> None:
            while len(path) > down_to:
                parent, byte, child = path.pop()
                key = (accepts[child], *nodes[child].items())
                same = register.setdefault(key, child)
                if same != child:
                    nodes[parent][byte] = same

        last = b""
        for word in words:
            shared = 0
            while shared < min(len(word), len(last)) and word[shared] == last[shared]:
                shared += 1
            settle(shared)
            at = path[-1][2] if path else 0
            for byte in word[shared:]:
                nodes.append({})
                accepts.append(False)
                nodes[at][byte] = len(nodes) - 1
                path.append((at, byte, len(nodes) - 1))
                at = len(nodes) - 1
            accepts[at] = True
            last = word
        settle(0)
        number, queue = {0: 0}, [0]
        for node in queue:
            for child in nodes[node].values():
                if child not in number:
                    number[child] = len(queue)
                    queue.append(child)
        held: dict[int, int] = {}  # how many words end at or below a node

        def below(node: int) -> int:
            if node not in held:
                held[node] = accepts[node] + sum(below(c) for c in nodes[node].values())
            return held[node]

        below(0)
        keys, target, skip = [], [], []
        for node in reversed(queue):
            below(node)
        for node in queue:
            passed = int(accepts[node])
            for byte, child in nodes[node].items():
                keys.append(number[node] << 8 | byte)
                target.append(number[child])
                skip.append(passed)
                passed += held[child]
        table = Table.build(np.array(keys, U64))
        lens = np.array([len(w) for w in words], np.int64)
        ids, counts = vocab.merge(np.frombuffer(b"".join(words), np.uint8), np.cumsum(lens) - lens, lens) if words else (np.zeros(0, np.int32), np.zeros(0, np.int64))
        arrays = {
            "slots": table.slots, "rows": table.rows, "target": np.array(target, np.int32), "skip": np.array(skip, np.int32),
            "final": np.array([accepts[n] for n in queue], np.bool_), "ids": ids, "starts": np.cumsum(counts) - counts, "lens": counts,
        }
        head, body, at = {}, [], 0
        for name, a in arrays.items():
            raw = a.tobytes() + b"\0" * (-a.nbytes % 64)
            head[name] = [a.dtype.str, len(a), at]
            body.append(raw)
            at += len(raw)
        text = json.dumps(head).encode()
        text += b" " * (-(len(text) + 8) % 64)
        return len(text).to_bytes(8, "little") + text + b"".join(body)

    @classmethod
    def opened(cls, path: str) -> Lexicon:
        file = np.asarray(np.memmap(path, np.uint8, "r"))
        size = int.from_bytes(file[:8].tobytes(), "little")
        head = json.loads(file[8 : 8 + size].tobytes())
        arrays = {}
        for name, (kind, n, at) in head.items():
            kind = np.dtype(kind)
            arrays[name] = file[8 + size + at : 8 + size + at + n * kind.itemsize].view(kind)
        return cls(arrays)

    def find(self, data: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
        """The place of each word in the lexicon, -1 for others. All words step through the automaton together."""
        order = np.argsort(-lens, kind="stable")
        place, state = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
        if not len(self.target):
            return place - 1
        alive, sorted_lens = order, -lens[order]
        for k in range(int(lens.max()) if len(lens) else 0):
            longer = int(np.searchsorted(sorted_lens, -k, "left"))  # words of more than k bytes
            if not longer:
                break
            now = alive[:longer]
            arc = self.arcs.find((state[now] << 8 | data[starts[now] + k]).astype(U64))
            ok = arc >= 0
            here, arc = now[ok], arc[ok]
            state[here] = self.target[arc]
            place[here] += self.skip[arc]
            place[now[~ok]] = -1
            keep = np.ones(len(alive), bool)
            keep[:longer] = ok
            alive, sorted_lens = alive[keep], sorted_lens[keep]
        place[(place >= 0) & ~self.final[state]] = -1
        return place


def unlike(w: Words, other: np.ndarray) -> np.ndarray:
    """Which words differ in their bytes from the word of the number given for each."""
    found = []
    for a in range(0, len(other), SPANS):
        starts, twins = w.starts[a : a + SPANS], w.starts[other[a : a + SPANS]]
        lens, theirs = w.ends[a : a + SPANS] - starts, w.ends[other[a : a + SPANS]] - twins
        odd = lens != theirs
        mine = np.flatnonzero(~odd & (starts != twins))
        size = lens[mine]
        at = np.repeat(starts[mine], size) + within(size)
        wrong = w.data[at] != w.data[at + np.repeat(twins[mine] - starts[mine], size)]
        if wrong.any():
            odd[mine[np.repeat(np.arange(len(mine)), size)[wrong]]] = True
        found.append(np.flatnonzero(odd) + a)
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def hashed(w: Words) -> np.ndarray:
    """The words' hashes, by slices, so that little is held a character."""
    hashes = np.empty(len(w.starts), U64)
    for i in range(0, len(hashes), SPANS):
        hashes[i : i + SPANS] = span_hashes(w.data, w.starts[i : i + SPANS], w.ends[i : i + SPANS])
    return hashes


class Encoder:
    """Texts to ids: words of a batch, each distinct word once through the lexicon or the merges.

    Hashes bring equal words together, and bytes decide: a word that differs from the first of its hash is one of its own."""

    def __init__(self, vocab: Vocabulary, lexicon: Lexicon | None):
        self.vocab, self.lexicon = vocab, lexicon

    def distinct(self, w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(ids of the distinct words, their starts and counts, for each word the number of its distinct word)."""
        _, first, which = np.unique(hashed(w), return_index=True, return_inverse=True)
        others: dict[bytes, int] = {}
        for i in unlike(w, first[which]).tolist():
            word = w.data[w.starts[i] : w.ends[i]].tobytes()
            if word not in others:
                others[word] = len(first)
                first = np.append(first, i)
            which[i] = others[word]
        starts = w.starts[first]
        lens = w.ends[first] - starts
        counts, begin = np.zeros(len(first), np.int64), np.zeros(len(first), np.int64)
        known = self.lexicon.find(w.data, starts, lens) if self.lexicon else np.full(len(first), -1)
        hit, new = np.flatnonzero(known >= 0), np.flatnonzero(known < 0)
        ids = np.zeros(0, np.int32)
        if len(hit):
            at = known[hit]
            counts[hit] = self.lexicon.lens[at]
            ids = gathered(self.lexicon.ids, self.lexicon.starts[at], counts[hit])
            begin[hit] = np.cumsum(counts[hit]) - counts[hit]
        if len(new):
            more, n = self.vocab.merge(w.data, starts[new], lens[new])
            counts[new] = n
            begin[new] = len(ids) + np.cumsum(n) - n
            ids = np.concatenate((ids, more))
        return ids, begin, counts, which

    def plain(self, text: str) -> bool:
        """Without the string of a special token, which the library cuts out before anything else."""
        return "<|" not in text or not any(s in text for s in self.vocab.special)

    def encoded(self, texts: list[str], chars: int = CHARS) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """For each run of texts of about so many characters: (first, last, all ids, the place of each text's first id).

        A longer text is a run of its own, encoded piece by piece, so that only its ids are held whole."""
        at = 0
        while at < len(texts):
            if len(texts[at]) > chars:
                ids = np.concatenate([self.batch([piece])[0] for piece in cut(texts[at], chars)])
                yield at, at + 1, ids, np.array([0, len(ids)])
                at += 1
                continue
            to, held = at, 0
            while to < len(texts) and (held == 0 or held + len(texts[to]) <= chars):
                held += max(1, len(texts[to]))
                to += 1
            yield at, to, *self.batch(texts[at:to])
            at = to

    def encoded_rows(self, column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """As encoded, of a text column without nulls."""
        for at, texts in runs(column):
            for first, last, ids, bounds in self.encoded(texts):
                yield at + first, at + last, ids, bounds

    def batch(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        odd = [i for i, t in enumerate(texts) if not self.plain(t)]
        w = lower_words(["" if i in odd else t for i, t in enumerate(texts)] if odd else texts)
        ids, begin, counts, which = self.distinct(w)
        n = counts[which]
        flat = gathered(ids, begin[which], n)
        bounds = np.concatenate(([0], np.cumsum(n)))[w.before]
        if odd:
            library = self.vocab.library
            rows = [flat[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            for i in odd:
                rows[i] = np.array(library.encode(texts[i], add_special_tokens=False).ids, np.int32)
            flat = np.concatenate(rows)
            bounds = np.concatenate(([0], np.cumsum([len(r) for r in rows])))
        return flat, bounds


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


@lru_cache(maxsize=2)
def encoder(path: str, lexicon: str | None) -> Encoder:
    """The encoder of a Python worker, made once."""
    return Encoder(vocabulary(path), Lexicon.opened(local_file(lexicon)) if lexicon else None)


def frequent_words(docs: DataFrame, text_col: str = "text", size: int = 1 << 16, per_task: int = 1 << 15) -> list[bytes]:
    """The most frequent words over all texts, at most `size`.

    Every task counts all its words; what it holds and what it returns is bounded (words seen once in a run of a
    million bytes are not carried on). Which words come out changes the speed of encoding, never its result.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for b in batches:
            for _, texts in runs(b.column(0)):
                w = lower_words(texts)
                _, first, n = np.unique(hashed(w), return_index=True, return_counts=True)
                often = n > 1
                raw = w.data.tobytes()
                for s, e, c in zip(w.starts[first[often]].tolist(), w.ends[first[often]].tolist(), n[often].tolist(), strict=True):
                    if e - s <= 32:
                        total[raw[s:e]] += c
                if len(total) > 8 * per_task:
                    total = Counter(dict(total.most_common(4 * per_task)))
        top = total.most_common(per_task)
        yield pa.record_batch([pa.array([w for w, _ in top], pa.binary()), pa.array([c for _, c in top], pa.int64())], ["word", "n"])

    counted = docs.select(whole_text(text_col).alias("text")).mapInArrow(released(count), "word binary, n long")
    top = counted.groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word").limit(size)
    return [bytes(r["word"]) for r in top.collect()]


def lexicon_for(docs: DataFrame, text_col: str = "text", path: str | None = None, size: int = 1 << 16) -> str:
    """Count, compile and publish the lexicon of a corpus; the name of the published file."""
    words = frequent_words(docs, text_col, size)
    return publish(docs.sparkSession, Lexicon.compiled(words, vocabulary(path or default_vocabulary())), "lexicon")


def encode(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text", lexicon: str | None = None) -> DataFrame:
    """(id, ids array<int>): each text as the vocabulary encodes it. Null and empty texts have no ids."""
    path = path or default_vocabulary()
    lexicon = lexicon or lexicon_for(docs, text_col, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path, lexicon)
        for b in batches:
            for first, last, ids, bounds in coder.encoded_rows(b.column(1)):
                yield pa.record_batch([b.column(0)[first:last], pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32()))], ["id", "ids"])

    rows = docs.select(F.col(id_col).alias("id"), whole_text(text_col).alias("text"))
    return rows.mapInArrow(released(run), f"id {rows.schema['id'].dataType.simpleString()}, ids array<int>").withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, path: str | None = None, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, text): the tokens of each id list, special ones too, with a space between. Null and empty lists give the empty text."""
    path = path or default_vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        for b in batches:
            lists = b.column(1)
            texts = [b"".join(vocab.decoded(np.asarray(x.values, np.int64))).decode() if x.is_valid else "" for x in lists]
            yield pa.record_batch([b.column(0), pa.array(texts, pa.string())], ["id", "text"])

    rows = encoded.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))
    return rows.mapInArrow(released(run), f"id {rows.schema['id'].dataType.simpleString()}, text string").withColumnRenamed("id", id_col)


def round_trip(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text", lexicon: str | None = None, with_ids: bool = False) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256, on demand ids) for each row of docs: ids as little-endian unsigned 32-bit integers,
    the decoded text in UTF-8. Null and empty texts have no ids. Repeated rows come out each. Only id and text are read;
    an empty table gives no rows. Encoding takes about 60 bytes a character, of at most `CHARS` characters at once: longer
    texts go in pieces cut at white space, and only one without any white space is encoded whole."""
    path = path or default_vocabulary()
    lexicon = lexicon or lexicon_for(docs, text_col, path)
    names = ["id", "n_tokens", "ids_sha256", "decoded_sha256", *["ids"] * with_ids]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path, lexicon)
        for b in batches:
            for first, last, ids, bounds in coder.encoded_rows(b.column(1)):
                wide = ids.astype("<u4")
                a = [hashlib.sha256(wide[s:e]).hexdigest() for s, e in zip(bounds[:-1], bounds[1:], strict=True)]
                if last - first == 1:
                    whole = hashlib.sha256()
                    for part in coder.vocab.decoded(ids):
                        whole.update(part)
                    d = [whole.hexdigest()]
                else:
                    sizes = np.concatenate(([0], np.cumsum(coder.vocab.name_lens[ids])))[bounds]
                    spelled = coder.vocab.spelled(ids)
                    d = [hashlib.sha256(spelled[s : max(s, e - 1)]).hexdigest() for s, e in zip(sizes[:-1], sizes[1:], strict=True)]
                columns = [b.column(0)[first:last], pa.array(np.diff(bounds), pa.int64()), pa.array(a), pa.array(d)]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32())))
                yield pa.record_batch(columns, names)

    rows = docs.select(F.col(id_col).alias("id"), whole_text(text_col).alias("text"))
    return rows.mapInArrow(released(run), f"id {rows.schema['id'].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string{', ids array<int>' * with_ids}").withColumnRenamed("id", id_col)


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(documents(spark, sf_dir))
