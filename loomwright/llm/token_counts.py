"""Token counts without keeping ids.

An Arrow function returns lengths only. Texts longer than a piece are split at safe boundaries, the
pieces are gathered into batches of about equal bytes, and each batch is encoded at once. The byte-level
vocabulary is read from the tokenizers file; its merges run in tiktoken, which took 259 CPU seconds for
a GB of input where the tokenizers library took 1595, with equal counts (a test holds them together).
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .support import documents, whole_text

#: A letter or number before a mark or space: no token of the vocabularies here crosses it.
EDGE = re.compile(r"(?<=[^\W_])(?=[^\w])")


#: Characters before the end of a piece among which a boundary is looked for first.
LOOK_BACK = 4096


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def safe(text: str, cut: int, special: tuple[str, ...] = ()) -> bool:
    """Whether the text may be cut there: words of letters or numbers end before a mark or a space, whatever follows.

    The character after the cut has to be a known mark or space, in case a pattern knows newer letters; and no
    special token may span the cut."""
    after = text[cut]
    if not text[cut - 1].isalnum() or after not in " \t\r\n" and unicodedata.category(after)[0] not in "PSZ":
        return False
    return all(text.find(s, max(cut - len(s) + 1, 0), cut + len(s) - 1) < 0 for s in special)


def pieces(text: str, limit: int, special: tuple[str, ...] = ()) -> Iterator[str]:
    """The text in order, in pieces of at most limit characters where a safe boundary allows it; else the next boundary ends a piece."""
    start = 0
    while len(text) - start > limit:
        cut = next((i for i in range(start + limit, max(start, start + limit - LOOK_BACK), -1) if safe(text, i, special)), 0)
        cut = cut or next((m.start() for m in EDGE.finditer(text, start + limit) if m.start() < len(text) and safe(text, m.start(), special)), 0)
        if not cut:
            break
        yield text[start:cut]
        start = cut
    yield text[start:]


def _byte_of() -> dict[str, int]:
    """The printable stand-ins that byte-level vocabularies write for bytes."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@lru_cache(maxsize=4)
def counter(path: str):
    """A function from a list of texts to their token counts, as the library of the file gives them, and the strings of special tokens."""
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return (lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]), None
    import tiktoken

    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    split = spec["pre_tokenizer"]
    if spec["normalizer"] or spec["model"]["type"] != "BPE" or split["type"] != "ByteLevel" or split["add_prefix_space"] or not split["use_regex"]:
        raise ValueError(f"{path}: not a plain byte-level BPE file")
    import public_tokenizers

    back = _byte_of()
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    ranks = {bytes(back[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
    encoding = tiktoken.Encoding("counts", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)
    return (lambda texts: [len(x) for x in encoding.encode_batch(texts, num_threads=1, allowed_special="all", disallowed_special=())]), tuple(special)


def count_texts(texts: list[str], sizes: list[int], count, special: tuple[str, ...] | None, piece_chars: int, batch_bytes: int) -> list[int]:
    """Token counts of texts of known sizes in bytes, by batches of pieces. Without special (None), texts are not cut."""
    totals, batch, owners, held = [0] * len(texts), [], [], 0

    def flush() -> None:
        nonlocal held
        for owner, n in zip(owners, count(batch), strict=True):
            totals[owner] += n
        batch.clear()
        owners.clear()
        held = 0

    for i, text in enumerate(texts):
        cut = special is not None and len(text) > piece_chars
        for piece in pieces(text, piece_chars, special) if cut else (text,):
            batch.append(piece)
            owners.append(i)
            held += len(piece.encode()) if cut else sizes[i]
            if held >= batch_bytes:
                flush()
    if batch:
        flush()
    return totals


def token_counts(docs: DataFrame, path: str | None = None, limit: int = 512, id_col: str = "doc_id", text_col: str = "text", piece_chars: int = 1 << 16, batch_chars: int = 1 << 18) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) for each row of docs.

    Null and empty texts have no tokens. The strings of special tokens inside a text are special tokens,
    the library's default. Batches are balanced by UTF-8 bytes: a batch of pieces ends with the piece that
    brings it to batch_chars bytes (as many characters, in ASCII). Texts of more than piece_chars characters are
    counted piece by piece, so memory holds one batch's ids; only a run of letters alone, which is one word to the
    vocabulary, has no boundary and stays whole. Repeated rows are counted each. Only id and text are read; an
    empty table gives no rows.
    """
    path = path or default_vocabulary()

    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, special = counter(path)
        for b in batches:
            text = b.column(1)
            size = pc.cast(pc.binary_length(text), pa.int64())
            n = count_texts(text.to_pylist(), size.to_pylist(), count, special, piece_chars, batch_chars)
            yield pa.record_batch([b.column(0), size, pa.array(n, pa.int64())], ["id", "n_bytes", "n_tokens"])

    rows = docs.select(F.col(id_col).alias("id"), whole_text(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    counted = rows.mapInArrow(lengths, f"id {kind}, n_bytes long, n_tokens long")
    return counted.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(documents(spark, sf_dir))
