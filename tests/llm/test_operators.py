"""Operators against brute force, on texts with nulls, ties, repeats, long ones and clashing columns."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest

from loomwright.llm import bpe, exact_dedup, fingerprints, language_model, license_scan, mixing, ngram_join, token_counts, token_files, toxicity
from loomwright.llm.support import documents  # noqa: F401

ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(t):
    return re.findall(r"[^\x20\x09-\x0d]+", (t or "").translate(ASCII_LOWER))


def library(name):
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(name))


def by_id(df):
    out = defaultdict(list)
    for r in df.collect():
        out[r["doc_id"]].append(r)
    return out


ALL = {
    "fingerprints": fingerprints.fingerprinted, "language_model": language_model.scored, "license_scan": license_scan.scan, "bpe": bpe.round_trip,
    "ngram_join": ngram_join.near_groups, "token_counts": token_counts.token_counts, "token_files": token_files.token_files, "mixing": mixing.mixture,
    "exact_dedup": exact_dedup.decisions,
}


@pytest.mark.parametrize("name", ALL)
def test_empty_table_and_null_ids(name, nothing, odd_ids):
    assert ALL[name](nothing).count() == 0
    out = ALL[name](odd_ids).collect()
    assert len(out) == odd_ids.count()
    assert sum(r["doc_id"] is None for r in out) == 2


def test_exact_dedup(docs, rows):
    norm = {r[0]: re.sub(r"[\x20\x09-\x0d]", "", r[1] or "") for r in rows}
    n = {r[0]: len(r[1] or "") for r in rows}
    groups = defaultdict(list)
    for r in rows:
        groups[norm[r[0]]].append(r[0])
    got = by_id(exact_dedup.decisions(docs))
    for i in norm:
        keep = min(groups[norm[i]], key=lambda j: (-n[j], j))
        for r in got[i]:
            assert (r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) == (keep, len(groups[norm[i]]), keep == i, hashlib.sha256(norm[i].encode()).hexdigest())
    left = exact_dedup.deduplicated(docs)
    assert left.columns == docs.columns
    assert sorted(r["doc_id"] for r in left.collect()) == sorted({min(g, key=lambda j: (-n[j], j)) for g in groups.values()})


def test_exact_dedup_weak_hash_keeps_texts_apart(docs):
    from pyspark.sql import functions as F

    strong = {(r["doc_id"], r["keep_id"], r["group_size"]) for r in exact_dedup.decisions(docs).collect()}
    weak = exact_dedup.decisions(docs, hash_of=lambda t: F.substring(F.md5(t), 1, 1))
    assert {(r["doc_id"], r["keep_id"], r["group_size"]) for r in weak.collect()} == strong


def test_exact_dedup_of_text_ids_and_any_column_names(docs, rows):
    named = docs.withColumn("doc_id", docs["doc_id"].cast("string")).withColumnsRenamed({"h": "_sha", "id": "row", "n": "best"})
    size = {r[0]: len(r[1] or "") for r in rows}
    groups = defaultdict(set)
    for r in rows:
        groups[re.sub(r"[\x20\x09-\x0d]", "", r[1] or "")].add(r[0])
    want = sorted(min(map(str, {j for j in g if size[j] == max(size[i] for i in g)})) for g in groups.values())
    for hash_of in (exact_dedup.content_hash, lambda t: t.substr(1, 1)):
        assert sorted({r["doc_id"] for r in exact_dedup.decisions(named, hash_of=hash_of).where("kept").collect()}) == want
    left = exact_dedup.deduplicated(named)
    assert left.columns == named.columns and sorted(r["doc_id"] for r in left.collect()) == want


def test_ngram_join(docs, rows):
    sets = {}
    for r in rows:
        w = words(r[1])
        sets[r[0]] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if sets[a] and sets[b] and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
            parent[max(find(a), find(b))] = min(find(a), find(b))
    got = by_id(ngram_join.near_groups(docs))
    for i, s in sets.items():
        for r in got[i]:
            assert (r["n_shingles"], r["component_id"]) == (len(s), find(i))


def test_ngram_join_frequent_columns_and_chains(spark):
    """Many rows that share most n-grams without being near, and a chain whose ends are not near each other."""
    common = " ".join(f"c{k}" for k in range(60))
    texts = [(i, " ".join(f"u{i}x{k}" for k in range(40)) + " " + common) for i in range(120)]
    chain = [f"w{k}" for k in range(200)]
    texts += [(1000 + j, " ".join(chain[: 120 + 12 * j])) for j in range(7)]
    texts += [(2000 + i, common + f" z{i}") for i in range(90)]
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.near_groups(spark.createDataFrame(texts, "doc_id long, text string").repartition(5)).collect()}
    assert all(got[i] == i for i in range(120))
    assert {got[1000 + j] for j in range(7)} == {1000}
    assert {got[2000 + i] for i in range(90)} == {2000}


def test_ngram_parts():
    r = np.random.default_rng(1)
    for _ in range(200):
        a = np.unique(r.integers(0, 2**63, r.integers(1, 80)).astype(np.uint64))
        b = np.unique(np.concatenate([r.choice(a, max(1, int(len(a) * 0.9)), replace=False), r.integers(0, 2**63, r.integers(0, 6)).astype(np.uint64)]))
        x, y = ngram_join.signature(a), ngram_join.signature(b)
        differ = sum(((p ^ q) & (2**64 - 1)).bit_count() for p, q in zip(x, y, strict=True))
        assert differ <= len(set(a.tolist()) ^ set(b.tolist()))
        both = len(np.intersect1d(a, b))
        if 5 * both >= 4 * (len(a) + len(b) - both):
            none = np.zeros(1 << ngram_join.MAP_BITS - 3, np.uint8)
            assert len(np.intersect1d(ngram_join.prefix_of(a, none), ngram_join.prefix_of(b, none)))


def test_ngram_signatures_of_other_lengths():
    r = np.random.default_rng(2)
    for n in (100, 130, 700, 5000):
        a = np.unique(r.integers(0, 2**63, n).astype(np.uint64))
        for b in (a[: n // 5], a[3:], np.union1d(a, r.integers(0, 2**63, 3 * n).astype(np.uint64))):
            x, y = (np.array(ngram_join.signature(s), np.int64) for s in (a, b))
            assert ngram_join.differing(x, y) == ngram_join.differing(y, x) <= len(np.setxor1d(a, b))
    assert ngram_join.differing(x, x) == 0


def test_token_counts(docs, rows):
    tok = library("byte_bpe_50k.json")
    got = by_id(token_counts.token_counts(docs, piece_chars=500, batch_chars=2000))
    for r in rows:
        n = len(tok.encode(r[1] or "", add_special_tokens=False).ids)
        for g in got[r[0]]:
            assert (g["n_bytes"], g["n_tokens"], g["over_limit"]) == (len((r[1] or "").encode()), n, n > 512)


def test_pieces_are_whole_and_safe():
    text = "ab cd\n\nef  gh, don't <|endoftext|> x" * 50
    found = list(token_counts.pieces(text, 64))
    assert "".join(found) == text and len(found) > 10


def test_pieces_of_any_script_keep_the_counts():
    """Texts without ASCII or without spaces are cut too, and counts stay the library's; special tokens stay whole."""
    import random

    tok, r = library("byte_bpe_50k.json"), random.Random(6)
    count, special = token_counts.counter(token_counts.default_vocabulary())
    scripts = ["привет мир, ", "世界。你好、", "été déjà — ", "don't 12½ ", "a_b'll  x\n\n", "<|endoftext|>x", "שלום ", "नमस्ते, ", "e\u0301! "]
    for _ in range(40):
        text = "".join(r.choice(scripts) for _ in range(300))
        found = list(token_counts.pieces(text, 50, special))
        assert "".join(found) == text and max(map(len, found)) < 200
        assert sum(count(found)) == len(tok.encode(text, add_special_tokens=False).ids)
    for text in ("привет мир " * 3000, "世界。" * 5000):
        assert len(list(token_counts.pieces(text, 1 << 12))) >= 4


def test_bpe_round_trip_and_lexicon(docs, rows):
    tok = library("word_bpe_49k.json")
    want = {r[0]: tok.encode(r[1] or "", add_special_tokens=False).ids for r in rows}
    got = by_id(bpe.round_trip(docs, with_ids=True))
    for i, ids in want.items():
        text = tok.decode(ids, skip_special_tokens=False)
        for g in got[i]:
            assert g["ids"] == ids and g["n_tokens"] == len(ids)
            assert g["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
            assert g["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    back = by_id(bpe.decode(bpe.encode(docs)))
    assert all(g["text"] == tok.decode(ids, skip_special_tokens=False) for i, ids in want.items() for g in back[i])


def test_lexicon_is_minimal_and_complete(tmp_path):
    vocab = bpe.vocabulary(bpe.default_vocabulary())
    some = [w.encode() for w in ("walk", "walks", "walked", "talk", "talks", "talked", "é", "a")]
    path = tmp_path / "lexicon.bin"
    path.write_bytes(bpe.Lexicon.compiled(some, vocab))
    lexicon = bpe.Lexicon.opened(str(path))
    asked = [*some, b"wal", b"walke", b"x", b"talkss"]
    data = np.frombuffer(b"".join(asked), np.uint8)
    lens = np.array([len(w) for w in asked])
    got = lexicon.find(data, np.cumsum(lens) - lens, lens)
    assert sorted(got[: len(some)]) == list(range(len(some))) and (got[len(some) :] == -1).all()
    assert len(lexicon.final) < sum(map(len, some)) / 2  # suffixes are shared


def test_bpe_fuzz():
    import random

    tok, coder, r = library("word_bpe_49k.json"), bpe.Encoder(bpe.vocabulary(bpe.default_vocabulary()), None), random.Random(2)
    alphabet = "ab'stremvld \n1٣½éΣς́.,!-_—  \x1f𝔸ǅʼﬀ日"
    texts = ["".join(r.choice(alphabet) for _ in range(r.randrange(50))) for _ in range(1500)] + ["ab" * 700, "'s's't'll'", "don’t", ""]
    ids, bounds = coder.batch(texts)
    for i, t in enumerate(texts):
        assert ids[bounds[i] : bounds[i + 1]].tolist() == tok.encode(t, add_special_tokens=False).ids, t


def test_bpe_tells_words_of_one_hash_apart(monkeypatch):
    import random

    tok, r = library("word_bpe_49k.json"), random.Random(3)
    few = bpe.span_hashes
    monkeypatch.setattr(bpe, "span_hashes", lambda *a: few(*a) % np.uint64(5))
    coder = bpe.Encoder(bpe.vocabulary(bpe.default_vocabulary()), None)
    texts = [" ".join(r.choice(["walk", "wall", "walks", "é", "e", "12", "a-b"]) for _ in range(30)) for _ in range(20)]
    ids, bounds = coder.batch(texts)
    for i, t in enumerate(texts):
        assert ids[bounds[i] : bounds[i + 1]].tolist() == tok.encode(t, add_special_tokens=False).ids, t


def test_bpe_long_texts_go_in_pieces():
    import random

    tok, coder, r = library("word_bpe_49k.json"), bpe.Encoder(bpe.vocabulary(bpe.default_vocabulary()), None), random.Random(4)
    some = ["don't ", "Σας", " e\u0301", " \u0301x", "'s", "\n\n", "\t'll", "<|endoftext|>", "<|endof", " text|>", "\x1f", "\u3000", "\xa0", "ab12 ", "x" * 40]
    texts = ["".join(r.choice(some) for _ in range(r.randrange(200))) for _ in range(60)] + ["x" * 500, " " * 300, "y " + "z" * 200, ""]
    for t in texts:
        found = list(bpe.cut(t, 50))
        assert "".join(found) == t and all(p and p[0] in " \t\n\r\x0b\x0c" for p in found[1:])
    assert len(list(bpe.cut("ab " * 100, 50))) >= 6
    for first, last, ids, bounds in coder.encoded(texts, chars=50):
        for i in range(first, last):
            mine = ids[bounds[i - first] : bounds[i - first + 1]]
            assert mine.tolist() == tok.encode(texts[i], add_special_tokens=False).ids, texts[i]
            assert b"".join(coder.vocab.decoded(mine)).decode() == tok.decode(mine.tolist(), skip_special_tokens=False)


def test_token_files(docs, rows, spark):
    tok = library("word_bpe_49k.json")
    got = by_id(token_files.token_files(docs, length=16))
    at = 0
    for r in sorted(rows, key=lambda r: (r[0], r[1] or "")):
        ids = tok.encode(r[1] or "", add_special_tokens=False).ids + [2]
        assert any((g["start"], g["n_tokens"], g["ids_crc32"]) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) for g in got[r[0]])
        at += len(ids)
    folder, parts = token_files.write(docs, length=16, files=1)
    file = token_files.SequenceFile(*[(fs, f"{base}/{token_files.file_name(0, 'ids')}") for fs, base in [token_files.opened(folder)]][0])
    first, mask = file.sequence(0)
    assert first.base is not None and len(first) == 16 and mask.all()
    assert sum(file.batch(i)[1].sum() for i in range(file.file.num_record_batches)) == at


def test_license_scan(docs, rows):
    got = by_id(license_scan.scan(docs))
    for r in rows:
        w = [x for x in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", (r[1] or "").translate(ASCII_LOWER)) if x]
        places, base = [], set()
        for phrase, label in license_scan.PHRASES:
            p = phrase.split()
            hits = [i for i in range(len(w)) if w[i : i + len(p)] == p]
            places += hits
            base |= {label} if hits else set()
        labels, share = set(base), 0.0
        for s in range(0, max(len(w) - license_scan.STEP, 1), license_scan.STEP):
            block = set(w[s : s + license_scan.BLOCK])
            for label, t in license_scan.TEMPLATES:
                t_set = set(t.split())
                if len(block & t_set) >= license_scan.needed(t):
                    labels.add(label)
                    share = max(share, len(block & t_set) / len(t_set))
        for g in got[r[0]]:
            assert (g["n_words"], g["n_base"]) == (len(w), len(places))
            assert (g["first_word"], g["last_word"]) == ((min(places), max(places)) if places else (None, None))
            assert (g["base_labels"], g["labels"]) == (",".join(sorted(base)), ",".join(sorted(labels)))
            assert g["score"] == (1.0 if places else pytest.approx(share))


def test_mixing(docs, rows):
    got = mixing.mixture(docs).collect()
    size = {r[0]: len(words(r[1])) for r in rows}
    total = sum(size[r[0]] for r in rows)
    taken, source = Counter(), defaultdict(lambda: [0, 0.0])
    for g in got:
        assert g["size"] == size[g["doc_id"]] and g["taken"] in (0, g["size"], 2 * g["size"])
        taken[g["source"]] += g["taken"]
        source[g["source"]] = [g["source_size"], g["target"]]
    assert sum(t for _, t in source.values()) == pytest.approx(1.5 * total)
    for s, (n, t) in source.items():
        assert t <= 2 * n + 1e-9 and abs(taken[s] - t) <= max(size.values())
    assert sorted(map(tuple, mixing.mixture(docs).collect()), key=str) == sorted(map(tuple, got), key=str)
    used = Counter(r["doc_id"] for r in mixing.mixed(docs).collect())
    assert mixing.mixed(docs).columns == docs.columns
    assert all(used[g["doc_id"]] >= g["passes_taken"] for g in got if g["size"])


def water_filled(sizes, mix):
    """Targets of sources in code-point order by repeated sharing: whoever would pass its cap gets its cap, the rest is shared again."""
    weight = {s: mix.weights[k % len(mix.weights)] for k, s in enumerate(sorted(sizes))}
    left, free, out = mix.share * sum(sizes.values()), set(sizes), {}
    while free:
        level = left / sum(weight[s] for s in free)
        full = {s for s in free if level * weight[s] > mix.passes * sizes[s]}
        if not full:
            return out | {s: level * weight[s] for s in free}
        out |= {s: float(mix.passes * sizes[s]) for s in full}
        left, free = left - sum(out[s] for s in full), free - full
    return out


@pytest.mark.parametrize("large", [50, 475])
def test_mixing_many_sources(spark, large):
    """Twenty sources, even or with one (of weight 5) that holds a third of the words."""
    data = [(100 * s + k, "w " * (large if s == 0 else 50), f"s{s:02}") for s in range(20) for k in range(20)]
    got = mixing.mixture(spark.createDataFrame(data, "doc_id long, text string, source string").repartition(4)).collect()
    size, taken, target = Counter(), Counter(), {}
    for g in got:
        size[g["source"]] += g["size"]
        taken[g["source"]] += g["taken"]
        target[g["source"]] = g["target"]
    total = sum(size.values())
    assert target == pytest.approx(water_filled(size, mixing.Mix()))
    assert sum(target.values()) == pytest.approx(1.5 * total) and min(target.values()) > 0
    assert all(abs(taken[s] - target[s]) <= large for s in target) and sum(taken.values()) <= 1.5 * total


#: Targets by sharing again round by round, as the contract words it: whoever is above its cap gets the cap, the rest is shared again.
TARGETS_BY_ROUNDS = r"""
WITH RECURSIVE s AS (SELECT source, CAST(sum(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))) AS BIGINT) AS size FROM documents GROUP BY source),
c AS (SELECT source, 2 * size AS cap, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w FROM s),
t AS (
  SELECT 0 AS round, (SELECT list(c) FROM c) AS open, 1.5 * (SELECT sum(size) FROM s)::DOUBLE AS budget, CAST([] AS STRUCT(source VARCHAR, target DOUBLE)[]) AS done
  UNION ALL
  SELECT round + 1, list_filter(open, lambda x: x.cap >= level * x.w), budget - coalesce(list_sum(list_transform(list_filter(open, lambda x: x.cap < level * x.w), lambda x: x.cap)), 0),
    list_concat(done, list_transform(list_filter(open, lambda x: x.cap < level * x.w OR all_below), lambda x: {'source': x.source, 'target': CASE WHEN all_below THEN level * x.w ELSE x.cap END}))
  FROM (SELECT *, len(list_filter(open, lambda x: x.cap < level * x.w)) = 0 AS all_below FROM (SELECT *, budget / list_sum(list_transform(open, lambda x: x.w)) AS level FROM t WHERE len(open) > 0 AND len(done) < (SELECT count(*) FROM c)))
)
SELECT x.source, x.target FROM (SELECT unnest(done) AS x FROM t WHERE round = (SELECT max(round) FROM t))
"""


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_mixing_targets_against_rounds_in_sql(spark, sf):
    """The targets on the test tables against SQL that is built another way than the operator and its registered SQL."""
    import duckdb

    path = f"/root/testdata/{sf}"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}/documents.parquet'")
    want = dict(con.execute(TARGETS_BY_ROUNDS).fetchall())
    got = mixing.mixture(documents(spark, path)).groupBy("source").agg({"target": "max", "taken": "sum", "size": "max"}).collect()
    assert {r["source"]: r["max(target)"] for r in got} == pytest.approx(want) and min(want.values()) > 0
    # A source ends near its target: its last document may be cut off by the budget, whose order all sources share.
    assert all(abs(r["sum(taken)"] - want[r["source"]]) <= 2 * r["max(size)"] for r in got)


def test_mixing_a_source_for_each_document(spark):
    data = [(k, "w " * (1 + k % 7), f"s{k:05}" if k else None) for k in range(900)]
    got = mixing.mixture(spark.createDataFrame(data, "doc_id long, text string, source string").repartition(4)).collect()
    size = {g["source"] or "~": g["size"] for g in got}
    want = water_filled(size, mixing.Mix())
    assert {g["source"] or "~": g["target"] for g in got} == pytest.approx(want)
    assert sum(g["taken"] for g in got) <= 1.5 * sum(size.values()) < sum(g["taken"] for g in got) + 8


def test_language_model(docs, rows):
    kept = [[*words(r[1]), None] for r in rows if zlib.crc32(str(r[0]).encode()) % 10]
    c = Counter(w for t in kept for w in t)
    n, v = sum(c.values()), len(c)
    got = by_id(language_model.scored(docs))
    for r in rows:
        w = [*words(r[1]), None]
        for g in got[r[0]]:
            assert (g["n_tokens"], g["n_known"], g["train_tokens"], g["held_out"]) == (len(w), sum(x in c for x in w), n, zlib.crc32(str(r[0]).encode()) % 10 == 0)
            assert g["base_score"] == pytest.approx(sum(math.log10((c[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w))
            assert g["score"] < 0


def test_language_model_is_normalised():
    p = language_model.initial(np.full(language_model.CLASSES, 1 / language_model.CLASSES))
    rows = np.stack([np.arange(language_model.CLASSES), np.full(language_model.CLASSES, 3), np.full(language_model.CLASSES, 9)]).astype(np.int32)
    assert (10 ** language_model.log_probabilities(rows, *language_model.unpacked(p))).sum() == pytest.approx(1, abs=1e-4)


def test_language_model_tells_words_of_one_ending_apart(spark):
    """Words outside the most frequent ones, all of one ending and one count, are predicted from the words before them."""
    ids = [i for i in range(20000) if zlib.crc32(str(i).encode()) % 10]
    filler = " ".join(f"f{k}" for k in range(447))
    text = [filler] * 2001 + [" ".join([f"a{j}end b{j}end"] * 100) for j in range(12) for _ in range(20)]
    held = [i for i in range(20000) if not zlib.crc32(str(i).encode()) % 10]
    right = [(held[j], f"a{j}end b{j}end") for j in range(12)]
    wrong = [(held[12 + j], f"a{j}end b{(j + 1) % 12}end") for j in range(12)]
    frame = spark.createDataFrame([*zip(ids, text, strict=False), *right, *wrong], "doc_id long, text string").coalesce(1)
    score = {r["doc_id"]: r["score"] for r in language_model.scored(frame).where("held_out").collect()}
    assert sum(score[i] for i, _ in right) > sum(score[i] for i, _ in wrong) + 12 * 0.3


def test_language_model_is_normalised_over_all_words():
    m, r = language_model, np.random.default_rng(1)
    words = np.arange(1000, 4000).astype(np.uint64)
    bucket = np.sort(r.integers(0, m.BUCKETS, len(words)))
    layout = m.Layout(np.arange(m.WORD_CLASSES).astype(np.uint64), np.full(m.WORD_CLASSES, 90), words, bucket, np.full(len(words), 20), 50, np.full(m.BUCKETS, 7.0))
    parts = m.unpacked(layout.matrix(), layout.numbers)
    rows = np.stack([np.arange(layout.numbers), np.full(layout.numbers, 2000), np.full(layout.numbers, 9)]).astype(np.int32)
    logs = m.log_probabilities(np.stack((layout.cls[rows[0]], rows[1], rows[2])), *parts) + m.log_inside(layout, rows, *parts)
    assert layout.numbers == m.CLASSES + len(words) and (10**logs).sum() == pytest.approx(1, abs=1e-4)


def test_language_model_scores_like_a_plain_loop():
    """Batched log probabilities against softmaxes written out, one token at a time."""
    m, r = language_model, np.random.default_rng(5)
    words = np.arange(1000, 1400).astype(np.uint64)
    bucket = np.sort(r.integers(0, m.BUCKETS, len(words)))
    layout = m.Layout(np.arange(m.WORD_CLASSES).astype(np.uint64), np.full(m.WORD_CLASSES, 90), words, bucket, np.full(len(words), 20), 50, np.full(m.BUCKETS, 7.0))
    p = layout.matrix()
    p += r.normal(0, 0.3, p.shape).astype(np.float32)
    context, out, bias = m.unpacked(p, layout.numbers)
    rows = r.integers(0, layout.numbers, (3, 300)).astype(np.int32)
    got = m.log_probabilities(np.stack((layout.cls[rows[0]], rows[1], rows[2])), context, out, bias) + m.log_inside(layout, rows, context, out, bias)

    def log_softmax(hidden, first, last, chosen):
        s = [float(hidden @ out[k] + bias[k]) for k in range(first, last)]
        return s[chosen - first] - math.log(sum(math.exp(v) for v in s))

    for k, (target, one, two) in enumerate(rows.T):
        hidden = (context[0][one] + context[1][two]).astype(np.float64)
        want = log_softmax(hidden, 0, m.CLASSES, layout.cls[target])
        if target > m.WORD_CLASSES:
            b = layout.cls[target] - m.WORD_CLASSES - 1
            want += log_softmax(hidden, layout.nodes[b], layout.nodes[b + 1], layout.node[target])
        if target >= m.CLASSES:
            parent = layout.node[target]
            want += log_softmax(hidden, layout.group_first[parent] + layout.first_word, layout.group_last[parent] + layout.first_word, target - m.CLASSES + layout.first_word)
        assert got[k] == pytest.approx(want / math.log(10), abs=1e-4)


def test_language_model_learns(spark):
    """Held-out text is likelier than under the counts alone."""
    out = language_model.scored(documents(spark, "/root/testdata/sf0.01")).where("held_out").selectExpr("sum(score) / sum(n_tokens) AS s", "sum(base_score) / sum(n_tokens) AS b").first()
    assert out["s"] > out["b"] + 0.05


def test_fingerprints(docs, rows):
    got = by_id(fingerprints.fingerprinted(docs))
    by_text = {}
    ids = sorted({r[0] for r in rows})
    text = {r[0]: r[1] or "" for r in rows}
    for k, i in enumerate(ids):
        after, half = text[ids[(k + 1) % len(ids)]], len(text[i]) // 2
        edited = text[i][: len(text[i]) - half] + after[:half]
        for g in got[i]:
            assert g["n_chars"] == len(text[i]) and g["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
            assert by_text.setdefault(text[i], g["fingerprint"]) == g["fingerprint"]
            a, b = ({f[j : j + 16] for j in range(0, len(f), 16)} for f in (g["fingerprint"], g["edited_fingerprint"]))
            assert g["near_edited"] == pytest.approx(len(a & b) / len(a | b) if a | b else 1.0)
    the_river = {r["fingerprint"] for r in fingerprints.fingerprinted(docs.sparkSession.createDataFrame([(1, "The river is a stone"), (2, "the RIVER, is a: stone!")], "doc_id long, text string")).collect()}
    assert len(the_river) == 1


def test_fingerprints_next_document(spark, docs, odd_ids):
    """The next document's likeness against the signature sets themselves; ids as text, null ids, one id alone."""
    def sets(f):
        return {f[j : j + 16] for j in range(0, len(f), 16)}

    for frame in (docs, docs.withColumn("doc_id", docs["doc_id"].cast("string")), odd_ids, docs.where("doc_id = 63"), docs.where("false").unionByName(odd_ids.where("doc_id is null"))):
        order = sorted(frame.collect(), key=lambda r: (r["doc_id"] is None, r["doc_id"] or "" if isinstance(r["doc_id"], str) else r["doc_id"] or 0, r["text"] or ""))
        print_of = {}
        got = fingerprints.fingerprinted(frame).collect()
        text_of = defaultdict(list)
        for r in order:
            text_of[r["doc_id"]].append(r["text"] or "")
        ids = list(text_of)
        for g in got:
            for t in text_of[g["doc_id"]]:
                if len(text_of[g["doc_id"]]) == 1 or len(set(text_of[g["doc_id"]])) == 1:
                    print_of[t] = g["fingerprint"]
        assert len(got) == len(order)
        for g in got:
            if len(set(text_of[g["doc_id"]])) > 1:
                continue
            t, after = text_of[g["doc_id"]][0], text_of[ids[(ids.index(g["doc_id"]) + 1) % len(ids)]][0]
            half = len(t) // 2
            assert g["edited_sha256"] == hashlib.sha256((t[: len(t) - half] + after[:half]).encode()).hexdigest()
            if after in print_of:
                a, b = sets(g["fingerprint"]), sets(print_of[after])
                assert g["near_next"] == pytest.approx(len(a & b) / len(a | b) if a | b else 1.0)


def test_fingerprint_pairs(spark):
    r = np.random.default_rng(3)
    sets = [sorted(r.choice(10**6, n, replace=False).tolist()) for n in (1, 3, 4, 5, 9, 20, 50)]
    sets += [sorted(s[: max(1, int(len(s) * cut))]) for s in sets for cut in (0.7, 0.8, 0.9, 1)] + [[], []]
    want = {(i, j) for i, j in combinations(range(len(sets)), 2) if len({*sets[i]} & {*sets[j]}) >= 0.8 * len({*sets[i]} | {*sets[j]}) - 1e-9}
    got = fingerprints.near_pairs(spark.createDataFrame(list(enumerate(sets)), "i long, s array<long>"), "i", "s").collect()
    assert len(want) > 20 and len(got) == len(want) and {(g["a"], g["b"]) for g in got} == want


def test_fingerprints_cover_texts_without_anchors(spark):
    line = "cat dog " + " ".join(f"wort{k}" for k in range(60))
    texts = [line, "cat dog " + " ".join(f"other{k}" for k in range(60)), line.replace("wort40", "else"), "!!! ---", "?? ++", " \n "]
    sigs = [set(r["s"]) for r in fingerprints.with_signatures(spark.createDataFrame(list(enumerate(texts)), "i int, text string").coalesce(1), "text", "s").orderBy("i").collect()]
    assert len(sigs[0]) == 61 and len(sigs[0] & sigs[1]) == 1 and len(sigs[0] ^ sigs[2]) == 6
    assert len(sigs[3]) == len(sigs[4]) == 1 and sigs[3] != sigs[4] and not sigs[5]


def test_toxicity(spark, docs, labels, nothing):
    import random

    r = random.Random(3)
    data = []
    for i in range(900):
        t = [r.choice("the of red house river walk tree cloud stone".split()) for _ in range(30)]
        if i % 6 == 0:
            t[r.randrange(30)] = r.choice(["idiot", "moron", "scum"])
        data.append((i, " ".join(t), int(i % 6 == 0)))
    table = spark.createDataFrame(data, "doc_id long, text string, toxic int")
    model = toxicity.fitted(table.select("doc_id", "text"), table.select("doc_id", "toxic"))
    out = {g["doc_id"]: g for g in toxicity.scores(table, model).collect()}
    held = [d for d in data if zlib.crc32(str(d[0]).encode()) % 3 == 1]
    assert all(out[d[0]]["held_out"] for d in held)
    assert sum(out[d[0]]["predicted"] == d[2] for d in held) >= 0.97 * len(held)
    kept = toxicity.clean_rows(table, model)
    assert kept.columns == table.columns and {g["doc_id"] for g in kept.collect()} == {i for i, g in out.items() if not g["predicted"]}
    # No model can be learned: every row still gets a score.
    for frame in (docs, nothing):
        plain = toxicity.scores(frame, toxicity.fitted(frame, labels.where("toxic = 0")))
        assert plain.count() == frame.count() and plain.where("score is null or predicted = 1").count() == 0
