"""Rank BPE, the filter audit and conversation repair against the library, brute force and their SQL."""

import hashlib
import itertools
import random
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken

from loomwright.llm import conversation_repair, filter_audit, rank_bpe


def library(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def expected_codes(ranks, rows):
    encode = library(ranks).encode_ordinary
    for doc_id, text in rows:
        ids = encode(text or "")
        yield doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


def by_id(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, *map(str, r[1:])))


def test_rank_bpe_equals_the_library(spark, docs, rows, odd_ids, nothing):
    ranks = rank_bpe.read_ranks(rank_bpe.default_vocabulary())
    assert by_id(map(tuple, rank_bpe.round_trip(docs).collect())) == by_id(expected_codes(ranks, [r[:2] for r in rows]))
    odd = [r[:2] for r in odd_ids.collect()]
    assert by_id(map(tuple, rank_bpe.round_trip(odd_ids).collect())) == by_id(expected_codes(ranks, odd))
    assert rank_bpe.round_trip(nothing).collect() == []


def test_rank_bpe_odd_and_long_texts(spark):
    r = random.Random(3)
    newer = list(rank_bpe.newer(public_tokenizers.PATTERN))
    texts = ["x" * 5000, "=" * 500 + " " * 300 + "\n\n", "\x1c \x85 ΣΑΣ 's'll", "<|endoftext|>"]
    texts += ["".join(r.choice(letters) for _ in range(n)) for letters in ("abcdefghijklmnopqrstuvwxyz", "éñüab", "日本語") for n in (66, 900)]
    texts += [f"a{chr(c)}b 1{chr(c)}2 {chr(c)}" for c in r.sample(newer, min(20, len(newer)))]
    texts += ["".join(chr(r.choice([*range(1, 0x3000), *range(0x1F000, 0x1FB00)])) for _ in range(800))]
    texts += [" ".join(r.choice(["stone", "walk,", "naïve", "12"]) for _ in range(120000))]  # cut in pieces
    given = list(enumerate(texts))
    got = rank_bpe.round_trip(spark.createDataFrame(given, "doc_id long, text string"), with_ids=True).collect()
    ranks = rank_bpe.read_ranks(rank_bpe.default_vocabulary())
    assert by_id(tuple(g)[:4] for g in got) == by_id(expected_codes(ranks, given))
    encode = library(ranks).encode_ordinary
    assert all(g["ids"] == encode(texts[g["doc_id"]]) and bytes(g["decoded"]) == texts[g["doc_id"]].encode() for g in got)


def test_rank_bpe_ranks_that_fall(tmp_path):
    """Vocabularies where a contraction makes a pair of lower rank: long words are then contracted one place at a time."""
    import base64

    r = random.Random(8)
    for trial in range(30):
        ranks = {bytes([b]): b for b in range(256)}
        tokens = sorted({"".join(r.choice("abc") for _ in range(r.randrange(2, 6))).encode() for _ in range(12)})
        r.shuffle(tokens)
        ranks |= {t: 256 + i for i, t in enumerate(tokens)}
        path = tmp_path / f"{trial}.tiktoken"
        path.write_bytes(b"".join(base64.b64encode(t) + b" " + str(i).encode() + b"\n" for t, i in ranks.items()))
        words = ["".join(r.choice("abc") for _ in range(n)) for n in (3, 20, 64, 65, 90, 150)]
        own = rank_bpe.RankTables(str(path), public_tokenizers.PATTERN)
        ids, counts = own.encode(words)
        ends = np.cumsum(counts)
        encode = library(ranks).encode_ordinary
        assert [ids[e - n : e].tolist() for e, n in zip(ends, counts, strict=True)] == [encode(w) for w in words]


def test_rank_bpe_forgets_and_refuses(monkeypatch):
    monkeypatch.setattr(rank_bpe, "KNOWN", 50)
    own = rank_bpe.RankTables(rank_bpe.default_vocabulary(), public_tokenizers.PATTERN)
    encode = library(own.ranks).encode_ordinary
    for k in range(5):
        text = " ".join(f"wörd{k}x{i}" for i in range(40))
        ids, counts = own.encode([text, "", text])
        assert ids.tolist() == encode(text) * 2 and counts.tolist()[1] == 0
        assert own.decode(ids, counts) == [text.encode(), b"", text.encode()]
    with pytest.raises(KeyError):
        own.decode(np.array([10**6]), np.array([1]))


def expected_audit(rows, labels):
    good, toxic = defaultdict(bool), defaultdict(bool)
    for i, q, t in labels:
        good[i] |= q == 1
        toxic[i] |= t == 1
    texts = [(i, t or "", s or "") for i, t, s in rows]
    smallest = {}
    for i, t, _ in texts:
        if i is not None:
            smallest[t] = min(smallest.get(t, i), i)
    found = defaultdict(Counter)
    for i, t, part in texts:
        words = [w for w in "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in t).split(" ") if w]
        fails = "".join(
            letter
            for letter, f in (
                ("A", len(words) < 50),
                ("B", 100 * len(set(words)) < 65 * len(words)),
                ("C", 100 * sum("A" <= c <= "Z" for c in t) > 5 * len(t)),
                ("D", any(c in "#$%&*|" for c in t)),
                ("E", i is not None and t in smallest and smallest[t] < i),
            )
            if f
        )
        for order in itertools.permutations("ABCDE"):
            gone = False
            for step, letter in enumerate(order, 1):
                n = found[part, "".join(order), step]
                hit = letter in fails
                n["kept"] += not gone and not hit
                n["removed"] += hit and not gone
                n["redundant"] += hit and gone
                n["unique_fails"] += fails == letter
                n["good_lost"] += hit and not gone and i is not None and good[i]
                n["toxic_lost"] += hit and not gone and i is not None and toxic[i]
                gone |= hit
    shapley = Counter()
    for (part, order, step), n in found.items():
        shapley[part, order[step - 1]] += n["removed"]
    return {k: (*(n[c] for c in filter_audit.COUNTED), shapley[k[0], k[1][k[2] - 1]]) for k, n in found.items()}


def test_filter_audit_equals_brute_force(spark, rows, nothing):
    given = [(r[0], r[1], r[3]) for r in rows] + [(None, "one", "s1"), (None, "one", None), (9000, "# A B " * 20, ""), (9001, "# A B " * 20, None), (9002, " ".join(map(str, range(60))), "s2")]
    labels = [(r[0], k % 2, int(k % 3 == 0)) for k, r in enumerate(rows)] + [(9000, 1, None), (9000, None, 1), (None, 1, 1)]
    docs = spark.createDataFrame([(*g, 1, 2, 3) for g in given], "doc_id long, text string, source string, part int, flags int, h int").repartition(3)
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {tuple(r)[:3]: tuple(r)[3:] for r in filter_audit.interaction_audit(docs, table).collect()}
    assert got == expected_audit(given, labels)
    assert len(got) == 600 * len({g[2] or "" for g in given})
    assert filter_audit.interaction_audit(nothing, table).collect() == []
    assert {r["good_lost"] for r in filter_audit.interaction_audit(docs, table.limit(0)).collect()} == {0}


def cheapest(signature):
    """The cheapest audit by trying every sequence of edits in the order of cost and string."""
    import heapq
    import re

    whole = re.compile("(s?(ua)+)?")
    heap = [(0, "", 0, "")]
    while heap:
        cost, audit, row, roles = heapq.heappop(heap)
        if row == len(signature) and whole.fullmatch(roles):
            return cost, audit
        if len(roles) > len(signature) + 3:
            continue
        for role in "ua":
            heapq.heappush(heap, (cost + 2, audit + "I", row, roles + role))
        if row == len(signature):
            continue
        c = signature[row]
        heapq.heappush(heap, (cost + 3, audit + "D", row + 1, roles))
        if c.isalpha():
            cut = int(c.isupper())
            heapq.heappush(heap, (cost + cut, audit + "K", row + 1, roles + c.lower()))
            for role in "ua":
                heapq.heappush(heap, (cost + cut + 2, audit + "R", row + 1, roles + role))


def test_solved_signatures_are_the_cheapest():
    every = [s for n in range(4) for s in map("".join, itertools.product("suaxUA04", repeat=n))]
    r = random.Random(2)
    every += ["".join(r.choice("suaxSUAX0123") for _ in range(r.randrange(4, 6))) for _ in range(60)]
    for s in every:
        assert conversation_repair.solve(s) == cheapest(s), s


def test_solving_long_signatures_needs_no_depth():
    cost, audit = conversation_repair.solve("s" + "ua" * 20000 + "u")
    assert (cost, audit) == (2, "K" * 40002 + "I")


SCHEMA = "conv_id long, turn long, role string, text string, place int, conv int, audit int, h int"


def talks():
    r = random.Random(4)
    lines = ["Yes.", "No!", "Why?", "hm", "", " \n", "Yes. ", "ok then", None, "Mixed. Ends without", "end. "]
    found = [(c, t if r.random() > 0.1 else None, r.choice(["user", "assistant", "system", "tool", None, "", "User"] if c % 5 == 0 else ["user", "assistant"]), r.choice(lines)) for c in range(60) for t in range(r.randrange(1, 9))]
    found += [(None, t, "user", "Without an id.") for t in range(3)] + [(70, 1, "user", "Hello."), (70, 1, "user", "Hello."), (70, 5, "assistant", "Yes.")]
    gone = next(c for c in range(100, 10000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    found += [(gone, 0, "user", "All gone.")] + [(200, t, "user" if t % 2 == 0 else "assistant", f"Turn {t}.") for t in range(2000)]
    r.shuffle(found)
    return [(*f, 1, 2, 3, 4) for f in found]


def expected_repairs(rows):
    after = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        shown = " " if conv is None else conv, " " if turn is None else turn
        kind = zlib.crc32(f"{shown[0]}:{shown[1]}".encode()) % 20
        role, text = (" " if role is None else role), (" " if text is None else text)
        after[conv]
        if kind == 0:
            continue
        text = "" if kind == 1 else "".join(c for c in text if c not in ".!?") if kind == 2 else text
        after[conv] += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    space = " \t\n\x0b\x0c\r"
    for conv, own in after.items():
        own.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1], hashlib.sha256(x[2].encode()).digest()))
        seen, signature, faults = set(), "", Counter()
        for _, role, text in own:
            place = {"s": 0, "u": 1, "a": 2}.get(role[:1], 3)
            ends = text.rstrip(space)[-1:]
            fault = "blank" if not ends else "duplicate" if (role, text) in seen else "truncated" if ends not in ".!?" else ""
            seen.add((role, text))
            faults[fault] += 1
            signature += {"blank": "0123", "duplicate": "4567", "truncated": "SUAX", "": "suax"}[fault][place]
        turns = {t for t, _, _ in own if t is not None}
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(own))
        cost, audit = conversation_repair.solve(signature)
        lines, row, ends = [], 0, ""
        for edit in audit:
            expected = "assistant" if ends == "u" else "user"
            if edit == "I":
                lines.append(f"{expected}:")
            else:
                role, text = own[row][1:]
                row += 1
                if edit == "D":
                    continue
                lines.append(f"{role if edit == 'K' else expected}:{text}")
            ends = lines[-1][0]
        assert row == len(own)
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        yield conv, gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()


def test_conversation_repair_equals_a_loop(spark):
    rows = talks()
    given = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = by_id(map(tuple, conversation_repair.repaired(given).collect()))
    assert got == by_id(expected_repairs(rows))
    assert any(g[7] == "" and g[8] == hashlib.sha256(b"").hexdigest() for g in got)
    assert conversation_repair.repaired(given.limit(0)).collect() == []


def test_conversation_repair_sql_on_nulls_and_ties(spark, tmp_path):
    rows = [r for r in talks() if r[0] != 200]
    given = spark.createDataFrame(rows, SCHEMA)
    con = duckdb.connect()
    con.register("given", given.toArrow())
    con.execute("CREATE VIEW conversations AS SELECT * FROM given")
    got = conversation_repair.repaired(given)
    assert by_id(map(tuple, con.execute(conversation_repair.ORACLE).fetchall())) == by_id(map(tuple, got.collect()))
