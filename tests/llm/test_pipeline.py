"""The pipeline's stages, each on what its predecessor kept."""

import corpus_pipeline
from loomwright.llm.support import documents

SF = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_shrink(spark):
    docs = documents(spark, SF)
    seen = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:3]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        docs = out.persist()
        seen.append(docs.count())
    assert seen == sorted(seen, reverse=True)
    ids = [r["doc_id"] for r in docs.collect()]
    assert len(ids) == len(set(ids))


def test_run(spark):
    out = corpus_pipeline.run(spark, SF).collect()
    assert out and all(r["n_tokens"] == len(r["ids"]) for r in out)
    assert max(sum(x["doc_id"] == r["doc_id"] for x in out) for r in out[:20]) <= 2


def test_stages_against_brute_force(spark, tmp_path):
    """Kept ids of each stage, and the mixing stage's words per source, on many even sources with copies and near copies."""
    import hashlib
    import random
    from collections import Counter
    from itertools import combinations

    from loomwright.llm import mixing, toxicity

    from .test_operators import water_filled, words

    r = random.Random(4)
    texts = {100 * s + k: " ".join(f"w{r.randrange(3000)}" for _ in range(60)) for s in range(20) for k in range(8)}
    for s in range(20):
        texts[100 * s + 50] = texts[100 * s].replace(" ", "  ", 1)  # an exact copy but for space, and longer
        texts[100 * s + 60] = texts[100 * s + 1] + " tail"
    rows = [(i, t, f"s{i // 100:02}") for i, t in texts.items()]
    spark.createDataFrame([(i, int(i % 7 == 0)) for i in texts], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    stages = dict(corpus_pipeline.STAGES)

    model = toxicity.fitted(docs, toxicity.labels_table(spark, str(tmp_path)))
    clean = {g["doc_id"] for g in toxicity.scores(docs, model).collect() if not g["predicted"]}
    assert {g["doc_id"] for g in stages["toxicity"](spark, docs, str(tmp_path)).collect()} == clean

    best = {}
    for i, t in texts.items():
        best.setdefault("".join(t.split()), []).append(i)
    want = {min(g, key=lambda j: (-len(texts[j]), j)) for g in best.values()}
    out = stages["exact_dedup"](spark, docs, "").persist()
    assert sorted(g["doc_id"] for g in out.collect()) == sorted(want)

    grams = {i: {tuple(w[k : k + 5]) for k in range(len(w) - 4)} for i in want for w in [words(texts[i])]}
    root = {i: i for i in want}
    for a, b in combinations(sorted(want), 2):
        both = len(grams[a] & grams[b])
        if 5 * both >= 4 * (len(grams[a]) + len(grams[b]) - both):
            root = {i: min(root[a], root[b]) if x in (root[a], root[b]) else x for i, x in root.items()}
    kept = {i for i, x in root.items() if i == x}
    out = stages["ngram_join"](spark, out, "").persist()
    assert sorted(g["doc_id"] for g in out.collect()) == sorted(kept) and len(kept) < len(want)

    size = Counter()
    for i in kept:
        size[f"s{i // 100:02}"] += len(words(texts[i]))
    goal, total, at = water_filled(size, mixing.Mix()), Counter(), []
    for key, i in sorted((hashlib.md5(f"mix:{i}".encode()).hexdigest(), i) for i in kept):
        s, n = f"s{i // 100:02}", len(words(texts[i]))
        total[s] += n
        at += [((size[s] * p + total[s]) / goal[s], key, p, i, n) for p in range(2)]
    left, uses = 1.5 * sum(size.values()), Counter()
    for *_, i, n in sorted(at):
        left -= n
        if left < 0:
            break
        uses[i] += 1
    assert Counter(g["doc_id"] for g in stages["mixing"](spark, out, "").collect()) == uses
