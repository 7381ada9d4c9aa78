"""Shared values are computed once a row, and results stay as they were."""

import math
import re
import time
from collections import Counter

from loomwright.functions import text
from loomwright.operators import diagnostic, issues, similarity, tagging
from pyspark.sql import functions as F


def searches(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract_all(")


def test_component_patterns_stand_once_in_the_plan(spark):
    df = spark.createDataFrame([("HAL_can_Init \\BSPI_ ll_Dma2d can", 0), ("ſpi ", 1), (None, 2)], "t string, i int")
    told = df.select("i", tagging.infer_component(F.col("t")).alias("c")).select("i", "c.*")
    assert searches(told) == 4
    assert [tuple(r) for r in told.orderBy("i").collect()] == [
        (0, "CAN", 6, 3, "low", "CAN(score=6,hits=3), DMA(score=5,hits=2), SPI(score=3,hits=2)"), (1, None, 0, 0, "none", ""), (2, None, 0, 0, "none", ""),
    ]


def test_votes_search_a_text_once(spark):
    df = spark.createDataFrame([("Keywords: adc, dma\nDMA and ADC ADC", ["x"]), ("component=Timer, b", None), ("SPI I2C", None), ("CAN CAN CAN", None)], "t string, l array<string>")
    voted = df.select(tagging.vote_component(F.col("t"), F.col("l")).alias("c"))
    assert searches(voted) == 1
    assert [r["c"] for r in voted.collect()] == ["ADC", "TIM", None, "CAN"]


def test_trigrams_of_a_long_text_take_one_pass(spark):
    began = time.perf_counter()
    n = spark.range(1).select(F.size(similarity.trigrams(F.repeat(F.lit("aé𝒳 "), 100_000))).alias("n")).first()["n"]
    assert n == 400_000 - 1 - 2
    assert time.perf_counter() - began < 20


def test_pairs_of_one_key_count_their_trigrams_together(spark):
    rows = [(1, "a𝒳bc timer", "a𝒳b timer works"), (1, "other words", None), (2, "timer works", "timer fails"), (3, "", "ab"), (None, "x y z", "x y z")]
    got = similarity.semantic_lite(spark.createDataFrame(rows, "k int, a string, b string"), ["k"], "a", "b").collect()

    def cosine(pairs):
        x, y = (Counter(t[i : i + 3] for p in pairs for t in [p[side] or ""] for i in range(len(t) - 2)) for side in (0, 1))
        norm = math.sqrt(sum(n * n for n in x.values()) * sum(n * n for n in y.values()))
        return sum(n * y[g] for g, n in x.items()) / norm if norm else 0.0

    one, two = cosine([r[1:] for r in rows[:2]]), cosine([rows[2][1:]])
    want = {(1, rows[0][1]): 0.7 / 2 + 0.3 * one, (1, "other words"): 0.3 * one, (2, "timer works"): 0.7 / 3 + 0.3 * two, (3, ""): 0.0, (None, "x y z"): 0.0}
    tokens = lambda t: set(re.findall(r"[a-z][a-z0-9_\-/]{2,}", t or ""))
    for k, a, b in rows[:3]:
        both = tokens(a) | tokens(b)
        want[(k, a)] = 0.7 * len(tokens(a) & tokens(b)) / len(both) + 0.3 * (one if k == 1 else two)
    assert {(r["k"], r["a"]) for r in got} == set(want)
    assert all(math.isclose(r["semantic"], want[r["k"], r["a"]], abs_tol=1e-9) for r in got)


def test_html_steps_stand_once_in_the_plan(spark):
    df = spark.createDataFrame([("<p>a&#65;&#x42; \x0b</p>\n\t \n<b>c</b>",), ("\f\r\n x \t",), ("&#65;&#65;",)], "t string")
    told = df.select(text.strip_html(F.col("t")).alias("x"))
    assert told._jdf.queryExecution().optimizedPlan().toString().count("<[^>]+>") == 1
    assert [r["x"] for r in told.collect()] == ["aAB\nc", "x", "AA"]
    assert [r["x"] for r in df.select(text.strip(F.col("t")).alias("x")).collect()][1] == "x"


def test_tags_search_a_text_once(spark):
    df = spark.createDataFrame([("STM32CubeF4 V1.2.3 and hal 1.2, CUBEMX6.1; cubeide v1.2.3 ll v 3.4\nstm32cube_hal version 1.0.0 hal 1.2", 0), ("stm32cubef4 v1.2 shall 1.2 TIMED OUT pinmux", 1), (None, 2)], "t string, i int")
    told = df.select("i", tagging.version_tags(F.col("t")).alias("v"), tagging.failure_tags(F.col("t")).alias("f"))
    assert searches(told) == len(tagging.VERSIONS)
    assert told._jdf.queryExecution().optimizedPlan().toString().count("RLIKE") == 0
    assert [tuple(r) for r in told.orderBy("i").collect()] == [
        (0, ["STM32CUBEF4 v1.2.3", "STM32CUBE_HAL v1.0.0", "CUBEMX v6.1", "CUBEIDE v1.2.3", "HAL v1.2"], ["version_regression"]), (1, [], ["timeout", "pinmux"]), (2, [], []),
    ]


def test_sentences_name_a_text_once(spark):
    df = spark.createDataFrame([("  One  𝒳!  two.",), ("no end\there   ",), ("Hello @you. More",), ("x" * 9 + ". y",), ("\n",), (None,)], "t string")
    plan = lambda d: d._jdf.queryExecution().optimizedPlan().toString()
    told = df.select(text.first_sentence(F.col("t"), 9).alias("s"), text.signal_sentence(F.col("t"), 12).alias("g"))
    assert plan(told).count("regexp_replace(") == 2 and plan(told).count("regexp_extract(") == 2
    assert [tuple(r) for r in told.collect()] == [("One 𝒳!", "One 𝒳!"), ("no end he", "no end here"), ("Hello @yo", ""), ("x" * 9, "x" * 9 + "."), ("", ""), ("", "")]
    issue = F.struct(*(F.col("t").alias(k) for k in ("repo", "issue_title", "github_url", "st_ready_text", "component", "board", "layer", "issue_kind", "severity", "mcu_series", "evidence_strength")), F.lit(1).cast("long").alias("issue_number"), F.lit(True).alias("rescue_applied"), F.array("t").alias("labels"))
    case = F.struct(*(F.col("t").alias(k) for k in ("issue_title", "issue_url", "resolver_card_text", "resolution_status", "link_confidence")), *(F.array("t").alias(k) for k in ("linked_commit_shas", "linked_pr_urls", "linked_commit_urls", "linked_file_paths", "impacted_modules", "impacted_components")), F.lit(1).cast("long").alias("issue_number"), F.lit(True).alias("merged_pr_with_file_evidence"))
    cards = diagnostic.cards(spark.range(1).select(F.lit("a").alias("t")).select(F.lit("r").alias("repo"), issue.alias("issue"), case.alias("case")).repartition(1))
    assert cards.select("clarification_questions", "debug_checks", "plausible_diagnosis")._jdf.queryExecution().optimizedPlan().toString().count("regexp_replace(") <= 12


def test_an_issue_is_cut_once(spark):
    names = ("repo", "mcu_series", "board", "component", "layer", "issue_kind", "severity", "evidence_strength", "state", "issue_title", "github_url")
    texts = ["Title: t\n\nBody:\nThe [IMAGE ATTACHED] UART_1  stops. Now\n\nComments:\nIt is TIM_CR1\nthanks,", "\n", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "issue_number long, clean_text string").select("*", *(F.lit("a").alias(n) for n in names), F.lit(True).alias("rescue_applied"), F.array(F.lit("bug")).alias("labels"))
    card = df.withColumn("text", issues.issue_text()).select("issue_number", "text", issues.issue_markdown(F.col("text"), "Card").alias("markdown"))
    plan = card._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Title:") == 1 and plan.count("regexp_replace(") <= 10
    got = [r["text"].split("\n") for r in card.orderBy("issue_number").collect()]
    assert got[0][3:7] == ["Root cause: It is TIM_CR1", "Fix: The UART_1 stops.", issues.ISSUE_CONSTRAINT, "Keywords: a, bug, IMAGE, ATTACHED, UART_1"]
    assert got[0][8:] == ["Technical details:", "The [IMAGE ATTACHED] UART_1 stops. Now", "", "Key comments:", "It is TIM_CR1"]
    for lines in got[1:]:
        assert lines[3:5] == [f"Root cause: {issues.NO_CAUSE}", f"Fix: {issues.NO_FIX}"] and lines[-1] == "Technical details:"


def test_a_request_body_is_cut_once(spark):
    df = spark.createDataFrame([(" <IMG a> one two\n\n\n\nthree ",), ("![x](y)",), (None,)], "t string")
    told = df.select(text.request_body(F.col("t"), 25).alias("x"))
    assert told._jdf.queryExecution().optimizedPlan().toString().count("<img") == 1
    assert [r["x"] for r in told.collect()] == ["[IMAGE ATTACHED] one [truncated]", "[IMAGE ATTACHED]", ""]
    paths = spark.createDataFrame([("/Drivers/x_HAL_Driver/a.c",), (" \\Top\\b",), (None,)], "p string")
    assert [r[0] == r[1] for r in paths.select(tagging.module_of(F.col("p")), tagging.module_of_key(text.normalize_path(F.col("p")))).collect()] == [True] * 3
