"""Functions on the hand-written fixture cases."""

import pytest
from pyspark.sql import functions as F

from loomwright.functions import rules, text
from loomwright.operators import chunking, similarity


def value(spark, column, **row):
    ddl = ", ".join(f"{k} {'array<string>' if isinstance(v, list) else 'double' if isinstance(v, float) else 'string'}" for k, v in row.items())
    return spark.createDataFrame([tuple(row.values())], ddl).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "function, given, want",
    [
        (text.strip_html, "<p>a&amp;b</p><!--x--><script>z</script>", "a&b"), (text.strip_html, "&#65;&#x42;&#8364;", "AB€"), (text.strip_html, "&amp;lt;b", "<b"), (text.strip_html, None, ""),
        (text.clean_markdown, "![b](https://img.shields.io/x) ![i](u.png) [t]()", "[image removed] t"), (text.slugify, "  Hello, World!! ", "hello-world"), (text.slugify, "!!!", "untitled"),
        (lambda c: text.first_sentence(c, 260), "Use v1.11. Then", "Use v1."), (text.normalize_newlines, "a\r\nb\rc", "a\nb\nc"), (text.normalize_path, " \\A\\b.C", "a/b.c"),
        (text.clean_source_code, "/** Copyright x */\n\nint a;\n// All rights reserved\n\n\n\nint b;", "int a;\n\nint b;"),
        (rules.file_type, "Documentation/UM1.pdf", "documentation_pdf"), (rules.file_type, "Projects/A/main.c", "project_readme"), (rules.file_type, "Drivers/X/Release_Notes.html", "release_notes"),
        (rules.file_type, "package.xml", "repo_metadata"), (rules.file_type, "Src/a.c", "hal_driver_source"), (rules.file_type, "Include/b.h", "cmsis_source"), (rules.file_type, "foo/bar", "other"),
        (rules.layer, "HAL_SPI fails with FreeRTOS", "HAL"), (rules.layer, "lwIP drops", "Middleware"), (rules.layer, "CubeMX output", "CubeMX"), (rules.layer, "", "Other"),
        (rules.board, "nucleo-h743zi board", "NUCLEO-H743ZI"), (rules.component, "dma", "DMA"), (rules.component, "dmamux", None), (rules.series_of, "STM32CubeH7RS", "H7"), (rules.series_of, "STM32CubeG4", None),
        (rules.issue_numbers, "Fixes #12 and issue 7", [12, 7]), (rules.commit_issue_numbers, "Fixes #12 and issue 7", [7, 12]), (rules.issue_numbers, "see /issues/33", [33]), (rules.commit_issue_numbers, "bump #5", []),
        (rules.issue_numbers, "closes: 8", [8]), (rules.issue_numbers, "fix 9", []), (rules.issue_numbers, None, []),
    ],
)
def test_text_to_value(spark, function, given, want):
    assert value(spark, function(F.col("t")), t=given) == want


def test_images_truncation_and_rules(spark):
    assert value(spark, text.take_images(F.col("t")), t="a <IMG src='u'> `c`").asDict() == {"text": "a [IMAGE ATTACHED] c", "urls": ["u"]}
    assert tuple(value(spark, text.truncate_text(F.col("t"), 3), t="abcdef")) == ("abc", True)
    assert value(spark, rules.issue_kind(F.col("t"), F.col("l")), t="any", l=["Bug"]) == "bug_report"
    assert value(spark, rules.issue_kind(F.col("t"), F.col("l")), t="How do I configure", l=[]) == "usage_question"
    assert value(spark, rules.severity(F.col("t"), F.col("l")), t="typo causes crash", l=[]) == "low"
    assert value(spark, rules.severity(F.col("t"), F.col("l")), t="please change the name", l=[]) == "high"
    v = value(spark, rules.validity(F.col("t"), F.col("l")), t="x" * 120 + " HAL_X", l=["duplicate"])
    assert (v["is_valid"], v["rescued"]) == (True, True)
    v = value(spark, rules.validity(F.col("t"), F.col("l")), t="x" * 80 + " HAL_X", l=[])
    assert (v["is_valid"], v["reasons"], v["rescued"]) == (False, ["short_text"], False)
    r = value(spark, rules.rubric(F.col("t")), t="See issue #12, HAL_Init() in readme v1.2")
    assert (r["cite"], r["hal"], r["act"], r["ver"], r["work"], r["src"], r["total"]) == (2, 1, 0, 2, 0, 1, 6)
    assert value(spark, text.key_values(F.col("t"), ("A", "B")), t="A: 1\nB: 2\nA: 3") == {"A": "3", "B": "2"}
    assert value(spark, text.json_metadata(F.col("t")), t="no json") == "no json"
    bill = '{"metadata": {"component": {"name": "n", "version": 1, "type": "lib"}}, "components": [{"name": "a", "version": "2"}], "dependencies": ["x", "y"]}'
    assert value(spark, text.json_metadata(F.col("t")), t=bill) == "Name: n\nVersion: 1\nType: lib\nDependencies count: 1\n  - a 2"
    many = '{"components": [' + ", ".join(f'{{"name": "c{i}"}}' for i in range(23)) + "]}"
    assert value(spark, text.json_metadata(F.col("t")), t=many).split("\n")[0::20] == ["Dependencies count: 23", "  - c19 "]
    assert value(spark, text.json_metadata(F.col("t")), t=many).endswith("  ... and 3 more")
    assert value(spark, text.json_metadata(F.col("t")), t='{"metadata": {"component": {}}}') == "Name: N/A\nVersion: N/A\nType: N/A"


@pytest.mark.parametrize("given, most, ordered, want", [("aa\n\nbb\n\ncccc", 6, False, ["aa\n\nbb", "cccc"]), ("", 6, False, []), ("aa\n\nxxxxxxxx", 6, False, ["xxxxxx", "aa\n\nxx"]), ("aa\n\nxxxxxxxx", 6, True, ["aa", "xxxxxx", "xx"])])
def test_paragraphs(spark, given, most, ordered, want):
    assert value(spark, chunking.paragraphs(F.col("t"), most, in_text_order=ordered), t=given) == want


def test_similarity(spark):
    a, b = F.array(F.lit("dma"), F.lit("error")), F.array(F.lit("dma"), F.lit("spi"))
    assert value(spark, similarity.overlap_ratio(a, b), t="") == 0.5
    none = F.array().cast("array<string>")
    assert value(spark, similarity.jaccard(none, none), t="") == 0.0
    assert value(spark, similarity.coherence(F.lit(1.0), F.lit(0.5), F.lit(0.0)), t="") == pytest.approx(0.7)
    assert value(spark, similarity.coherence(F.lit(1.0), F.lit(0.5), F.lit(0.5)), t="") == pytest.approx(0.42)
    assert value(spark, similarity.cosine(F.array(F.lit(1.0), F.lit(0.0)), F.array(F.lit(1.0), F.lit(1.0))), t="") == pytest.approx(0.70710678)
