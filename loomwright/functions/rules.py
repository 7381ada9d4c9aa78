"""Ordered rules as data: the first that holds names the class. Built once into one expression."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def text_of(c: Column | str) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def let(value: Column, f: Callable[[Column], Column]) -> Column:
    """f of a value that is computed once, also where f uses it several times or inside a lambda over an array."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def ordered_case(rules: Sequence[tuple[Column, str]], default: str | None) -> Column:
    """The label of the first condition that holds."""
    first, *rest = rules
    out = F.when(first[0], F.lit(first[1]))
    for condition, label in rest:
        out = out.when(condition, F.lit(label))
    return out.otherwise(F.lit(default))


def keyword_any(c: Column, keywords: Sequence[str]) -> Column:
    """Whether any keyword is a part of the text."""
    return reduce(lambda a, b: a | b, (F.contains(c, F.lit(k)) for k in keywords))


def keyword_classes(c: Column, groups: Sequence[tuple[str, Sequence[str]]], default: str | None, fold: Callable[[Column], Column] = F.lower) -> Column:
    """The first group with a keyword in the text."""
    t = fold(text_of(c))
    return ordered_case([(keyword_any(t, words), label) for label, words in groups], default)


def first_match(c: Column, patterns: Sequence[str]) -> Column:
    """The text of the first pattern, in order, that is found; null if none."""
    return F.coalesce(*(F.nullif(F.regexp_extract(text_of(c), p, 0), F.lit("")) for p in patterns))


def matching(c: Column, patterns: Sequence[str]) -> Column:
    """The patterns that are found in the text, in order."""
    t = text_of(c)
    return F.array_compact(F.array(*(F.when(t.rlike(p), F.lit(p)) for p in patterns)))


# Rules of the support domain, in the order that decides.
ISSUE_KINDS_TEXT = (("usage_question", ("how to", "how do i")), ("configuration_help", ("configuration", "configure", "clock configuration")))
LAYERS = (
    ("HAL", ("HAL_", " HAL DRIVER", " HAL LIBRARY")),
    ("LL", ("LL_", " LOW LAYER", "LOW-LAYER")),
    ("Middleware", ("LWIP", "FATFS", "FAT FS", "FREERTOS", "USB HOST", "USB DEVICE", "USBH_", "USBD_", "MIDDLEWARE", "TCP/IP", "TCP IP")),
    ("CubeMX", ("CUBEMX", "STM32CUBEMX", " MX_", "GENERATED BY STM32CUBEMX", "DEVICE CONFIGURATION TOOL")),
)
LOW_WORDS = ("documentation", "doc issue", "doc problem", "typo", "spelling", "comment typo", "example description", "minor issue")
LOW_LABELS = ("documentation", "doc", "typo")
HIGH_WORDS = (
    "hardfault", "hard fault", "crash", "crashes", "freeze", "frozen", "hang", "stuck", "blocking", "block forever", "deadlock", "data corruption", "corrupted data",
    "doesn't start", "does not start", "cannot start", "no communication", "watchdog reset", "wdg reset", "reset loop", "infinite loop", "regression",
)
BOARDS = (r"NUCLEO-[A-Z0-9]+", r"STM32H7[0-9A-Z]+", r"STM32F4[0-9A-Z]+", r"STM32F7[0-9A-Z]+")
COMPONENTS = (
    ("ETH", ("ethernet", " lan ", " eth ")), ("USB", ("usb", "usb device", "usb_device")), ("ADC", ("adc",)), ("DMA", (" dma ",)), ("UART", ("uart", "usart")),
    ("CAN", ("fdcan", " bxcan", " hal_can_", " can1", " can2", "can bus", "canfd")), ("FREERTOS", ("freertos",)),
)
SIGNALS = (
    r"(?i)\bHAL_[A-Za-z0-9_]+\b", r"(?i)\bLL_[A-Za-z0-9_]+\b", r"(?i)\bDMA\b", r"(?i)\bstuck\s+busy\b", r"(?i)\bblocking\b", r"(?i)\bdeadlock\b", r"(?i)\btimeout\b",
    r"(?i)\bhardfault\b|\bhard\s+fault\b", r"(?i)\bcallback\b", r"(?i)\breproduc(e|ible|tion)\b",
)
INVALID_LABELS = ("invalid", "duplicate", "wontfix")
ANCHOR = r"\b([A-Z]{2,}[A-Z0-9_\-]{1,}|[A-Za-z]+_[A-Za-z0-9_]+)\b"
METADATA_FILES = ("code_of_conduct.md", "contributing.md", "license.md", "security.md", "sw_security_level.md", "package.xml", "sbom_cdx.json", ".deliveryignore", ".gitmodules")
RUBRIC = (
    ("cite", 2, r"(?i)issue\s*#\s*\d+|#\d{1,5}\b"), ("hal", 1, r"\b(?:HAL|LL)_[A-Za-z0-9_]+\("), ("act", 2, r"(?m)```|^\s*\d+[).]\s"),
    ("ver", 2, r"(?i)\bv\d+\.\d+(\.\d+)?\b|release[_ ]notes?"), ("work", 2, r"(?i)\bregister|\bflag\b|cache|DCache|MPU|clean|invalidate|workaround|errata|align"),
    ("src", 1, r"(?i)readme|release_notes|\.c\b|\.h\b|issue\s*#|commit"),
)
NO_ANSWER = r"(?i)request timeout|could not find enough reliable information"


def lower_all(labels: Column) -> Column:
    return F.transform(F.coalesce(labels, F.array().cast("array<string>")), F.lower)


def issue_kind(text: Column, labels: Column) -> Column:
    low = lower_all(labels)
    t = F.lower(text_of(text))
    return ordered_case(
        [
            (F.arrays_overlap(low, F.array(F.lit("bug"), F.lit("internal bug tracker"))), "bug_report"),
            (keyword_any(t, ISSUE_KINDS_TEXT[0][1]) | F.array_contains(low, "question"), "usage_question"),
            (keyword_any(t, ISSUE_KINDS_TEXT[1][1]), "configuration_help"),
        ],
        "other",
    )


def layer(text: Column) -> Column:
    return keyword_classes(text, LAYERS, "Other", F.upper)


def severity(text: Column, labels: Column) -> Column:
    t = F.lower(text_of(text))
    low = F.arrays_overlap(lower_all(labels), F.array(*map(F.lit, LOW_LABELS))) | keyword_any(t, LOW_WORDS)
    return ordered_case([(low, "low"), (keyword_any(t, HIGH_WORDS), "high")], "medium")


def board(text: Column) -> Column:
    return first_match(F.upper(text_of(text)), BOARDS)


def component(text: Column) -> Column:
    return keyword_classes(F.concat(F.lit(" "), text_of(text), F.lit(" ")), COMPONENTS, None)


def has_invalid_label(labels: Column) -> Column:
    return F.arrays_overlap(lower_all(labels), F.array(*map(F.lit, INVALID_LABELS)))


def validity(text: Column, labels: Column, short: int = 100, rescue_chars: int = 120) -> Column:
    """struct(is_valid, reasons, rescued): short or badly labelled texts are out, unless long enough with a signal."""
    t = text_of(text)
    reasons = F.array_compact(F.array(F.when(has_invalid_label(labels), F.lit("invalid_label")), F.when(F.length(t) < short, F.lit("short_text"))))
    rescued = (F.size(reasons) > 0) & (F.length(t) >= rescue_chars) & (F.size(matching(t, SIGNALS)) > 0)
    return F.struct(((F.size(reasons) == 0) | rescued).alias("is_valid"), F.when(rescued, F.array().cast("array<string>")).otherwise(reasons).alias("reasons"), rescued.alias("rescued"))


def evidence_strength(text: Column, confirmed: Column, valid: Column) -> Column:
    anchors, signals = F.regexp_count(text_of(text), F.lit(ANCHOR)), F.size(matching(text, SIGNALS))
    strong = (anchors >= 2) | (signals >= 2)
    return ordered_case([(~valid, "low"), (confirmed & strong, "high"), (strong, "medium")], "low")


def file_type(path: Column) -> Column:
    p = F.lower(F.replace(text_of(path), F.lit("\\"), F.lit("/")))
    return ordered_case(
        [
            (p.rlike(r"^documentations?/") & p.endswith(".pdf"), "documentation_pdf"),
            (p.rlike("release_notes|releasenotes"), "release_notes"),
            (p.contains("projects/"), "project_readme"),
            (p.rlike(r"readme\.(md|txt)$") & p.contains("/documentation/"), "doc_readme"),
            (p.rlike(r"readme\.(md|txt)$"), "root_readme"),
            (p.isin(*METADATA_FILES), "repo_metadata"),
            (p.startswith("drivers/"), "driver_source"),
            (p.rlike("^(src|inc)/"), "hal_driver_source"),
            (p.startswith("middlewares/"), "middleware_source"),
            (p.startswith("utilities/"), "utilities_content"),
            (p.startswith("components/"), "bsp_component_source"),
            (p.rlike("^(include|source)/"), "cmsis_source"),
            (p.rlike(r"^stm32[^/]*(-dk|-eval|-disco|nucleo)") | (~p.contains("/") & p.rlike(r"^stm32.*\.(c|h|hpp|s|asm)$")), "bsp_board_source"),
        ],
        "other",
    )


def series_of(repo: Column) -> Column:
    up = F.upper(text_of(repo))
    return ordered_case([(up.contains(s), s) for s in ("H7", "F4", "H5")], None)


def issue_numbers(text: Column) -> Column:
    """Numbers of issues that a text refers to, by four patterns, in that order, each once."""
    t = text_of(text)
    found = [F.regexp_extract_all(t, F.lit(p), F.lit(1)) for p in (r"#(\d+)", r"(?i)(?:issues|issue)/(\d+)", r"(?i)\bissue\s*#?\s*(\d+)\b", r"(?i)\b(?:fixe[sd]?|close[sd]?|resolve[sd]?)\s*:?\s*#?(\d+)\b")]
    return F.array_distinct(F.transform(F.concat(*found), lambda x: x.try_cast("long")))


def commit_issue_numbers(message: Column) -> Column:
    """As issue_numbers for commits: positive, and bare numbers only beside a resolving verb or an issue word."""
    t = text_of(message)
    word, url = r"(?i)\bissue\s*#?\s*(\d+)\b", r"(?i)issues?/(\d+)"
    found = F.array_distinct(F.filter(F.transform(F.concat(*(F.regexp_extract_all(t, F.lit(p), F.lit(1)) for p in (word, url, r"#(\d+)"))), lambda x: x.try_cast("long")), lambda x: x > 0))
    anchored = t.rlike(r"(?i)\b(fix(e[sd])?|close[sd]?|resolve[sd]?)\b") | t.rlike(word) | t.rlike(url)
    return F.when(anchored, found).otherwise(F.array().cast("array<bigint>"))


def rubric(text: Column) -> Column:
    """struct of the features' points and their total; none where there is no answer."""
    t = text_of(text)
    none = (t == "") | t.rlike(NO_ANSWER)
    points = [F.when(~none & t.rlike(p), w).otherwise(0).alias(name) for name, w, p in RUBRIC]
    total = reduce(lambda a, b: a + b, (F.when(~none & t.rlike(p), w).otherwise(0) for _, w, p in RUBRIC))
    return F.struct(*points, total.alias("total"), none.alias("no_answer"))


def score_band(c: Column, bands: Sequence[tuple[float, str]], default: str) -> Column:
    """The label of the first bound that the score reaches."""
    return ordered_case([(c >= bound, label) for bound, label in bands], default)


