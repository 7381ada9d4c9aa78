"""Components, tags and answer checks of support texts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from loomwright.functions.rules import keyword_any, let, ordered_case, text_of
from loomwright.functions.text import normalize_path
from loomwright.operators.windows import ordered_distinct

# Peripherals that name a component, those that are also plain words, other spellings, and failure patterns.
COMPONENTS = (
    "ADC", "CAN", "CEC", "COMP", "CORDIC", "CORTEX", "CRC", "CRS", "CRYP", "DAC", "DCACHE", "DCMI", "DELAYBLOCK", "DFSDM", "DMA", "DMAMUX", "DMA2D",
    "DSI", "DTS", "ETH", "EXTI", "FDCAN", "FIREWALL", "FLASH", "FMAC", "FMC", "GFXMMU", "GFXTIM", "GPIO", "GPU2D", "GTZC", "HASH", "HRTIM", "HSEM",
    "HSPI", "I2C", "ICACHE", "IPCC", "IRDA", "IWDG", "JPEG", "LCD", "LPGPIO", "LPTIM", "LTDC", "MDF", "MDIOS", "MDMA", "MRSUBG", "OSPI", "OPAMP",
    "OTFDEC", "PKA", "PSSI", "PWR", "QSPI", "RAMCFG", "RAMECC", "RCC", "RNG", "RTC", "SAI", "SDMMC", "SMARTCARD", "SPDIFRX", "SPI", "SWPMI", "TIM",
    "TSC", "UART", "UCPD", "USART", "USB", "WWDG", "XSPI",
)
AMBIGUOUS = ("CAN", "COMP", "TIM")
ALIASES = {"ETHERNET": "ETH", "USB_OTG": "USB", "TIMER": "TIM", "TIMERS": "TIM"}
MISSING = ("", "none", "null", "unknown", "other", "n/a", "na")
FAILURES = (
    ("callback", "callback_not_reached"), ("busy", "state_stuck_busy"), ("timeout|timed out", "timeout"), ("block|blocking", "blocking_behavior"), ("dma", "dma_path"), ("compile|build", "compile_error"),
    ("crash|hardfault|fault", "crash_fault"), ("regression|upgrade|version", "version_regression"), ("clock", "clocking"), ("pin|gpio|mux", "pinmux"), ("irq|interrupt", "interrupt_path"), ("cache|mpu", "cache_dma"),
)
#: Words without which a version pattern is not found, and the pattern.
VERSIONS = (
    (("stm32cube",), r"(?i)\b(stm32cube[a-z0-9_-]*)\s*v(?:ersion)?\s*(\d+\.\d+\.\d+)\b"), (("cubemx", "cubeide"), r"(?i)\b(cubemx|cubeide)\s*v?(\d+\.\d+(?:\.\d+)?)\b"),
    (("hal", "ll", "cmsis"), r"(?i)\b(hal|ll|cmsis)\s*v?(\d+\.\d+(?:\.\d+)?)\b"),
)


def normalize_component(raw: Column) -> Column:
    token = F.regexp_replace(F.regexp_replace(F.upper(F.trim(text_of(raw))), "[^A-Z0-9]+", "_"), "^_+|_+$", "")
    return let(token, lambda t: reduce(lambda c, ab: F.when(t == ab[0], F.lit(ab[1])).otherwise(c), ALIASES.items(), t))


def infer_component(text: Column) -> Column:
    """struct(component, score, hits, confidence, candidates): mentions of each component, weighted, the best first.

    The first pattern takes a backslash and a b, as the reference's does, so it counts names between underscores alone."""
    t = text_of(text)

    def scored(upper: Column, c: Column) -> Column:
        # A pattern is tried only where its beginning is a part of the text, whatever its case.
        count = lambda begin, a, b: F.when(reduce(lambda x, y: x | y, (F.contains(upper, F.concat(F.lit(x), c)) for x in begin)), F.regexp_count(t, F.concat(F.lit(a), c, F.lit(b)))).otherwise(0)
        counts = [count(("\\B", "_"), r"(?i)(?:\\b|_)", r"(?:\\b|_)"), F.regexp_count(t, F.concat(F.lit("(?i)"), c, F.lit("[_A-Z0-9]+"))), count(("HAL_",), "(?i)HAL_", "[_A-Z0-9]*"), count(("LL_",), "(?i)LL_", "[_A-Z0-9]*")]
        return let(F.array(*counts), lambda n: F.struct((n[0] + n[1] * 2 + (n[2] + n[3]) * 3).alias("score"), (n[0] + n[1] + n[2] + n[3]).alias("hits"), c.alias("component")))

    # Each pattern holds the name itself, so names that are no part of the text have no hits.
    named = lambda upper: F.transform(F.filter(F.array(*map(F.lit, COMPONENTS)), lambda c: F.contains(upper, c)), lambda c: scored(upper, c))
    every = F.filter(let(F.upper(t), named), lambda s: s["hits"] > 0)
    # Larger score, then more hits, then the name.
    ordered = F.array_sort(F.transform(every, lambda s: F.struct((-s["score"]).alias("a"), (-s["hits"]).alias("b"), s["component"].alias("c"))))

    def told(ranked: Column) -> Column:
        best = F.get(ranked, F.lit(0))
        score, hits, plain = -best["a"], -best["b"], best["c"].isin(*AMBIGUOUS)
        confidence = ordered_case(
            [(best.isNull(), "none"), ((~plain & (score >= 8) & (hits >= 2)) | (plain & (score >= 20) & (hits >= 6)), "high"), ((~plain & (score >= 4)) | (plain & (score >= 10)), "medium")], "low"
        )
        texts = F.transform(F.slice(ranked, 1, 3), lambda s: F.concat(s["c"], F.lit("(score="), (-s["a"]).cast("string"), F.lit(",hits="), (-s["b"]).cast("string"), F.lit(")")))
        return F.struct(best["c"].alias("component"), F.coalesce(score, F.lit(0)).alias("score"), F.coalesce(hits, F.lit(0)).alias("hits"), confidence.alias("confidence"), F.array_join(texts, ", ").alias("candidates"))

    return let(ordered, told)


def vote_component(text: Column, labels: Column) -> Column:
    """The component of a card: its context line, else the most votes from its keywords (3), labels (2) and capitals (1).

    Too few votes or a tie give null."""
    t = text_of(text)
    known = lambda xs: F.filter(F.transform(xs, normalize_component), lambda c: c.isin(*COMPONENTS))
    context = normalize_component(F.regexp_extract(t, r"(?i)\bcomponent=([^,\n]+)", 1))
    keywords = known(F.split(F.regexp_extract(t, r"(?im)^Keywords:\s*(.+)$", 1), ","))
    marked = known(F.coalesce(labels, F.array().cast("array<string>")))
    capitals = known(F.regexp_extract_all(t, F.lit(r"\b[A-Z][A-Z0-9_\-/]{1,}\b"), F.lit(0)))

    def counted(found: Column) -> Column:
        count = lambda xs, c: F.size(F.filter(found[xs], lambda x: x == c))
        names = F.array_distinct(F.concat(found["keywords"], found["marked"], found["capitals"]))
        return F.array_sort(F.transform(names, lambda c: F.struct((-(count("keywords", c) * 3 + count("marked", c) * 2 + count("capitals", c))).alias("v"), c.alias("c"))))

    def voted(votes: Column) -> Column:
        best, second = F.get(votes, F.lit(0)), F.get(votes, F.lit(1))
        enough = -best["v"] >= F.when(best["c"].isin(*AMBIGUOUS), 3).otherwise(2)
        return F.when(enough & (second.isNull() | (second["v"] != best["v"])), best["c"])

    votes = let(F.struct(keywords.alias("keywords"), marked.alias("marked"), capitals.alias("capitals")), counted)
    return let(context, lambda own: F.when(own.isin(*COMPONENTS), own).otherwise(let(votes, voted)))


def module_of(path: Column) -> Column:
    return module_of_key(normalize_path(path))


def module_of_key(p: Column) -> Column:
    """module_of a path that is normalised."""
    known = ordered_case(
        [
            (p == "", "unknown"), (p.startswith("drivers/") & p.contains("hal_driver"), "HAL_Driver"), (p.startswith("drivers/") & p.contains("cmsis"), "CMSIS"), (p.startswith("drivers/"), "Drivers"),
            (p.startswith("middlewares/"), "Middlewares"), (p.startswith("projects/"), "Projects"), (p.startswith("utilities/"), "Utilities"), (p.startswith("documentation/"), "Documentation"),
        ],
        None,
    )
    return F.coalesce(known, F.nullif(F.substring_index(p, "/", 1), F.lit("")), F.lit("unknown"))


def api_tags(text: Column, most: int = 8) -> Column:
    """Function names of the known families, each once whatever its case."""
    return ordered_distinct(F.regexp_extract_all(text_of(text), F.lit(r"\b(?:HAL|LL|BSP|MX|CMSIS)_[A-Za-z0-9_]+\b"), F.lit(0)), most)


def failure_tags(text: Column, most: int = 8) -> Column:
    # The patterns are plain words, so parts of the text are looked for; it is made and lowered once.
    found = lambda t: F.array_compact(F.array(*(F.when(keyword_any(t, p.split("|")), F.lit(tag)) for p, tag in FAILURES)))
    return F.slice(let(F.lower(text_of(text)), found), 1, most)


def version_tags(text: Column, most: int = 8) -> Column:
    """NAME vX.Y of packages, tools and stacks."""

    def found(t: Column, low: Column, words: tuple[str, ...], pattern: str) -> Column:
        # A text is searched once and only where one of the words is in it; name and number come from the short match.
        places = F.when(keyword_any(low, words), F.regexp_extract_all(t, F.lit(pattern), F.lit(0))).otherwise(F.array().cast("array<string>"))
        return F.transform(places, lambda m: F.concat(F.upper(F.regexp_extract(m, pattern, 1)), F.lit(" v"), F.regexp_extract(m, pattern, 2)))

    every = let(text_of(text), lambda t: let(F.lower(t), lambda low: F.concat(*(found(t, low, *rule) for rule in VERSIONS))))
    return F.slice(F.array_distinct(every), 1, most)


def query_type(question: Column, tags: Column | None = None) -> Column:
    q = F.lower(text_of(question))
    error = keyword_any(q, ("error", "fault", "crash", "stuck", "nack", "unknown device"))
    if tags is not None:
        error = error | F.contains(F.lower(text_of(tags)), F.lit("debug"))
    return ordered_case([(error, "error_message"), (keyword_any(q, ("hal_", "api", "function", "register", "callback")), "api_symbol")], "how_to")


def question_id(raw: Column) -> Column:
    v = F.upper(F.trim(text_of(raw)))
    digits = F.regexp_extract(v, "([0-9]+)", 1)
    number = F.concat(F.lit("Q"), F.lpad(digits.try_cast("long").cast("string"), F.greatest(F.length(digits.try_cast("long").cast("string")), F.lit(2)), F.lit("0")))
    return F.when((v == "") | v.startswith("Q"), v).when(digits != "", number).otherwise(v)


def expected_match(answer: Column, expected: Column, mode: Column) -> Column:
    """1 or 0: whether one or all of the patterns, split at |, are found; empty where nothing is expected."""
    parts = F.filter(F.transform(F.split(text_of(expected), r"\|"), lambda x: F.trim(x)), lambda p: p != "")
    a = text_of(answer)
    hit = lambda p: F.rlike(a, F.concat(F.lit("(?i)"), p))
    return F.when(F.size(parts) == 0, "").when(F.lower(mode) == "all", F.forall(parts, hit).cast("int").cast("string")).otherwise(F.exists(parts, hit).cast("int").cast("string"))


def unlinked_reason(prs: Column, explicit: Column, inferred: Column, through: Column, merges: Column) -> Column:
    """Why an issue has no link, from whether each kind of evidence is there."""
    return ordered_case(
        [
            (~prs & ~explicit & ~inferred & ~through, "no_pr_no_commit_signal"), (prs & ~(explicit | inferred | through), "pr_reference_without_commit_trace"),
            (inferred & ~prs & ~explicit & ~through, "message_inferred_only_but_unconfirmed"), (merges & ~(explicit | inferred), "merge_only_history"),
        ],
        "other_mixed_gap",
    )
