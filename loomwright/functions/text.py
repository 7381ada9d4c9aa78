"""Text cleaning as Column functions. Null reads as the empty text unless said otherwise."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loomwright.functions.rules import let, text_of


def normalize_newlines(c: Column) -> Column:
    return F.regexp_replace(text_of(c), r"\r\n?", "\n")


def strip(c: Column) -> Column:
    """White space off both ends; Spark's trim takes spaces alone. Only the ends are looked at, so long texts and long runs of blanks cost little."""
    return F.btrim(c, F.lit(" \t\n\x0b\f\r"))


def normalize_whitespace(c: Column) -> Column:
    return F.trim(F.regexp_replace(text_of(c), r"\s+", " "))


#: Entities in the order of their replacement, the ampersand first (fixed values).
ENTITIES = (("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&nbsp;", " "), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"))


def strip_html(c: Column) -> Column:
    """HTML to text: no comments, scripts, styles, heads and tags, entities decoded, blank lines dropped."""
    t = F.regexp_replace(text_of(c), r"(?s)<!--.*?-->", "")
    t = F.regexp_replace(t, r"(?is)<(script|style|head)[^>]*>.*?</\1>", "")
    t = F.regexp_replace(t, r"<[^>]+>", " ")
    for entity, char in ENTITIES:
        t = F.replace(t, F.lit(entity), F.lit(char))
    t = _numeric_entities(t)
    t = F.regexp_replace(t, r"[ \t]+", " ")
    lines = F.filter(F.transform(F.split(t, "\n"), strip), lambda x: x != "")
    return F.array_join(lines, "\n")


def _decoder(mark: str, base: int):
    """A fold step: the character for one number, in all its places."""

    def step(acc: Column, ref: Column) -> Column:
        utf32 = F.unhex(F.lpad(F.conv(ref, base, 16), 8, "0"))
        return F.replace(acc, F.concat(F.lit(mark), ref, F.lit(";")), F.decode(utf32, "UTF-32"))

    return step


def _numeric_entities(c: Column) -> Column:
    """Decimal, then hexadecimal character references."""
    def decoded(t: Column, mark: str, digits: str, base: int) -> Column:
        found = F.array_distinct(F.regexp_extract_all(t, F.lit(f"{mark}({digits});"), F.lit(1)))
        return F.when(F.contains(t, F.lit(mark)), F.reduce(found, t, _decoder(mark, base))).otherwise(t)

    # Each step names its text several times, and the text is the outcome of all steps before.
    return let(let(c, lambda t: decoded(t, "&#", r"\d{1,7}", 10)), lambda t: decoded(t, "&#x", "[0-9a-fA-F]{1,6}", 16))


def clean_markdown(c: Column) -> Column:
    t = F.regexp_replace(text_of(c), r"!\[[^\]]*\]\(https?://img\.shields\.io[^)]*\)", "")
    t = F.regexp_replace(t, r"!\[[^\]]*\]\([^)]+\)", "[image removed]")
    t = F.regexp_replace(t, r"\[([^\]]+)\]\(\)", "$1")
    t = F.regexp_replace(t, r"(?i)<(br|hr|img|div|span|center|p)\b[^>]*/?>", "")
    t = F.regexp_replace(t, r"(?m)^https?://img\.shields\.io[^\n]*$", "")
    return strip(F.regexp_replace(t, r"\n{3,}", "\n\n"))


def clean_source_code(c: Column) -> Column:
    """C source without its first license comment (searched in 3000 characters), license lines and empty comments."""
    code = text_of(c)
    block = F.regexp_extract(F.substring(code, 1, 3000), r"(?is)/\*\*.*?(?:Copyright|STMicroelectronics|Licensed|SPDX).*?\*/", 0)
    without = lambda b, at: F.concat(F.substring(code, F.lit(1), at - 1), F.substring(code, at + F.length(b), F.length(code)))
    code = let(block, lambda b: F.when(b != "", let(F.instr(code, b), lambda at: without(b, at))).otherwise(code))
    code = F.regexp_replace(code, r"(?im)^\s*(\*|//).*(?:Copyright|All rights reserved|Licensed under|SPDX-License|Permission is hereby).*$", "")
    code = F.regexp_replace(code, r"/\*\*?\s*\*/", "")
    return strip(F.regexp_replace(code, r"\n{3,}", "\n\n"))


def xml_metadata(c: Column, tags: tuple[str, ...]) -> Column:
    """`tag: value` lines of the tags that are there, else the text of the markup."""
    line = lambda t: let(F.regexp_extract(c, rf"(?is)<{t}[^>]*>(.*?)</{t}>", 1), lambda found: F.when(found != "", F.concat(F.lit(f"{t}: "), strip(found))))
    return let(F.concat_ws("\n", *map(line, tags)), lambda lines: F.when(lines != "", lines).otherwise(strip_html(c)))


def json_metadata(c: Column, most: int = 20) -> Column:
    """Name, version and type, the number of dependencies and the first of them of a bill of materials; 2000 characters of what holds none or is no JSON, nothing of a JSON null."""
    v = F.try_parse_json(c)
    told = lambda node, key, default: F.coalesce(F.try_variant_get(node, f"$.{key}", "string"), F.lit(default))
    own = F.try_variant_get(v, "$.metadata.component", "variant")
    parts = F.try_variant_get(v, "$.components", "array<variant>")
    names = F.transform(F.slice(parts, 1, most), lambda x: F.concat(F.lit("  - "), told(x, "name", ""), F.lit(" "), told(x, "version", "")))
    lines = F.concat_ws(
        "\n", *(F.when(own.isNotNull(), F.concat(F.lit(f"{label}: "), told(own, key, "N/A"))) for label, key in (("Name", "name"), ("Version", "version"), ("Type", "type"))),
        F.concat(F.lit("Dependencies count: "), F.size(parts)), F.nullif(F.array_join(names, "\n"), F.lit("")), F.when(F.size(parts) > most, F.concat(F.lit("  ... and "), F.size(parts) - most, F.lit(" more"))),
    )
    return F.when(v.isNotNull() & (lines != ""), lines).when(F.is_variant_null(v), "").otherwise(F.substring(text_of(c), 1, 2000))


def take_images(c: Column) -> Column:
    """struct(text, urls): image tags become a mark and their sources are collected; back quotes go."""
    t = normalize_newlines(c)
    pattern = r"""(?is)<img\b[^>]*?\bsrc\s*=\s*["']([^"']+)["'][^>]*>"""
    urls = F.regexp_extract_all(t, F.lit(pattern), F.lit(1))
    return F.struct(strip(F.replace(F.regexp_replace(t, pattern, "[IMAGE ATTACHED]"), F.lit("`"), F.lit(""))).alias("text"), urls.alias("urls"))


def first_sentence(c: Column, most: int = 260) -> Column:
    """Up to the first of . ! ? if that lies within `most` characters, else so many characters."""
    return lead(normalize_whitespace(c), most)


def lead(t: Column, most: int) -> Column:
    """first_sentence of a text with single spaces; one search, so that the text is named once."""
    return F.rtrim(F.regexp_extract(t, rf"(?s)^(?:[^.!?]{{0,{most - 1}}}[.!?]|.{{0,{most}}})", 0))


def truncate_text(c: Column, most: int) -> Column:
    """struct(text, truncated)."""
    t = text_of(c)
    cut = F.length(t) > most
    return F.struct(F.when(cut, F.rtrim(F.substring(t, 1, most))).otherwise(t).alias("text"), cut.alias("truncated"))


def slugify(c: Column, most: int = 80) -> Column:
    t = F.regexp_replace(F.lower(text_of(c)), "[^a-z0-9]+", "-")
    t = F.substring(F.regexp_replace(t, "^-+|-+$", ""), 1, most)
    return F.when(t == "", F.lit("untitled")).otherwise(t)


def cut_at_space(c: Column, most: int = 1500, mark: str = " [truncated]") -> Column:
    """At most so many characters, cut at the last space, with a mark where cut."""
    head = lambda t: F.regexp_replace(F.substring(t, 1, most), " [^ ]*$", "")
    return let(strip(text_of(c)), lambda t: F.when(F.length(t) <= most, t).otherwise(F.concat(head(t), F.lit(mark))))


def normalize_path(c: Column) -> Column:
    return F.lower(F.regexp_replace(F.trim(F.replace(text_of(c), F.lit("\\"), F.lit("/"))), "^/+", ""))


def blob_url(owner: str, repo: Column, path: Column, ref: str = "master") -> Column:
    """A file's web address, each part of the path percent-encoded, slashes kept."""
    def encoded(part: Column) -> Column:
        # What a form's encoding writes in another way than an address does.
        return F.replace(F.replace(F.replace(F.url_encode(part), F.lit("+"), F.lit("%20")), F.lit("%7E"), F.lit("~")), F.lit("*"), F.lit("%2A"))

    parts = F.transform(F.split(path, "/"), encoded)
    return F.concat(F.lit(f"https://github.com/{owner}/"), repo, F.lit(f"/blob/{ref}/"), F.array_join(parts, "/"))


def split_items(c: Column, separator: str = ",") -> Column:
    """The trimmed, non-empty items of a list in a text."""
    return F.filter(F.transform(F.split(text_of(c), separator), lambda x: F.trim(x)), lambda x: x != "")


def key_values(c: Column, keys: tuple[str, ...]) -> Column:
    """map of `KEY: value` lines for a set of keys; the last line of a key wins."""
    pattern = rf"^({'|'.join(keys)}):\s*(.*)$"
    lines = F.filter(F.split(text_of(c), "\n"), lambda x: x.rlike(pattern))
    # Later lines first, then the first of each key.
    pairs = F.transform(F.reverse(lines), lambda x: F.struct(F.regexp_extract(x, pattern, 1).alias("k"), F.trim(F.regexp_extract(x, pattern, 2)).alias("v")))
    once = F.reduce(pairs, F.array().cast("array<struct<k:string,v:string>>"), lambda acc, p: F.when(F.exists(acc, lambda a: a["k"] == p["k"]), acc).otherwise(F.array_append(acc, p)))
    return F.map_from_entries(once)


# Sections of a register header and their titles, sign-offs, and prefixes of talk without signal.
IRQ_ENUM = r"(?s)(typedef\s+enum\s*\{[^}]*IRQn[^}]*\}[^;]*;)"
REGISTER_STRUCT = r"(?s)(typedef\s+struct\s*\{[^}]{10,2000}\}\s*\w+_TypeDef\s*;)"
BASE_ADDRESS = r"^#define\s+(\w+_BASE|PERIPH_BASE)\s+"
IRQ_TITLE, BASE_TITLE, STRUCT_TITLE = "/* ===== Interrupt Number Definition ===== */", "\n/* ===== Peripheral Base Addresses ===== */", "\n/* ===== Peripheral Register Structures ===== */"
SIGN_OFFS = ("with regards,", "best regards,", "regards,", "thanks,")
TALK = ("hi @", "hello @", "thank you", "thanks", "best regards", "with regards", "st internal reference")
METADATA_TAGS = ("name", "version", "description", "license", "url", "PackName", "PackVersion")


def register_header(c: Column) -> Column:
    """Of a device's register header the interrupt numbers, base addresses and register structures, under a summary; else its first 5000 characters."""
    code = text_of(c)
    kept = F.struct(F.regexp_extract(code, IRQ_ENUM, 1).alias("irq"), F.filter(F.transform(F.split(code, "\n"), strip), lambda x: x.rlike(BASE_ADDRESS)).alias("bases"), F.regexp_extract_all(code, F.lit(REGISTER_STRUCT), F.lit(1)).alias("structs"))
    return let(kept, lambda x: _header_of(code, x["irq"], x["bases"], x["structs"]))


def _header_of(code: Column, irq: Column, bases: Column, structs: Column) -> Column:
    defines = F.regexp_count(code, F.lit("#define"))
    number = lambda n: F.format_number(n, 0)
    summary = F.concat(
        F.lit("/* CMSIS Device Header — Filtered for RAG relevance */\n/* Original: "), number(F.length(code)), F.lit(" chars, "), number(defines), F.lit(" #defines */\n/* Kept: IRQ enum, "),
        F.size(bases).cast("string"), F.lit(" base addresses, "), F.size(structs).cast("string"), F.lit(" peripheral structs */\n/* Full file: see GitHub link for complete register map */\n"),
    )
    sections = F.array_compact(F.concat(
        F.when(irq != "", F.array(F.lit(IRQ_TITLE), irq)).otherwise(F.array().cast("array<string>")),
        F.when(F.size(bases) > 0, F.array(F.lit(BASE_TITLE), F.array_join(bases, "\n"))).otherwise(F.array().cast("array<string>")),
        F.when(F.size(structs) > 0, F.concat(F.array(F.lit(STRUCT_TITLE)), structs)).otherwise(F.array().cast("array<string>")),
    ))
    return F.concat(summary, let(sections, lambda x: F.when(F.size(x) > 0, F.array_join(x, "\n\n")).otherwise(F.substring(code, 1, 5000))))


def clean_by_type(c: Column, kind: Column, path: Column) -> Column:
    """The cleaning that a file's type, ending and size ask for; an empty text stays empty."""
    from loomwright.functions.paths import is_register_header, suffix

    end, text = suffix(path), text_of(c)
    sources = ("driver_source", "hal_driver_source", "bsp_board_source", "middleware_source", "cmsis_source", "bsp_component_source", "utilities_content")
    code = end.isin(".c", ".h", ".hpp", ".hh", ".s", ".asm")
    return (
        F.when(text == "", "")
        .when((kind == "release_notes") & end.isin(".html", ".htm"), strip_html(text))
        .when(kind.isin("root_readme", "project_readme", "doc_readme"), clean_markdown(text))
        .when(kind.isin(*sources) & code & is_register_header(path, F.length(text)), register_header(text))
        .when(kind.isin(*sources) & code, clean_source_code(text))
        .when(kind.isin(*sources, "release_notes") & end.isin(".md", ".txt"), clean_markdown(text))
        .when((kind == "repo_metadata") & (end == ".xml"), xml_metadata(text, METADATA_TAGS))
        .when((kind == "repo_metadata") & (end == ".json"), json_metadata(text))
        .when((kind == "repo_metadata") & (end == ".md"), clean_markdown(text))
        .when(kind == "documentation_pdf", strip(F.regexp_replace(text, r"\n{3,}", "\n\n")))
        .otherwise(strip(text))
    )


def without_noisy_lines(c: Column) -> Column:
    """Comments without the lines `[author - date` and without sign-offs."""
    kept = F.filter(F.split(text_of(c), "\r\n|\n|\r"), lambda x: ~strip(x).rlike(r"^\[[A-Za-z0-9_-]+\s-\s\d{4}-\d{2}-\d{2}T") & ~F.lower(strip(x)).isin(*SIGN_OFFS))
    return strip(F.array_join(kept, "\n"))


def compact_comments(c: Column, most: int) -> Column:
    """Comments without noisy lines, blank lines single, at most so many characters."""
    return strip(F.substring(strip(F.regexp_replace(without_noisy_lines(c), r"\n{3,}", "\n\n")), 1, most))


def is_talk(c: Column) -> Column:
    """A greeting, thanks or nothing at all: no signal."""
    return is_plain_talk(normalize_whitespace(c))


def is_plain_talk(t: Column) -> Column:
    """is_talk of a text with single spaces."""
    return F.lower(t).rlike(rf"^(?:\z|{'|'.join(TALK)})")


def signal_sentence(c: Column, most: int = 260) -> Column:
    """The first sentence, or nothing if it is talk."""
    return let(first_sentence(c, most), lambda s: F.when(is_plain_talk(s), "").otherwise(s))


def request_body(c: Column, most: int = 1500) -> Column:
    """A request's text for a card: images marked, blank lines single, cut at a space."""
    t = F.regexp_replace(F.regexp_replace(strip(text_of(c)), r"!\[[^\]]*\]\([^)]+\)", "[IMAGE ATTACHED]"), r"(?i)<img\b[^>]*>", "[IMAGE ATTACHED]")
    return cut_at_space(F.regexp_replace(t, r"\n{3,}", "\n\n"), most)


def clean_context(c: Column) -> Column:
    """A context without what image analysis has added to it."""
    t = F.substring_index(text_of(c), "\n\nImage-derived context:", 1)
    return normalize_whitespace(F.regexp_replace(t, r"(?i)\[IMAGE (DESCRIPTION|TEXT)\]", " "))


def technical_body(c: Column) -> Column:
    """What follows the `Technical details:` line of a card; the whole text without one."""
    t = text_of(c)
    mark = "\nTechnical details:\n"
    at = F.when(F.instr(t, "\n" + mark) > 0, F.instr(t, "\n" + mark) + 1).otherwise(F.instr(t, mark))
    return strip(F.when(at > 0, F.substring(t, at + len(mark), F.length(t))).otherwise(t))


def unescaped_url(base: str, repo: Column, path: Column) -> Column:
    """A file's address with the path as it is; null without a path."""
    p = F.regexp_replace(F.replace(text_of(path), F.lit("\\"), F.lit("/")), "^/+", "")
    return F.when(p != "", F.concat(F.lit(base), repo, F.lit("/blob/master/"), p))


def json_escaped(c: Column) -> Column:
    """A text as it stands inside a JSON string."""
    out = F.replace(text_of(c), F.lit("\\"), F.lit("\\\\"))
    for char, code in (('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        out = F.replace(out, F.lit(char), F.lit(code))
    return out


def access_token(*fields: Column) -> Column:
    """SHA-1 of the fields, joined by underscores, in lower-case hex."""
    return F.sha1(F.concat_ws("_", *fields))


def relaxed_pairs(c: Column) -> Column:
    """map of an object whose quotes a shell has eaten: `{a:b,c:d}`, keys up to the first colon, values to the next `,key:`.

    null where there are no braces. Values that are base64 of such an object are given by `decoded_pairs`."""
    t = F.regexp_replace(F.trim(F.regexp_replace(F.trim(text_of(c)), r"""^["'](.*)["']$""", "$1")), "^@", "")
    inner = F.regexp_extract(F.trim(t), r"(?s)^\{(.*)\}$", 1)
    bare = r"""^["'\s]+|["'\s]+$"""
    items = F.filter(F.split(inner, r""",(?=\s*["']?[A-Za-z_][A-Za-z0-9_]*["']?\s*:)"""), lambda x: F.contains(x, F.lit(":")))
    entry = lambda x: F.struct(F.regexp_replace(F.substring_index(x, ":", 1), bare, "").alias("k"), F.regexp_replace(F.substring(x, F.instr(x, ":") + 1, F.length(x)), bare, "").alias("v"))
    return F.when(F.trim(t).rlike(r"(?s)^\{.*\}$"), F.map_from_entries(F.transform(items, entry)))


def decoded_pairs(c: Column) -> Column:
    """relaxed_pairs of a text in base64; null where it is none."""
    return relaxed_pairs(F.try_to_binary(c, F.lit("base64")).cast("string"))
