"""Images in texts: where they are, what analysis says of them, and texts with that in their place."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loomwright.functions.rules import keyword_any, text_of
from loomwright.functions.text import strip

# Patterns of images and addresses, endings and hosts of images, words of captions, marks.
MARKDOWN_IMAGE = r"(?i)!\[[^\]]*\]\(([^)]+)\)"
HTML_IMAGE = r"""(?i)<img\b[^>]*?\bsrc\s*=\s*['"]([^'"]+)['"][^>]*>"""
ADDRESS = r"""(?i)https?://[^\s\]>'")]+"""
ENDINGS = (".png", ".jpg", ".jpeg", ".gif", ".webp", ".bmp", ".svg")
CAPTION_WORDS = ("figure", "fig.", "diagram", "overview", "architecture", "workflow", "block diagram", "illustration")
ATTACHED, UNKNOWN = "[IMAGE ATTACHED]", "[IMAGE DESCRIPTION UNAVAILABLE]"
PLACEHOLDER = r"Figure detected on page \d+, but no technical description is available yet for ([^\s]+:p\d+:f\d+)\."


def bare_url(c: Column) -> Column:
    return F.regexp_replace(strip(text_of(c)), "^[<>]+|[<>]+$", "")


def is_image_url(c: Column) -> Column:
    """An address with an image's ending, or of a host of attachments."""
    low = F.lower(bare_url(c))
    ends = low.rlike(r"\.(" + "|".join(e[1:] for e in ENDINGS) + ")$")
    hosted = F.contains(low, F.lit("/assets/")) & (F.contains(low, F.lit("user-attachments")) | F.contains(low, F.lit("github.com")))
    return low.rlike("^https?://") & (ends | hosted | F.contains(low, F.lit("objects.githubusercontent.com")))


def is_caption(c: Column) -> Column:
    return keyword_any(F.lower(strip(text_of(c))), CAPTION_WORDS)


def image_urls(c: Column) -> Column:
    """Addresses of images in a text, each once: Markdown images first, then image tags, then bare addresses."""
    t = text_of(c)
    inside = lambda g: F.when(F.trim(g).rlike("^<[^>]*>"), F.regexp_extract(F.trim(g), "^<([^>]*)>", 1)).otherwise(F.regexp_extract(F.trim(g), r"^(\S*)", 1))
    found = F.concat(F.transform(F.regexp_extract_all(t, F.lit(MARKDOWN_IMAGE), F.lit(1)), inside), F.regexp_extract_all(t, F.lit(HTML_IMAGE), F.lit(1)), F.regexp_extract_all(t, F.lit(ADDRESS), F.lit(0)))
    return F.array_distinct(F.filter(F.transform(found, bare_url), is_image_url))


def description_parts(c: Column) -> Column:
    """struct(description, ocr_text) of an answer with DESCRIPTION: and OCR_TEXT: sections; NONE is no text."""
    t = strip(text_of(c))
    told = r"(?is)DESCRIPTION\s*:\s*(.*?)(?:\n\s*OCR_TEXT\s*:|$)"
    read = strip(F.regexp_extract(t, r"(?is)OCR_TEXT\s*:\s*(.*)$", 1))
    return F.struct(F.when(t.rlike(told), strip(F.regexp_extract(t, told, 1))).otherwise(t).alias("description"), F.when(F.upper(read) == "NONE", "").otherwise(read).alias("ocr_text"))


def inline_text(analysis: Column) -> Column:
    """What stands in a text for an image: analysis is struct(image_url, status, description, ocr_text, error)."""
    told, read = F.trim(text_of(analysis["description"])), F.trim(text_of(analysis["ocr_text"]))
    joined = F.concat_ws(" ", F.when(told != "", F.concat(F.lit("[IMAGE DESCRIPTION] "), told)), F.when(read != "", F.concat(F.lit("[IMAGE TEXT] "), read)))
    return F.when((F.coalesce(analysis["status"], F.lit("")) != "ok") | (joined == ""), UNKNOWN).otherwise(joined)


def replace_attached(c: Column, analyses: Column) -> Column:
    """The k-th mark of an attached image becomes the k-th analysis; marks beyond the last one say that there is none."""
    pieces = F.split(text_of(c), r"(?i)\[IMAGE ATTACHED\]")
    told = lambda i: F.coalesce(F.get(F.transform(analyses, inline_text), i - 1), F.lit(UNKNOWN))
    return F.array_join(F.transform(pieces, lambda p, i: F.when(i == 0, p).otherwise(F.concat(told(i), p))), "")


def replace_linked(c: Column, described: Column) -> Column:
    """Markdown images and image tags whose address is a key of the map `described` become its text."""

    def replaced(text: Column, pattern: str) -> Column:
        address = lambda tag: bare_url(F.regexp_extract(F.regexp_extract(tag, pattern, 1), r"^(\S*)", 1))
        found = F.array_distinct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))
        return F.reduce(found, text, lambda acc, tag: F.replace(acc, tag, F.coalesce(F.element_at(described, address(tag)), tag)))

    return replaced(replaced(text_of(c), MARKDOWN_IMAGE), HTML_IMAGE)


def context_block(c: Column, analyses: Column) -> Column:
    """The text with a numbered list of all analyses behind it, for texts without a place for them."""

    def entry(a: Column, i: Column) -> Column:
        head = F.concat((i + 1).cast("string"), F.lit(". URL: "), text_of(a["image_url"]))
        told, read = text_of(a["description"]), text_of(a["ocr_text"])
        good = F.concat_ws("\n", head, F.concat(F.lit("   Description: "), F.when(told != "", told).otherwise("[none]")), F.when(read != "", F.concat(F.lit("   OCR Text: "), read)))
        return F.when(F.coalesce(a["status"], F.lit("")) == "ok", good).otherwise(F.concat(head, F.lit("\n   Description: [ERROR] "), F.coalesce(a["error"], F.lit("None"))))

    return F.concat(text_of(c), F.array_join(F.concat(F.array(F.lit(""), F.lit(""), F.lit("Image-derived context:")), F.transform(analyses, entry)), "\n"))


def placeholder_ids(c: Column) -> Column:
    """Ids of the figures for which a text still has a placeholder."""
    return F.regexp_extract_all(text_of(c), F.lit(PLACEHOLDER), F.lit(1))


def fill_placeholders(c: Column, described: Column) -> Column:
    """Placeholders whose id is a key of the map become its text; others stay."""
    found = F.array_distinct(F.regexp_extract_all(text_of(c), F.lit(PLACEHOLDER), F.lit(0)))
    return F.reduce(found, text_of(c), lambda acc, whole: F.replace(acc, whole, F.coalesce(F.element_at(described, F.regexp_extract(whole, PLACEHOLDER, 1)), whole)))


FIGURE_BLOCK = r"(?s)\[FIGURE_DESCRIPTIONS\](.*?)\[/FIGURE_DESCRIPTIONS\]"


def rebuilt_figure_blocks(c: Column, described: Column) -> Column:
    """Blocks of figure descriptions written anew from their ids and a map of texts, for files whose blocks broke the JSON. A block without ids stays."""

    def rebuilt(block: Column) -> Column:
        ids = F.regexp_extract_all(block, F.lit(r"-\s*([^\s:]+:[^\s:]+\.pdf:p\d+:f\d+):?\s*"), F.lit(1))
        line = lambda i: F.concat(F.lit("- "), i, F.lit(": "), F.coalesce(F.nullif(F.trim(F.element_at(described, i)), F.lit("")), F.lit("No description available.")))
        return F.when(F.size(ids) > 0, F.concat(F.lit("[FIGURE_DESCRIPTIONS] "), F.array_join(F.transform(ids, line), " "), F.lit(" [/FIGURE_DESCRIPTIONS]"))).otherwise(block)

    return F.reduce(F.array_distinct(F.regexp_extract_all(text_of(c), F.lit(FIGURE_BLOCK), F.lit(0))), text_of(c), lambda acc, b: F.replace(acc, b, rebuilt(b)))
