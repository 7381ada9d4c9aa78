"""Paths of source trees: which files to take in, where they belong, and what they are named after."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loomwright.functions.rules import text_of

# Suffixes of documents and of technical texts, metadata files at the top, roots of sources, marks of board folders.
DOCUMENTS = (".md", ".txt", ".htm", ".html")
TECHNICAL = (".c", ".h", ".hpp", ".hh", ".s", ".asm", ".ld", ".mk", ".cmake", ".dox", ".rst", ".xml", ".json", ".yml", ".yaml", ".ini", ".cfg", ".conf", ".csv")
TOP_METADATA = (".deliveryignore", ".gitmodules", "code_of_conduct.md", "contributing.md", "license.md", "security.md", "sw_security_level.md", "package.xml", "sbom_cdx.json")
SOURCE_ROOTS = ("drivers", "middlewares", "utilities", "components", "include", "source", "inc", "src")
BOARD_MARKS = ("-dk", "-eval", "-disco", "nucleo")
#: Register headers above this many characters are filtered, not cleaned (fixed value).
HEADER_CHARS = 100_000


def slashed(path: Column) -> Column:
    return F.replace(text_of(path), F.lit("\\"), F.lit("/"))


def parts(path: Column) -> Column:
    """The steps of a path from the root; none for an empty one."""
    return F.filter(F.split(slashed(path), "/"), lambda p: p != "")


def file_name(path: Column) -> Column:
    """The last step, in lower case."""
    return F.lower(F.coalesce(F.get(F.reverse(parts(path)), F.lit(0)), F.lit("")))


def suffix(path: Column) -> Column:
    """The ending from the last dot, in lower case; none where the name begins or ends with that dot."""
    return F.regexp_extract(file_name(path), r"^.+(\.[^.]+)$", 1)


def root(path: Column) -> Column:
    return F.lower(F.coalesce(F.get(parts(path), F.lit(0)), F.lit("")))


def is_document(path: Column) -> Column:
    return suffix(path).isin(*DOCUMENTS)


def is_board_root(name: Column) -> Column:
    """Whether a top folder holds the support package of a board."""
    low = F.lower(name)
    return low.rlike(f"^stm32.*({'|'.join(BOARD_MARKS)})") | low.rlike(f"^stm32({'|'.join(BOARD_MARKS)})")


def is_project_readme(path: Column) -> Column:
    steps = parts(path)
    return (F.size(steps) >= 2) & (F.get(steps, F.lit(0)) == "Projects") & file_name(path).startswith("readme") & is_document(path)


def is_release_notes(path: Column) -> Column:
    return file_name(path).startswith("release_notes") & is_document(path)


def is_top_readme(path: Column) -> Column:
    return (F.size(parts(path)) == 1) & file_name(path).startswith("readme") & is_document(path)


def is_documentation_pdf(path: Column) -> Column:
    return root(path).isin("documentation", "documentations") & (suffix(path) == ".pdf")


def is_top_metadata(path: Column) -> Column:
    name = file_name(path)
    told = (name.startswith("readme") | name.startswith("release_notes")) & is_document(path)
    return (F.size(parts(path)) == 1) & (name.isin(*TOP_METADATA) | told)


def is_technical_source(path: Column) -> Column:
    name, steps = file_name(path), F.size(parts(path))
    known = suffix(path).isin(*DOCUMENTS, *TECHNICAL)
    placed = (steps == 1) | root(path).isin(*SOURCE_ROOTS) | is_board_root(root(path))
    return (steps > 0) & (name.startswith("readme") | name.startswith("release_notes") | (known & placed))


def is_wanted(path: Column) -> Column:
    """Whether a file of a source tree is taken in: any of the six predicates."""
    return is_project_readme(path) | is_release_notes(path) | is_top_readme(path) | is_documentation_pdf(path) | is_top_metadata(path) | is_technical_source(path)


def is_register_header(path: Column, chars: Column) -> Column:
    """A generated register map of a device, too large to keep whole."""
    return file_name(path).rlike(r"^stm32[a-z0-9]+\.h$") & (chars > HEADER_CHARS)


def is_split_part(path: Column) -> Column:
    return file_name(path).rlike(r"(?i)__part\d+\.json$")


def example_name(path: Column) -> Column:
    """The step after the first `Examples`; null without one."""
    steps = F.split(slashed(path), "/")
    at = F.array_position(steps, F.lit("Examples"))
    return F.when(at > 0, F.get(steps, at.cast("int")))


def file_id(repo: Column, path: Column) -> Column:
    """A document id that hangs on repository and path alone."""
    name = F.lower(text_of(repo))
    digest = F.sha1(F.concat(name, F.lit(":"), F.regexp_replace(slashed(path), "^/+", "")))
    return F.concat(name, F.lit("-file-"), F.substring(digest, 1, 16))


def series_folder(path: Column) -> Column:
    """The step after `by_series`, else unknown."""
    steps = F.split(slashed(path), "/")
    at = F.array_position(F.transform(steps, F.lower), F.lit("by_series"))
    return F.coalesce(F.when(at > 0, F.get(steps, at.cast("int"))), F.lit("unknown"))


def repo_slug(value: Column) -> Column:
    """A repository's name without address, owner and `.git`, in lower case, hyphens for underscores."""
    bare = F.regexp_replace(F.regexp_replace(F.trim(text_of(value)), r"/+$", ""), r"(?i)\.git$", "")
    return F.replace(F.lower(F.element_at(F.split(F.replace(bare, F.lit(":"), F.lit("/")), "/"), -1)), F.lit("_"), F.lit("-"))


def delivery_path(series: Column, repo: Column, artifact: str, drivers: str = "drivers") -> Column:
    """`repo/artifact`, or `series/drivers/repo/artifact` for a repository that belongs to a series (null: to none)."""
    name = F.lower(F.trim(text_of(repo)))
    return F.concat_ws("/", F.when(series.isNotNull(), F.concat_ws("/", F.lower(series), F.lit(drivers))), name, F.lit(artifact))
