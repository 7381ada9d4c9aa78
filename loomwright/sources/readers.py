"""Readers for the formats the reference takes in. All give DataFrames with explicit schemas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ISSUES = "repo string, issue_number bigint, title string, state string, labels array<string>, created_at string, closed_at string, body string, comments array<struct<author:string,created_at:string,body:string>>, github_url string"
PRS = "repo string, pr_number bigint, title string, state string, merged boolean, draft boolean, author string, labels array<string>, body string, changed_files_count int, linked_issue_numbers array<bigint>, files_changed array<struct<filename:string,status:string,additions:int,deletions:int,changes:int>>"
COMMITS = "repo string, sha string, author string, message string, committed_at string, linked_issue_numbers array<bigint>, pr_numbers array<bigint>, files_changed array<struct<filename:string,status:string,additions:int,deletions:int,changes:int>>"
QUESTIONS = "query_id string, query_text string, query_type string, expected_repo_or_card string, expected_keywords string, keywords_mode string, forbidden_regex string"


def json_arrays(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """Files that hold one array of objects each; a broken file gives no rows."""
    fields = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    bad = T.StructField("_corrupt", T.StringType())
    read = spark.read.schema(T.StructType([*fields.fields, bad])).option("multiLine", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").json(path)
    return read.where(F.col("_corrupt").isNull()).drop("_corrupt")


def json_with_key(spark: SparkSession, path: str, keys: tuple[str, ...], schema: str) -> DataFrame:
    """Files with an array under one of several keys, the first that is there, or an array themselves."""
    whole = spark.read.text(path, wholetext=True)
    v = F.try_parse_json("value")
    arrays = [F.try_variant_get(v, f"$.{k}", "variant") for k in keys] + [F.when(F.schema_of_variant(v).startswith("ARRAY"), v)]
    return whole.select(F.explode(F.from_json(F.to_json(F.coalesce(*arrays)), f"array<struct<{_fields(schema)}>>")).alias("r")).select("r.*")


def _fields(ddl: str) -> str:
    return ",".join(f"{f.name}:{f.dataType.simpleString()}" for f in T.StructType.fromDDL(ddl).fields)


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One object a line; lines that do not parse are left out."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def csv_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("header", True).option("multiLine", True).option("escape", '"').csv(path)


def file_tree(spark: SparkSession, root: str, wanted: Column | None = None) -> DataFrame:
    """(path, content, encoding, is_pointer) of all files below root: UTF-8, else Latin-1; pointers of large-file storage are marked."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    relative = F.regexp_replace(F.regexp_extract("path", "^(?:[a-z]+:/*)?(.*)$", 1), "^/*", "/")
    base = root.split(":", 1)[-1].rstrip("/")
    rows = files.select(F.substring(relative, F.lit(len("/" + base.lstrip("/")) + 2), F.length(relative)).alias("path"), F.col("content").alias("raw"))
    if wanted is not None:
        rows = rows.where(wanted)
    utf8 = F.is_valid_utf8(F.col("raw").cast("string"))
    text = F.when(utf8, F.col("raw").cast("string")).otherwise(F.decode("raw", "ISO-8859-1"))
    return rows.select("path", text.alias("content"), F.when(utf8, "utf-8").otherwise("latin-1").alias("encoding"), text.startswith("version https://git-lfs.github.com/spec/").alias("is_pointer"))


def configs(spark: SparkSession, pattern: str) -> DataFrame:
    """(repo, owner, file): the repositories of all configuration files; the first file by name that lists one wins."""
    from loomwright.operators.windows import prefer

    read = spark.read.schema("owner string, repos array<string>").option("multiLine", True).json(pattern)
    rows = read.select("owner", F.posexplode("repos").alias("pos", "repo"), F.col("_metadata.file_name").alias("file"))
    return prefer(rows, ["repo"], [F.col("file"), F.col("pos")]).select("repo", "owner", "file")


def submodules(files: DataFrame, content: str = "content") -> DataFrame:
    """(path, url) of each submodule that the contents of .gitmodules files declare. Spark's readers pass over files
    whose name begins with a dot, so the contents come from a table of files."""
    blocks = F.filter(F.split(content, r"\[submodule "), lambda b: F.contains(b, F.lit("url")))
    return files.select(F.explode(blocks).alias("b")).select(F.trim(F.regexp_extract("b", r"(?m)^\s*path\s*=\s*(.*)$", 1)).alias("path"), F.trim(F.regexp_extract("b", r"(?m)^\s*url\s*=\s*(.*)$", 1)).alias("url"))
