from urllib.parse import quote

from pyspark.sql import functions as F

from loomwright.functions.text import blob_url
from loomwright.operators import issues


def test_addresses_are_encoded_as_quote_does(spark):
    paths = ["a b/c+d", "x*y~z-._/!'()", "größe/é#?&%25", "[1]=@:;,$", "", "a//b"]
    rows = spark.createDataFrame([(p,) for p in paths], "p string").select("p", blob_url("o", F.lit("r"), F.col("p")).alias("u")).collect()
    assert {r["p"]: r["u"] for r in rows} == {p: "https://github.com/o/r/blob/master/" + quote(p, safe="/") for p in paths}


def test_records_with_and_without_optional_columns(spark):
    bare = spark.createDataFrame([("RepoH7", "\\Examples\\Blink\\a.c", "x" * 100, None), (None, "a.c", None, ""), ("R", None, "short", "doc")], "repo string, path string, clean_text string, file_type string")
    got = {r["repo"]: r for r in issues.file_records(bare, "o").collect()}
    first, second, third = got["RepoH7"], got[None], got["R"]
    assert (first["github_url"], first["example_name"], first["mcu_series"], first["is_valid"]) == ("https://github.com/o/RepoH7/blob/master/Examples/Blink/a.c", "Blink", "H7", True)
    assert (second["github_url"], second["clean_text"], second["is_valid"], second["file_type"]) == (None, "", False, "other")
    assert (third["github_url"], third["path"], third["file_type"]) == (None, "", "doc")
    assert all((r["images_count"], r["image_urls"], r["content_extractor"], r["type"], r["ingest_version"], r["pdf_task_file"]) == (0, [], "text", "file", "v2.0", None) for r in got.values())

    whole = bare.limit(1).withColumns({"media_urls": F.array(F.lit("u")), "image_records": F.array(*(F.struct(F.lit(x).alias("image_url")) for x in "ab")), "images_count": F.lit(0), "github_url": F.lit("https://given"), "content_extractor": F.lit("pdf"), "extra": F.lit(1)})
    row = issues.file_records(whole, "o").collect()[0]
    assert (row["images_count"], row["image_urls"], row["github_url"], row["content_extractor"], row["extra"]) == (2, ["u"], "https://given", "pdf", 1)
    assert issues.file_records(whole.withColumn("images_count", F.lit(7)), "o").collect()[0]["images_count"] == 7
    assert issues.file_records(whole.limit(0), "o").count() == 0
