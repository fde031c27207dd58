"""Readers: the supplied tables, HTML pages as Markdown, and lines with explicit numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def literal(spark: SparkSession, ddl: str, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, ddl)


#: (pattern, replacement) in order: scripts and the like go first, as their text may look like tags.
HTML_RULES = [(r"(?s)<script.*?</script>", ""), (r"(?s)<style.*?</style>", ""), (r"(?s)<nav.*?</nav>", ""), (r"(?s)<!--.*?-->", ""), (r"<h1[^>]*>", "\n# "), (r"<h2[^>]*>", "\n## "), (r"<h3[^>]*>", "\n### "), (r"</h[1-6]>", "\n"), (r"<li[^>]*>", "\n- "), (r"<p[^>]*>", "\n\n"), (r"<br[^>]*>", "\n"), (r"<[^>]+>", ""), (r"&amp;", "&")]


def html_to_markdown(html: Column) -> Column:
    for pattern, put in HTML_RULES:
        html = F.regexp_replace(html, pattern, put)
    return html


def page_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """md: (doc_id, md) of pages."""
    return load(spark, sf_dir, "pages").select(F.col("page_id").alias("doc_id"), html_to_markdown(F.col("html")).alias("md"))


def lines(docs: DataFrame, text: str = "md") -> DataFrame:
    """(doc_id, line_no from 1, line): order is a column, never implied. Split where the text is read."""
    return docs.select("doc_id", F.posexplode(F.split(text, "\n"))).select("doc_id", (F.col("pos") + 1).alias("line_no"), F.col("col").alias("line"))


def source_format(path: Column) -> Column:
    return F.lower(F.regexp_extract(path, r"\.([^.\/]+)$", 1))


MANIFEST = T.StructType([T.StructField("filename", T.StringType()), T.StructField("page", T.IntegerType()), T.StructField("width", T.IntegerType()), T.StructField("height", T.IntegerType()), T.StructField("_corrupt", T.StringType())])


def read_json(spark: SparkSession, path: str, schema: T.StructType = MANIFEST) -> DataFrame:
    """Whole JSON documents; a malformed one is a row with only _corrupt."""
    return spark.read.schema(schema).option("multiLine", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").json(path)


def read_text_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, text): UTF-8, else Latin-1; the title is the stem with _ and - as blanks."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    text = F.coalesce(F.try_validate_utf8(F.col("content").cast("string")), F.decode("content", "ISO-8859-1"))
    stem = F.regexp_extract("path", r"([^/]+?)(\.[^./]*)?$", 1)
    return files.select("path", text.alias("text"), F.translate(stem, "_-", "  ").alias("title"))
