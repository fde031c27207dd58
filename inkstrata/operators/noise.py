"""Lines that OCR made of figures, dropped; front matter and page counts of converted documents."""

from __future__ import annotations

import math
from collections import Counter

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType
from pyspark.sql.window import Window

from inkstrata.functions.text import words
from inkstrata.sources.tables import lines

# What only real statistics hold
STATISTICS = r"(?i)\d+\.\d+\s*[\(\[]\d+\.\d+|p\s*[<>=]\s*0\.\d|HR\s*[=:]|OR\s*[=:]|RR\s*[=:]|ICER\s*[=:]|QALY|DALY|NMB|95%\s*CI|99%\s*CI|N\s*=\s*\d+|\d+,\d{3}|\d+\.\d+\s*±\s*\d+\.\d+|\d+\.\d+\s+6\s+\d+\.\d+|\bITT\b|\bPFS\b|\bOS\b|\bWTP\b|\bCEA\b|\bNHB\b"
# How lines begin that are never noise
STRUCTURAL = r"^(#|\||!|<!--|```|---|>)"
ENTROPY, REAL = 4.5, 0.3  # a line with more bits a character and a smaller share of real words is noise
FIGURE_ENTROPY, FIGURE_REAL = 4.0, 0.4  # the same after an image, up to the next empty line


@F.pandas_udf(DoubleType())
def entropy(line: pd.Series) -> pd.Series:
    """Bits a character of a line: counted in Arrow batches, ten times faster than by array functions and without a row for each character."""
    return pd.Series([None if x is None else sum(-n / len(x) * math.log2(n / len(x)) for n in Counter(x).values()) for x in line], dtype=float)


def real_words(line: Column) -> Column:
    """The share of words with a vowel and two characters or more."""
    w = words(line)
    return F.coalesce(F.size(F.filter(w, lambda x: (F.length(x) >= 2) & x.rlike("[aeiouAEIOU]"))) / F.nullif(F.size(w), F.lit(0)), F.lit(0.0))


def judged_lines(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text): (doc_id, line_no, line, noise). Only lines that could be noise are measured."""
    rows = lines(docs, "text")
    rows = rows.withColumn("x", F.regexp_replace("line", r"^\s+|\s+$", ""))
    image = F.col("x").startswith("![") | F.col("x").startswith("<!-- IMAGE:")
    before = Window.partitionBy("doc_id").orderBy("line_no").rowsBetween(Window.unboundedPreceding, -1)
    in_figure = F.coalesce(F.last(F.when(image, F.lit(True)).when(F.col("x") == "", F.lit(False)), ignorenulls=True).over(before), F.lit(False))
    open_ = (F.length("x") >= 20) & ~F.col("x").rlike(STRUCTURAL) & ~F.col("x").rlike(STATISTICS)
    measured = rows.withColumn("in_figure", in_figure).withColumn("bits", F.when(open_, entropy(F.lower("x")))).withColumn("real", F.when(open_, real_words(F.col("x"))))
    noise = ((F.col("bits") > ENTROPY) & (F.col("real") < REAL)) | (F.col("in_figure") & (F.col("bits") > FIGURE_ENTROPY) & (F.col("real") < FIGURE_REAL))
    return measured.select("doc_id", "line_no", "line", F.coalesce(noise, F.lit(False)).alias("noise"), "bits", "real")


def without_noise(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text) without noise lines, three or more line ends as two. A null text has no row."""
    kept = judged_lines(docs).groupBy("doc_id").agg(F.array_sort(F.collect_list(F.when(~F.col("noise"), F.struct("line_no", "line")))).alias("l"))
    return kept.select("doc_id", F.regexp_replace(F.array_join("l.line", "\n"), r"\n{3,}", "\n\n").alias("text"))


def page_count(pages: DataFrame, kinds: DataFrame) -> DataFrame:
    """kinds (doc_id, format), pages (doc_id, page): the number of pages, slides or sheets; null for formats without; and the estimate, 1 where it isn't known."""
    n = pages.groupBy("doc_id").agg(F.countDistinct("page").alias("n"))
    known = F.when(F.col("format").isin("pdf", "pptx", "xlsx"), F.col("n"))
    return kinds.join(n, "doc_id", "left").select("doc_id", "format", known.alias("pages"), F.coalesce(known, F.lit(1)).cast("long").alias("estimate"))


# For each format what its pages are called, the tool and the kind of document
FORMATS = {"pdf": ("pages", "docling + PyMuPDF", "research_paper"), "docx": ("pages", "MarkItDown + python-docx", "document"), "pptx": ("slides", "MarkItDown + python-pptx", "presentation"), "xlsx": ("sheets", "MarkItDown", "spreadsheet")}


def header(path: Column, fmt: Column, pages: Column, images: Column, day: Column) -> Column:
    """The front matter of a converted document."""
    pick = lambda k: F.create_map(*[F.lit(x) for f, v in FORMATS.items() for x in (f, v[k])])[fmt]
    name = F.regexp_extract(path, "([^/]*)$", 1)
    counted = F.when(pages.isNotNull(), F.concat(pick(0), F.lit(": "), pages.cast("string")))
    rows = [F.concat(F.lit("source_file: "), name), F.concat(F.lit("source_path: "), path), F.concat(F.lit("source_format: "), fmt), counted, F.concat(F.lit("conversion_date: "), F.date_format(day, "yyyy-MM-dd")), F.concat(F.lit("conversion_tool: "), pick(1))]
    rows += [F.lit("fidelity_standard: verbatim (QC required)"), F.concat(F.lit("document_type: "), pick(2)), F.concat(F.lit("image_notes: "), F.when(images > 0, "pending").otherwise("none"))]
    return F.concat(F.concat_ws("\n", F.lit("---"), *rows, F.lit("---")), F.lit("\n\n"))


def text_document(name: Column, content: Column) -> Column:
    """A text file as Markdown: front matter, the title from its stem, and the content. content is binary: UTF-8, else Latin-1."""
    text = F.coalesce(F.try_validate_utf8(content.cast("string")), F.decode(content, "ISO-8859-1"))
    title = F.translate(F.regexp_replace(name, r"(?<=.)\.[^.]*$", ""), "_-", "  ")
    rows = [F.concat(F.lit('title: "'), title, F.lit('"')), F.concat(F.lit('source_file: "'), name, F.lit('"')), F.lit('source_format: "txt"'), F.lit('document_type: "text"'), F.lit('fidelity_standard: "text_content"'), F.lit("total_images: 0"), F.lit("image_notes: none")]
    return F.concat(F.concat_ws("\n", F.lit("---"), *rows, F.lit("---")), F.lit("\n\n# "), title, F.lit("\n\n"), text)
