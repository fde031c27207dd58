"""Extractor routing and cross-checks of extracted text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkstrata.functions.text import words

# Extractors in order of preference
SCANNED_CHAIN = ["tesseract", "mineru", "zerox"]
DIGITAL_CHAIN = ["marker", "docling", "pymupdf4llm", "markitdown"]
SCANNED_BELOW = 50.0


def density(pages: DataFrame) -> DataFrame:
    """pages (doc_id, page from 0, text, total): mean characters of every max(1, total div 10)-th page."""
    step = F.greatest(F.lit(1), F.floor(F.col("total") / 10))
    return pages.filter(F.col("page") % step == 0).groupBy("doc_id").agg(F.avg(F.length("text")).alias("avg_chars"), F.count(F.lit(1)).alias("n_sampled"))


def route(documents: DataFrame, capabilities: DataFrame) -> DataFrame:
    """documents (doc_id, avg_chars, pages, forced): the forced extractor, or for no pages pymupdf4llm, or the first available one of the chain that the density
    points to. capabilities (extractor, available) is a small rule table."""
    chain = F.when(F.col("avg_chars") < SCANNED_BELOW, F.array(*map(F.lit, SCANNED_CHAIN))).otherwise(F.array(*map(F.lit, DIGITAL_CHAIN)))
    steps = documents.select("doc_id", F.posexplode(chain)).withColumnRenamed("col", "extractor")
    first = steps.join(F.broadcast(capabilities.filter("available")), "extractor").groupBy("doc_id").agg(F.min_by("extractor", "pos").alias("found"))
    choice = F.coalesce("forced", F.when(F.col("pages") == 0, "pymupdf4llm"), "found")
    return documents.join(first, "doc_id", "left").select("doc_id", (F.col("avg_chars") < SCANNED_BELOW).alias("is_scanned"), choice.alias("extractor"))


def next_in_chain(current: DataFrame, chain: DataFrame) -> DataFrame:
    """current (doc_id, extractor): the next available extractor of chain (pos, extractor, available) after it, or null."""
    at = current.join(F.broadcast(chain.select(F.col("extractor"), F.col("pos").alias("cur"))), "extractor", "left").withColumn("cur", F.coalesce("cur", F.lit(-1)))
    later = at.join(F.broadcast(chain.filter("available").select("pos", F.col("extractor").alias("nxt"))), F.expr("pos > cur"), "left")
    return later.groupBy("doc_id").agg(F.min_by("nxt", "pos").alias("next_extractor"))


def missing_words(pages: DataFrame, over: float = 0.05, sample: int = 10) -> DataFrame:
    """pages (doc_id, primary, secondary): texts whose primary lacks more than `over` of the secondary's distinct words; the sample is the first words in order."""
    two, one = F.array_distinct(words(F.col("secondary"))), F.array_distinct(words(F.col("primary")))
    x = pages.select("doc_id", F.size(two).alias("n"), F.array_sort(F.array_except(two, one)).alias("gone")).filter("n > 0")
    return x.filter(F.size("gone") / F.col("n") > over).select("doc_id", F.round(1 - F.size("gone") / F.col("n"), 4).alias("completeness"), F.array_join(F.slice("gone", 1, sample), " ").alias("missing_sample"))


def flag_rate(flags: DataFrame, rate: float = 0.40, pages: int = 10) -> DataFrame:
    """flags (doc_id, flagged): documents with enough pages and flagged ones to be extracted anew."""
    g = flags.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_pages"), F.avg(F.col("flagged").cast("int")).alias("rate"))
    return g.filter((F.col("n_pages") >= pages) & (F.col("rate") >= rate))


def flag_rate_notes(flags: DataFrame, slides: DataFrame, rate: float = 0.40, pages: int = 10, sure: float = 0.90, garbled: int = 5) -> DataFrame:
    """flags (doc_id, flagged), a row a page, and slides (doc_id, is_slides, n_garbled): doc_id, n_pages, rate, is_slides (looked at only from the rate `sure` on, null below), wanted (to be
    extracted anew: enough pages and flagged ones) and note: slides are expected to be flagged, unless more than `garbled` markers show that they are garbled."""
    g = flags.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_pages"), F.avg(F.col("flagged").cast("int")).alias("rate")).join(slides, "doc_id", "left")
    shown = F.when(F.col("rate") >= sure, F.coalesce("is_slides", F.lit(False)))
    note = F.when(shown, F.when(F.col("n_garbled") > garbled, "slides with garbled output").otherwise("high rate expected for slides"))
    return g.select("doc_id", "n_pages", "rate", shown.alias("is_slides"), ((F.col("n_pages") >= pages) & (F.col("rate") >= rate)).alias("wanted"), note.alias("note"))


def word_ratio(pairs: DataFrame) -> DataFrame:
    """pairs (doc_id, out_text, ref_text): fallback under 0.1, warn under 0.3, info under 0.6, else ok; no_reference without words."""
    n = pairs.select("doc_id", F.size(words(F.col("out_text"))).alias("o"), F.size(words(F.col("ref_text"))).alias("r"))
    ratio = F.col("o") / F.nullif(F.col("r"), F.lit(0))
    verdict = F.when(F.col("r") == 0, "no_reference").when(ratio < 0.1, "fallback").when(ratio < 0.3, "warn").when(ratio < 0.6, "info").otherwise("ok")
    return n.select("doc_id", verdict.alias("verdict"))


def gap_pages(reference: DataFrame, manifest: DataFrame, least: int = 50) -> DataFrame:
    """Pages where the reference (doc_id, page, width, height) has an image of some size, or of unknown size, and the manifest none."""
    real = reference.filter(F.coalesce((F.col("width") >= least) & (F.col("height") >= least), F.lit(True)))
    return real.select("doc_id", "page").distinct().join(manifest, ["doc_id", "page"], "left_anti")


def output_verdict(docs: DataFrame) -> DataFrame:
    """docs (doc_id, md): missing, empty, blank or ok, and whether there is a header."""
    v = F.when(F.col("md").isNull(), "missing").when(F.length("md") == 0, "empty").when(~F.col("md").rlike(r"\S"), "blank").otherwise("ok")
    return docs.select("doc_id", v.alias("verdict"), F.coalesce(F.startswith("md", F.lit("---")), F.lit(False)).alias("has_header"))


def is_slides(pages: DataFrame) -> DataFrame:
    """pages (doc_id, width, height, n_words): two of four signals: landscape, few page sizes, few words, screen aspect; sizes only count with landscape or aspect."""
    w, h = F.col("width"), F.col("height")
    a = w / h
    share = lambda c: F.avg(c.cast("int"))
    g = pages.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n"),
        share(w > h).alias("wide"),
        F.count_distinct(F.struct(F.round(w / 10), F.round(h / 10))).alias("sizes"),
        share(F.col("n_words") < 80).alias("brief"),
        share(((a > 1.2) & (a < 1.5)) | ((a > 1.6) & (a < 2.0))).alias("screen"),
    )
    wide, screen = F.col("wide") >= 0.8, F.col("screen") >= 0.8
    signals = wide.cast("int") + ((F.col("sizes") <= 2) & (wide | screen)).cast("int") + (F.col("brief") >= 0.6).cast("int") + screen.cast("int")
    return g.select("doc_id", ((F.col("n") >= 3) & (signals >= 2)).alias("is_slides"))
