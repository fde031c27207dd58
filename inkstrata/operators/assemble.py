"""Manifests, overrides, duplicates and the conversion registry."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from inkstrata.operators.classify import has_vector_content


def flag_duplicates(images: DataFrame) -> DataFrame:
    """images (doc_id, pos, file, sha): every row stays; later ones of one hash point to the first."""
    w = Window.partitionBy("doc_id", "sha").orderBy("pos")
    first = F.first("file").over(w)
    later = F.row_number().over(w) > 1
    return images.withColumn("is_duplicate", later).withColumn("original", F.when(later, first))


def watermarks(images: DataFrame, by_page: bool = False) -> DataFrame:
    """images (doc_id, page, sha, total_pages): hashes that occur (or, by_page, whose pages number) more than half as often as there are pages."""
    times = F.count_distinct("page") if by_page else F.count(F.lit(1))
    return images.groupBy("doc_id", "sha").agg(times.alias("times"), F.max("total_pages").alias("total")).filter("times > total * 0.5").select("doc_id", "sha", "times")


def glob_regex(pattern: str) -> str:
    out = ""
    for c in pattern:
        out += ".*" if c == "*" else "." if c == "?" else c if c in "[]" else "\\" + c if c in ".^$+{}()|\\" else c
    return f"^{out}$"


def apply_overrides(pages: DataFrame, overrides: DataFrame) -> DataFrame:
    """pages (file, page, auto) and overrides (ord, regex, page, classification), a small rule table: the last entry that matches wins."""
    o = F.broadcast(overrides.select("ord", "regex", F.col("page").alias("o_page"), "classification"))
    hit = pages.join(o, (F.col("page") == F.col("o_page")) & F.expr("file rlike regex"), "left")
    got = hit.groupBy("file", "page", "auto").agg(F.max_by("classification", "ord").alias("c"))
    return got.select("file", "page", F.coalesce("c", "auto").alias("classification"), (F.col("c").isNotNull() & (F.col("c") != F.col("auto"))).alias("changed"))


def upsert(registry: DataFrame, fresh: DataFrame, keys: list[str]) -> DataFrame:
    """The newest row (converted_at) for each key; of equal times the fresh one."""
    both = registry.withColumn("side", F.lit(0)).unionByName(fresh.withColumn("side", F.lit(1)), allowMissingColumns=True)
    w = Window.partitionBy(*keys).orderBy(F.desc("converted_at"), F.desc("side"), F.desc("output_path"))
    return both.withColumn("k", F.row_number().over(w)).filter("k = 1").drop("k", "side")


def gate_lookup(requests: DataFrame, registry: DataFrame, files: DataFrame) -> DataFrame:
    """requests (path, sha): allow through a registered output that exists and is Markdown, else through one beside the file, else block."""
    r = requests.join(registry.select(F.col("source_hash").alias("sha"), "output_path"), "sha", "left")
    r = r.withColumn("beside", F.regexp_replace("path", r"\.[^.]+$", ".md"))
    f = files.select("file").distinct()
    r = r.join(f.select(F.col("file").alias("output_path"), F.lit(True).alias("has_out")), "output_path", "left").join(f.select(F.col("file").alias("beside"), F.lit(True).alias("has_beside")), "beside", "left")
    good = F.coalesce(F.max(F.col("has_out") & F.endswith("output_path", F.lit(".md"))), F.lit(False))
    g = r.groupBy("path").agg(good.alias("reg"), F.coalesce(F.max("has_beside"), F.lit(False)).alias("near"))
    how = F.when(F.col("reg"), "registry").when(F.col("near"), "co-located").otherwise("none")
    return g.select("path", F.when(how == "none", 2).otherwise(0).alias("exit_code"), how.alias("via"))


def append_renders(manifest: DataFrame, renders: DataFrame) -> DataFrame:
    """manifest and renders (doc_id, filename, figure_num string): new file names only, numbered on from the greatest numeric figure."""
    top = manifest.groupBy("doc_id").agg(F.max(F.expr("try_cast(figure_num as int)")).alias("top"))
    new = renders.join(manifest, ["doc_id", "filename"], "left_anti").withColumn("k", F.row_number().over(Window.partitionBy("doc_id").orderBy("filename")))
    new = new.join(top, "doc_id", "left").select("doc_id", "filename", (F.coalesce("top", F.lit(0)) + F.col("k")).cast("string").alias("figure_num"))
    return manifest.select("doc_id", "filename", "figure_num").unionByName(new)


def best_overlap(a: DataFrame, b: DataFrame, least: float = 0.05) -> DataFrame:
    """a and b (doc_id, page, id, x0, y0, x1, y1): for each of a the box of b on its page with the greatest intersection over union."""
    p = a.alias("a").join(b.alias("b"), (F.col("a.doc_id") == F.col("b.doc_id")) & (F.col("a.page") == F.col("b.page")))
    side = lambda lo, hi: F.greatest(F.lit(0.0), F.least(f"a.{hi}", f"b.{hi}") - F.greatest(f"a.{lo}", f"b.{lo}"))
    area = lambda t: (F.col(f"{t}.x1") - F.col(f"{t}.x0")) * (F.col(f"{t}.y1") - F.col(f"{t}.y0"))
    inter = side("x0", "x1") * side("y0", "y1")
    p = p.select("a.doc_id", "a.page", F.col("a.id").alias("a_id"), F.col("b.id").alias("b_id"), (inter / (area("a") + area("b") - inter)).alias("iou")).filter(F.col("iou") >= least)
    g = p.groupBy("doc_id", "page", "a_id").agg(F.max(F.struct("iou", (-F.col("b_id")).alias("m"))).alias("x"))
    return g.select("doc_id", "page", "a_id", (-F.col("x.m")).alias("b_id"), F.round("x.iou", 6).alias("iou"))


def page_verdicts(images: DataFrame) -> DataFrame:
    """images (doc_id, page, is_substantive): a page is substantive with any substantive image."""
    return images.groupBy("doc_id", "page").agg(F.bool_or("is_substantive").alias("substantive"), F.count(F.lit(1)).alias("n_images"), F.count_if("is_substantive").alias("n_substantive"))


def page_classes(pages: DataFrame, images: DataFrame) -> DataFrame:
    """pages (doc_id, page, drawings, area) and images (doc_id, page, image_id, is_blank, is_substantive, reason): each image's class, and its page's. All images of a page with significant vector
    drawings count, others unless blank or ruled out; a page counts by its drawings, without any image too, or by an image: doc_id, page, page_substantive, image_id (null without images), is_substantive, reason."""
    vector = F.coalesce(has_vector_content(F.col("drawings"), F.col("area")), F.lit(False))
    x = pages.select("doc_id", "page", vector.alias("vector")).join(images, ["doc_id", "page"], "left")
    blank = F.coalesce(F.col("is_blank"), F.lit(False))
    x = x.withColumn("reason", F.when(F.col("image_id").isNull(), None).when(F.col("vector"), "vector_page").when(blank, "blank").otherwise(F.col("reason")))
    x = x.withColumn("is_substantive", F.when(F.col("image_id").isNull(), None).otherwise(F.col("vector") | (~blank & F.coalesce("is_substantive", F.lit(False)))))
    any_ = F.coalesce(F.bool_or("is_substantive").over(Window.partitionBy("doc_id", "page")), F.lit(False))
    return x.select("doc_id", "page", (F.col("vector") | any_).alias("page_substantive"), "image_id", "is_substantive", "reason")


def repair_tables(found: DataFrame, source: DataFrame) -> DataFrame:
    """The k-th table of a document with the k-th of its source (doc_id, pos, body): an empty or missing one takes the source's."""
    k = F.row_number().over(Window.partitionBy("doc_id").orderBy("pos"))
    f, s = found.select("doc_id", k.alias("k"), F.col("body").alias("f")), source.select("doc_id", k.alias("k"), F.col("body").alias("s"))
    how = F.when(F.col("f").isNull(), "appended").when(F.col("f") == "", "replaced").otherwise("kept")
    both = f.join(s, ["doc_id", "k"], "full_outer")
    return both.select("doc_id", "k", F.when(how == "kept", F.col("f")).otherwise(F.col("s")).alias("body"), how.alias("how"))
