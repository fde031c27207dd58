"""Checks and summaries of converted documents: image indexes, context summaries, manifests, fallbacks, analysis plans."""

from __future__ import annotations


import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

IMAGE_ENDS = r"\.(png|jpg|jpeg|gif|bmp)$"  # fixed values: endings of image files
LINK = r"\[([^\]]+)\]\(([^)]+)\)"
NEEDED = ["title", "sections", "total_images", "document_domain"]  # fixed values: keys of a context summary
WITHOUT_SUMMARY = ["docx", "pptx", "doc", "ppt", "txt"]  # fixed values: formats that have none


# ---- links and indexes -----------------------------------------------------------------------------


def image_links(md: Column) -> Column:
    """Targets of links to image files, in order."""
    return F.filter(F.regexp_extract_all(md, F.lit(LINK), 2), lambda x: x.rlike(IMAGE_ENDS))


def index_section(md: Column) -> Column:
    """The Image Index section up to a rule, else up to the next heading or the end; null if there is none."""
    ruled = F.regexp_extract(md, r"(?s)## Image Index\n\n(.*?)\n---", 1)
    bare = F.regexp_extract(md, r"(?s)## Image Index\n\n(.*?)(?=\n##|\z)", 1)
    return F.when(md.contains("## Image Index\n\n"), F.when(md.rlike(r"(?s)## Image Index\n\n.*?\n---"), ruled).otherwise(bare))


def index_filenames(section: Column) -> Column:
    return F.array_sort(F.array_distinct(F.regexp_extract_all(section, F.lit(r"\[([^\]]+\.(?:png|jpg|jpeg|gif|bmp))\]"), 1)))


def image_index_check(docs: DataFrame, companions: DataFrame) -> DataFrame:
    """docs (doc_id, md), companions (doc_id, filename) of *-image-index.md files: one verdict for each document."""
    first = companions.groupBy("doc_id").agg(F.min("filename").alias("companion"))
    n = F.size(image_links(F.col("md")))
    told = F.when(~F.col("md").contains("## Image Index"), F.coalesce(F.concat(F.lit("INFO: Image Index companion file found: "), F.col("companion")), F.lit("WARN: No Image Index section found")))
    told = told.when(n == 0, "INFO: No image file references found").otherwise(F.concat(F.lit("INFO: "), n.cast("string"), F.lit(" image reference(s) in index")))
    return docs.join(first, "doc_id", "left").select("doc_id", told.alias("issue"))


def parsed_index(lines: DataFrame) -> DataFrame:
    """lines (doc_id, line_no, line) of image indexes: the rows of the table under `## Substantive Images Only`, up to the next rule: doc_id, page, image_count, context, source_path."""
    w = Window.partitionBy("doc_id").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    line = F.col("line")
    begun = F.max(line.contains("## Substantive Images Only")).over(w)
    x = lines.withColumn("begun", begun)
    x = x.withColumn("ruled", F.max(F.col("begun") & line.startswith("|---")).over(w))
    x = x.withColumn("over", F.max(F.col("begun") & line.startswith("---")).over(w))
    source = F.min(F.when(line.startswith("Source: "), F.struct("line_no", F.trim(F.substring("line", 9, 1_000_000)).alias("s")))).over(Window.partitionBy("doc_id"))
    x = x.withColumn("source", F.coalesce(source.getField("s"), F.lit("")))
    cells = F.filter(F.transform(F.split("line", r"\|"), lambda c: F.trim(c)), lambda c: c != "")
    x = x.filter(F.col("begun") & F.col("ruled") & ~F.col("over") & line.startswith("|") & ~line.startswith("|---")).withColumn("cells", cells).filter(F.size("cells") >= 3)
    number = lambda k: F.expr(f"try_cast(cells[{k}] as long)")
    return x.select("doc_id", number(0).alias("page"), number(1).alias("image_count"), F.col("cells")[2].alias("context"), F.col("source").alias("source_path")).filter("page is not null and image_count is not null")


def context_summary_check(docs: DataFrame) -> DataFrame:
    """docs (doc_id, format, summary), summary the JSON text or null: one verdict for each document."""
    keys = F.json_object_keys("summary")
    missing = F.array_except(F.array(*map(F.lit, NEEDED)), keys)
    absent = F.when(F.lower("format").isin(WITHOUT_SUMMARY), "INFO: context-summary.json not applicable for this format").otherwise("WARN: context-summary.json not found")
    told = F.when(F.col("summary").isNull(), absent).when(keys.isNull(), "WARN: Cannot read context-summary.json").when(F.size(missing) > 0, F.concat(F.lit("WARN: context-summary.json missing fields: "), F.array_join(missing, ", "))).otherwise("PASS: context-summary.json valid")
    return docs.select("doc_id", told.alias("issue"))


def manifest_path(docs: DataFrame, files: DataFrame) -> DataFrame:
    """docs (doc_id, folder, stem, md), files (path): the manifest that there is, by priority: beside the first linked image, under images/stem, stem_manifest.json, any
    *_manifest.json of the folder (the first by name); else the default path, with found false."""
    linked = F.regexp_extract("md", r"\]\((images/[^/)]+)[^)]*\)", 1)
    at = lambda *x: F.concat(F.col("folder"), F.lit("/"), *x)
    default = at(F.lit("images/"), F.col("stem"), F.lit("/image-manifest.json"))
    wanted = F.array(F.when(linked != "", at(linked, F.lit("/image-manifest.json"))), default, at(F.col("stem"), F.lit("_manifest.json")))
    named = docs.select("doc_id", F.posexplode(wanted)).filter("col is not null").withColumnRenamed("col", "path").join(files.select("path").distinct(), "path", "left_semi")
    others = files.filter(F.col("path").endswith("_manifest.json")).groupBy(F.regexp_extract("path", r"^(.*)/[^/]*$", 1).alias("folder")).agg(F.min("path").alias("other"))
    found = named.groupBy("doc_id").agg(F.min_by("path", "pos").alias("path"))
    best = F.coalesce("path", "other")
    return docs.join(found, "doc_id", "left").join(others, "folder", "left").select("doc_id", F.coalesce(best, default).alias("manifest"), best.isNotNull().alias("found"))


# ---- runs and verdicts ------------------------------------------------------------------------------


def fallback_outcome(attempts: DataFrame) -> DataFrame:
    """attempts (doc_id, pos, extractor, exit_code): the first extractor that ended with 0, null if none did, and those that failed before it, in order."""
    first = F.min(F.when(F.col("exit_code") == 0, F.struct("pos", "extractor"))).alias("first")
    failed = F.array_sort(F.collect_list(F.when(F.col("exit_code") != 0, F.struct("pos", "extractor")))).alias("failed")
    runs = attempts.groupBy("doc_id").agg(first, failed)
    before = F.filter("failed", lambda x: F.col("first").isNull() | (x.getField("pos") < F.col("first.pos")))
    return runs.select("doc_id", F.col("first.extractor").alias("extractor"), F.array_join(F.transform(before, lambda x: x.getField("extractor")), ",").alias("fallback_chain"))


def class_map(images: DataFrame) -> DataFrame:
    """images (doc_id, page, file_path, is_substantive, reason): for each document filename -> (classification, reason); of files of one name the last page's counts."""
    name = F.regexp_extract("file_path", "([^/]*)$", 1)
    one = images.filter(F.col("file_path") != "").withColumn("filename", name).groupBy("doc_id", "filename").agg(F.max(F.struct("page", F.coalesce("is_substantive", F.lit(True)).alias("s"), F.coalesce("reason", F.lit("unknown")).alias("r"))).alias("x"))
    one = one.select("doc_id", "filename", F.when(F.col("x.s"), "SUB").otherwise("DEC").alias("classification"), F.col("x.r").alias("reason"))
    return one.groupBy("doc_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("filename", F.struct("classification", "reason"))))).alias("per_image_classification"))


def recomputed_pages(pages: DataFrame, files: DataFrame) -> DataFrame:
    """pages (doc_id, page, substantive), files (doc_id, page, decorative): a page with files is decorative only if all of them are; one without keeps its verdict."""
    all_of = files.groupBy("doc_id", "page").agg(F.bool_and("decorative").alias("d"), F.count(F.lit(1)).alias("n_files"))
    return pages.join(all_of, ["doc_id", "page"], "left").select("doc_id", "page", F.coalesce(~F.col("d"), F.col("substantive")).alias("substantive"), F.coalesce("n_files", F.lit(0)).cast("long").alias("n_files"))


def image_counts(manifests: DataFrame) -> DataFrame:
    """manifests (doc_id, total_extracted, total_images, image_count, duplicates_skipped, images array of is_duplicate): totals, with what is missing counted from images."""
    n, copies = F.size("images"), F.size(F.filter("images", lambda x: F.coalesce(x, F.lit(False))))
    return manifests.select("doc_id", F.coalesce("total_extracted", "total_images", n).cast("long").alias("total"), F.coalesce("image_count", n).cast("long").alias("unique_images"), F.coalesce("duplicates_skipped", copies).cast("long").alias("duplicates"))


def validated_metadata(docs: DataFrame, institutional: Column) -> DataFrame:
    """docs (doc_id, n_pages, title, author, stat_pages): the title if it has more than five characters and isn't institutional, the author if more than one; pages, else those of the converter's statistics, else 0."""
    title, author = F.trim("title"), F.trim("author")
    return docs.select("doc_id", F.coalesce("n_pages", "stat_pages", F.lit(0)).cast("long").alias("page_count"), F.when((F.length(title) > 5) & ~institutional, title).alias("title"), F.when(F.length(author) > 1, author).alias("author"))


def error_index(stem: Column, source: Column, message: Column) -> Column:
    """The image index of a document that could not be indexed."""
    name = F.replace(stem, F.lit("-image-index"), F.lit(""))
    rows = [F.concat(F.lit("# Image Index: "), name), F.lit(""), F.concat(F.lit("Source: "), source), F.lit(""), F.concat(F.lit("**Error:** "), message), F.lit(""), F.lit("---"), F.lit(""), F.lit("## Page-by-Page Index"), F.lit("")]
    rows += [F.lit("| Page | Images | Substantive | Context (first 150 chars) |"), F.lit("|------|--------|-------------|---------------------------|"), F.concat(F.lit("| — | — | — | "), message, F.lit(" |"))]
    return F.concat(F.concat_ws("\n", *rows), F.lit("\n"))


# ---- images on pages --------------------------------------------------------------------------------


def text_near_images(images: DataFrame, spans: DataFrame) -> DataFrame:
    """images (doc_id, page, id, x0, y0, x1, y1), spans (doc_id, page, no, x0, y0, x1, y1, text): the caption found up to 100 points below an image and 50 to its sides, and
    the text within 100 points around it, of 200 characters and `...`; null if there is none."""
    def clipped(left: float, above: Column, below: Column) -> Column:
        return (F.col("s.x1") > F.col("i.x0") - left) & (F.col("s.x0") < F.col("i.x1") + left) & (F.col("s.y1") > above) & (F.col("s.y0") < below)

    under = clipped(50, F.col("i.y1"), F.col("i.y1") + 100)
    around = clipped(100, F.col("i.y0") - 100, F.col("i.y1") + 100)
    both = images.alias("i").join(spans.alias("s"), (F.col("i.doc_id") == F.col("s.doc_id")) & (F.col("i.page") == F.col("s.page")) & (under | around), "left")
    in_order = lambda where, gap: F.array_join(F.transform(F.array_sort(F.collect_list(F.when(where, F.struct("s.no", "s.text")))), lambda x: x.getField("text")), gap)
    g = both.groupBy("i.doc_id", "i.page", "i.id").agg(in_order(under, "\n").alias("below"), in_order(around, " ").alias("near"))
    caption = F.trim(F.regexp_extract("below", r"(?i)(?:Figure|Table|Fig\.|Tab\.)\s*\d+[:\.]?\s*[^\n]{0,80}", 0))
    near = F.trim(F.regexp_replace("near", r"\s+", " "))
    return g.select("doc_id", "page", "id", F.when(caption != "", caption).alias("caption"), F.when(near != "", F.when(F.length(near) > 200, F.concat(F.left(near, F.lit(200)), F.lit("..."))).otherwise(near)).alias("nearby"))


LEAST_OVERLAP, FARTHEST = 0.05, 200.0  # fixed values: intersection over union, and points between centres


def _matched(pictures: pd.DataFrame, images: pd.DataFrame) -> pd.DataFrame:
    free = list(images.sort_values("idx").itertuples())
    out = []
    for p in pictures.sort_values("pos").itertuples():
        boxed = [i for i in free if p.x0 == p.x0 and i.x0 == i.x0]

        def overlap(i) -> float:
            both = max(0.0, min(p.x1, i.x1) - max(p.x0, i.x0)) * max(0.0, min(p.y1, i.y1) - max(p.y0, i.y0))
            all_ = (p.x1 - p.x0) * (p.y1 - p.y0) + (i.x1 - i.x0) * (i.y1 - i.y0) - both
            return both / all_ if all_ > 0 else 0.0

        def apart(i) -> float:
            return ((p.x0 + p.x1 - i.x0 - i.x1) ** 2 + (p.y0 + p.y1 - i.y0 - i.y1) ** 2) ** 0.5 / 2

        rules = (("iou", max(boxed, key=overlap, default=None), lambda i: overlap(i) >= LEAST_OVERLAP), ("distance", min(boxed, key=apart, default=None), lambda i: apart(i) <= FARTHEST), ("order", free[0] if free else None, lambda i: True))
        how, found = next(((name, i) for name, i, good in rules if i is not None and good(i)), ("unmapped", None))
        if found is not None:
            free.remove(found)
        out.append((p.doc_id, p.pos, found.filename if found is not None else None, how))
    return pd.DataFrame(out, columns=["doc_id", "pos", "filename", "method"])


def matched_images(pictures: DataFrame, images: DataFrame) -> DataFrame:
    """pictures (doc_id, page, pos, x0, y0, x1, y1), images (doc_id, page, idx, filename, x0, y0, x1, y1): one image at most for each picture and the other way round. In the order of
    pos a picture takes, of its page's images that are left, that of the greatest overlap, else the nearest, else the first. A picture without a page has none. A page is one group."""
    by = ["doc_id", "page"]
    none = pictures.filter("page is null").select("doc_id", "pos", F.lit(None).cast("string").alias("filename"), F.lit("unmapped").alias("method"))
    placed = pictures.filter("page is not null").groupBy(*by).cogroup(images.groupBy(*by)).applyInPandas(_matched, "doc_id long, pos long, filename string, method string")
    return placed.unionByName(none)


def named_placeholders(lines: DataFrame, matches: DataFrame) -> DataFrame:
    """lines (doc_id, line_no, line): the k-th `<!-- image -->` names the k-th match (pos from 0), `unmapped` without a file; those beyond the matches stay."""
    mark = F.trim("line") == "<!-- image -->"
    nth = F.sum(mark.cast("long")).over(Window.partitionBy("doc_id").orderBy("line_no")) - 1
    at = lines.withColumn("pos", F.when(mark, nth))
    named = F.concat(F.lit("<!-- IMAGE: "), F.coalesce("filename", F.lit("unmapped")), F.lit(" -->"))
    return at.join(matches.select("doc_id", "pos", "filename", F.lit(True).alias("there")), ["doc_id", "pos"], "left").select("doc_id", "line_no", F.when(F.col("there"), named).otherwise(F.col("line")).alias("line"))


# ---- the analysis plan ------------------------------------------------------------------------------


def _told(value: Column, empty: list[str]) -> Column:
    return F.when(~F.lower(F.trim(value)).isin(empty), F.trim(value))


def analysis_summary(documents: DataFrame, images: DataFrame) -> DataFrame:
    """documents (doc_id, context_title, front_title, context_domain, front_domain), images (doc_id, no, is_duplicate, blank, decorative, classification, personas, width, height): for each
    document what is skipped, by the first reason that holds, what is left and how often each persona is asked; the most frequent one, the first met on ties; sizes over 2,000; title and domain by priority."""
    flag = lambda c: F.coalesce(F.col(c), F.lit(False))
    why = F.when(flag("is_duplicate"), "duplicate").when(flag("blank"), "blank").when(flag("decorative") | F.coalesce(F.col("classification") == "DEC", F.lit(False)), "decorative").otherwise("left")
    x = images.withColumn("why", why).withColumn("side", F.greatest("width", "height")).withColumn("side", F.when(F.col("width").isNotNull() & F.col("height").isNotNull(), F.col("side")))
    left = F.col("why") == "left"
    count = lambda w: F.count_if(F.col("why") == w)
    per = x.groupBy("doc_id").agg(F.count(F.lit(1)).alias("total_images"), count("left").alias("images_for_analysis"), count("duplicate").alias("skipped_duplicates"), count("blank").alias("skipped_blanks"), count("decorative").alias("skipped_decoratives"), F.coalesce(F.sum(F.when(left, F.size("personas"))), F.lit(0)).alias("total_persona_analyses"), F.max(F.when(left, F.col("side"))).alias("max_dimension"), F.count_if(left & (F.col("side") > 2000)).alias("images_over_2000px"))
    asked = x.filter(left).select("doc_id", "no", F.posexplode("personas").alias("k", "persona")).groupBy("doc_id", "persona").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("no", "k")).alias("met"))
    rank = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.desc("n"), "met"))
    top = asked.withColumn("rank", rank).filter("rank = 1").select("doc_id", "persona", "n")
    title = F.coalesce(_told(F.col("context_title"), ["", "unknown"]), _told(F.col("front_title"), ["", "unknown"]), F.lit("Unknown"))
    domain = F.coalesce(_told(F.col("context_domain"), ["", "general"]), _told(F.col("front_domain"), ["", "general"]), F.lit("general"))
    out = documents.join(per, "doc_id", "left").join(top, "doc_id", "left")
    counts = [c for c in per.columns if c not in ("doc_id", "max_dimension")]
    share = F.bround(F.coalesce("total_persona_analyses", F.lit(0)) / F.greatest(F.lit(1), F.coalesce("images_for_analysis", F.lit(0))), 1)
    common = F.concat("persona", F.lit(" ("), F.col("n").cast("string"), F.lit("/"), F.col("images_for_analysis").cast("string"), F.lit(" images)"))
    return out.select("doc_id", title.alias("document_title"), domain.alias("document_domain"), *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts], F.col("max_dimension").cast("long").alias("max_dimension"), share.alias("avg_personas_per_image"), common.alias("most_common_persona"))
