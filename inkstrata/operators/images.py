"""Rules over image measurements, and the tables of images that documents and agents read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from inkstrata.operators.quality import judged_tables
from inkstrata.sources.tables import lines

#: Bytes, width, height, mean and deviation of grey, distinct colours (null: not RGB), mean alpha (null: opaque).
PIXELS = ["size_bytes", "width", "height", "mean", "std", "colors", "alpha"]
WARNING = "WARNING: Table may have collapsed columns"


def _sure(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def is_blank(size: Column, w: Column, h: Column, mean: Column, std: Column, colors: Column, alpha: Column) -> Column:
    """Placeholders, dark fragments, even greys, blocks of colour and badges; an unknown measurement decides nothing."""
    opaque = ~_sure(alpha < 250)
    return (
        _sure(size < 2000)
        | _sure((size > 0) & (size < 5000) & (mean < 30) & (colors < 16))
        | _sure((std < 5) & opaque)
        | _sure((colors < 32) & (mean < 240) & (std < 30))
        | _sure((size > 0) & (size <= 50000) & (size < 0.15 * w * h) & (colors < 50) & (std < 40))
    )


def is_blank_render(size: Column, w: Column, h: Column, std: Column, colors: Column, least: Column, not_white: Column, white_share: Column) -> Column:
    """An office picture that failed to render: least is the least channel value, not_white the count of pixels with a channel of 240
    or less, white_share that of a 10 x 10 grid. Large files and busy pictures never are."""
    kept = _sure(size > 50000) | _sure((std > 20) & (colors > 100))
    sparse = _sure((w > 500) & (h > 500) & (not_white > 5000))
    return F.when(kept, False).when(_sure(least > 240), True).when(_sure((w == 0) | (h == 0)), True).when(sparse, False).otherwise(_sure(white_share > 0.99))


def is_near_black(mean: Column, std: Column, dark_share: Column) -> Column:
    """Dark all over, or with more than 95 % of pixels under a luminance of 15."""
    return _sure((mean < 10) & ((std < 5) | (dark_share > 0.95)))


def is_oversized(w: Column, h: Column, most: int = 2000) -> Column:
    return _sure(F.greatest(w, h) > most)


def extracted_class(images: DataFrame) -> DataFrame:
    """images (width, height, size_bytes, near_black, rerendered, table_shot, fallback): adds reason and is_substantive."""
    w, h = F.col("width"), F.col("height")
    known = (w > 0) & (h > 0)
    reason = (
        F.when(F.col("near_black") & ~_sure(F.col("rerendered")), "near-black (render failed)")
        .when(known & (h < 50) & (w >= 50), F.concat(F.lit("narrow_fragment (h="), h.cast("string"), F.lit("px)")))
        .when(known & (w < 50) & (h >= 50), F.concat(F.lit("narrow_fragment (w="), w.cast("string"), F.lit("px)")))
        .when(known & (w < 50) & (h < 50), "tiny image (< 50x50)")
        .when(F.col("size_bytes") < 2048, "tiny file (< 2KB)")
    )
    kept = F.when(F.col("table_shot"), "table screenshot").when(F.col("fallback"), "fallback extraction").otherwise("default")
    return images.withColumn("reason", F.coalesce(reason, kept)).withColumn("is_substantive", reason.isNull())


def office_pages(images: DataFrame) -> DataFrame:
    """images (doc_id, page, is_duplicate, is_blank, is_render, is_chart, flagged, decorative): a page counts if any
    picture that is no duplicate is lost (blank), rendered, a chart, or neither flagged nor decorative: doc_id, page, n_images, label, notes."""
    counts = ~F.col("is_duplicate") & (F.col("is_blank") | F.col("is_render") | F.col("is_chart") | ~(F.col("flagged") | F.col("decorative")))
    p = images.groupBy("doc_id", "page").agg(F.count(F.lit(1)).alias("n_images"), F.bool_or(_sure(counts)).alias("any"), F.bool_and("is_duplicate").alias("copies"), F.bool_or("is_blank").alias("lost"))
    label = F.when(F.col("copies"), "No (duplicate)").when(F.col("any"), "Yes").otherwise("No")
    notes = F.concat_ws("; ", F.when(F.col("lost") & F.col("any"), "content lost"), F.when(F.col("copies"), "all images are duplicates"))
    return p.select("doc_id", "page", "n_images", label.alias("label"), notes.alias("notes"))


def page_of_file(path: Column) -> Column:
    """The page that a file name gives as pageN or as pN between separators; null if neither."""
    stem = F.regexp_extract(path, r"([^/]+?)(\.[^./]*)?$", 1)
    a, b = F.regexp_extract(stem, r"(?i)page[-_]?(\d+)", 1), F.regexp_extract(stem, r"(?i)(?:^|[-_])p(\d+)(?:[-_]|$)", 1)
    return F.coalesce(F.when(a != "", a), F.when(b != "", b)).cast("long")


def matched_files(details: DataFrame, files: DataFrame) -> DataFrame:
    """details (doc_id, page, pos, rendered) and files (doc_id, path): the k-th detail of a page gets its k-th file by name, renders
    the page's first render; details without a file drop out: doc_id, page, pos, path."""
    f = files.filter(F.lower("path").rlike(r"\.(png|jpe?g|bmp|tiff?|gif)$")).withColumn("page", page_of_file(F.col("path"))).filter("page is not null")
    is_render = F.regexp_extract("path", r"([^/]+?)(\.[^./]*)?$", 1).contains("render")
    f = f.withColumn("rendered", is_render).withColumn("k", F.row_number().over(Window.partitionBy("doc_id", "page", "rendered").orderBy("path")))
    d = details.withColumn("k", F.when(F.col("rendered"), 1).otherwise(F.row_number().over(Window.partitionBy("doc_id", "page", "rendered").orderBy("pos"))))
    return d.join(f, ["doc_id", "page", "rendered", "k"]).select("doc_id", "page", "pos", "path")


def _listed(rows: DataFrame, order: list[str], line: Column) -> DataFrame:
    """(doc_id, body): a document's lines in order; a document's images are few, so they fit a row."""
    got = rows.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct(*order, line.alias("row_")))).alias("x"))
    return got.select("doc_id", F.array_join("x.row_", "\n").alias("body"))


def _text(c: str, none: str = "?") -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(none))


def image_index(docs: DataFrame, images: DataFrame, folder: str) -> DataFrame:
    """docs (doc_id), images (doc_id, pos, figure_num, description, filename, page, width, height, source_format): doc_id, md with a table, or a
    line that says there are none."""
    link = F.format_string(f"[%s]({folder}/%s)", F.col("filename"), F.col("filename"))
    line = F.concat(F.lit("| "), F.concat_ws(" | ", _text("figure_num"), _text("description", ""), link, _text("page", "-"), F.concat(_text("width"), F.lit("x"), _text("height")), _text("source_format")), F.lit(" |"))
    head = "## Image Index\n\n| Fig | Description | File | Page/Slide | Size | Source |\n|-----|-------------|------|------------|------|--------|\n"
    body = docs.select("doc_id").join(_listed(images, ["pos"], line), "doc_id", "left")
    return body.select("doc_id", F.when(F.col("body").isNull(), "## Image Index\n\nNo images extracted.\n\n").otherwise(F.concat(F.lit(head), "body", F.lit("\n\n"))).alias("md"))


def filled_placeholder(docs: DataFrame, images: DataFrame) -> DataFrame:
    """docs (doc_id, md) whose text says `No images extracted.` get a table of the images (doc_id, pos, figure_num, filename, page, width, height,
    excluded) that aren't excluded, and the count of those that are."""
    line = F.concat(F.lit("| "), F.concat_ws(" | ", _text("figure_num"), _text("filename", ""), _text("page"), F.concat(_text("width"), F.lit("x"), _text("height"))), F.lit(" |"))
    n = images.groupBy("doc_id").agg(F.count_if("excluded").alias("out"), F.count(F.lit(1)).alias("n"))
    n = n.join(_listed(images.filter(~F.col("excluded")), ["pos"], line), "doc_id", "left")
    tail = F.when(F.col("out") > 0, F.format_string("\n\n*Showing %d substantive images. %d decorative/blank/duplicate images excluded.*", F.col("n") - F.col("out"), F.col("out"))).otherwise("")
    table = F.concat(F.lit("| Figure | File | Page | Size |\n|--------|------|------|------|"), F.coalesce(F.concat(F.lit("\n"), "body"), F.lit("")), tail)
    both = docs.join(n.withColumn("table_", table).select("doc_id", "table_"), "doc_id", "left")
    return both.select("doc_id", F.when(F.col("table_").isNull(), F.col("md")).otherwise(F.replace("md", F.lit("No images extracted."), F.col("table_"))).alias("md"))


def agent_rows(pages: DataFrame, images: DataFrame) -> DataFrame:
    """pages (doc_id, page, context) that count and images (doc_id, page, figure_num, file_path, heading, nearby): a row per image, or one for
    a page without: doc_id, page, figure_num, file_path, section, nearby (120 characters, pipes escaped)."""
    j = pages.join(images.withColumn("has", F.lit(True)), ["doc_id", "page"], "left")
    near = F.coalesce(F.when(F.col("nearby") != "", F.col("nearby")), F.col("context"), F.lit(""))
    short = F.concat(F.replace(F.left(near, F.lit(120)), F.lit("|"), F.lit("\\|")), F.when(F.col("has") & (F.length(near) > 120), "...").otherwise(""))
    return j.select("doc_id", "page", _text("figure_num").alias("figure_num"), F.coalesce("file_path", F.when(F.col("has"), "?").otherwise("(see manifest)")).alias("file_path"), F.replace(_text("heading", "—"), F.lit("|"), F.lit("\\|")).alias("section"), short.alias("nearby"))


def annotated_tables(lines: DataFrame, flagged: DataFrame, reach: int = 5) -> DataFrame:
    """lines (doc_id, line_no, line) with a comment after each flagged table (doc_id, start, end, n_values, n_cols), unless a warning stands within
    reach lines on either side with only blank lines and comments between: doc_id, line_no, line, numbered anew."""
    t = flagged.select("doc_id", "start", "end", "n_values", "n_cols").distinct()
    side = F.when(F.col("line_no") > F.col("end"), F.col("line_no") - F.col("end")).when(F.col("line_no") < F.col("start"), F.col("line_no") - F.col("start"))
    warns, stops = F.col("line").contains(WARNING), (F.trim("line") != "") & ~F.ltrim("line").startswith("<!--")
    near = t.join(lines, "doc_id").withColumn("d", side).filter(F.abs("d").between(1, reach))
    first = lambda c: F.min(F.when(c, F.abs("d")))
    seen = near.groupBy("doc_id", "start", "end", (F.col("d") > 0).alias("after")).agg(first(warns).alias("warn"), first(stops).alias("stop"))
    seen = seen.filter("warn <= coalesce(stop, warn)").select("doc_id", "start", "end").distinct()
    note = F.format_string(f"<!-- {WARNING}. Original had %d values but only %d columns detected. Manual verification recommended. -->", F.col("n_values"), F.col("n_cols"))
    new = t.join(seen, ["doc_id", "start", "end"], "left_anti").select("doc_id", F.col("end").alias("line_no"), F.lit(1).alias("late"), note.alias("line"))
    both = lines.select("doc_id", "line_no", F.lit(0).alias("late"), "line").unionByName(new)
    return both.select("doc_id", F.row_number().over(Window.partitionBy("doc_id").orderBy("line_no", "late")).alias("line_no"), "line")


def annotated_documents(docs: DataFrame) -> DataFrame:
    """docs (doc_id, md), a row each: md with a warning after each table whose columns seem merged; a second run changes nothing."""
    rows = lines(docs)
    done = annotated_tables(rows, judged_tables(rows).filter("reason is not null"))
    done = done.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("line_no", "line"))).alias("l"))
    return done.select("doc_id", F.array_join("l.line", "\n").alias("md"))
