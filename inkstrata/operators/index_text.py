"""Image indexes as text: written from pages and images, and rewritten where overrides change a page's class."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkstrata.operators.classify import has_vector_content

# The headings, table heads and sentences of an index
PAGE_HEAD = "## Page-by-Page Index\n\n| Page | Images | Substantive | Context (first 150 chars) |\n|------|--------|-------------|---------------------------|"
IMAGE_HEAD = "## Per-Image Classification Detail\n\n| Page | Image | Dims | File Size | Class | Reason |\n|------|-------|------|-----------|-------|--------|"
SUBSTANTIVE_HEAD = "## Substantive Images Only\n\n| Page | Images | Context |\n|------|--------|---------|"
NO_IMAGES, NO_SUBSTANTIVE, NO_TEXT = "| — | — | — | No images found in document |", "| — | — | No substantive images found |", "[no text on page]"
CRITERIA = "dimensions (<50x50px), repeated xref (>50% pages), title/cover page, last-page decorations, figure keywords, journal branding (<100px/<5KB/extreme aspect), blank image detection (3-tier: size<2KB/near-black/<16colors/std<5), M1 color-block (<32 unique colors), low-density badge (<0.15 B/px AND <50 colors), low word count render (<20 words)"
OVERRIDDEN = "- Manual overrides applied: %d page(s) (via image-index-overrides.json)"
ESTIMATE, DECORATIVE_PAGES, SUBSTANTIVE_PAGES, CRITERIA_LINE = "Estimated substantive images:", "- Pages classified as decorative:", "- Pages classified as substantive:", "- Filtering criteria applied:"


def _listed(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """(doc_id, name): the lines of a document in order; null lines are left out."""
    some = rows.filter("line is not null").groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct(*order, "line"))).alias("l"))
    return some.select("doc_id", F.array_join("l.line", "\n").alias(name))


def _said(c: str) -> Column:
    return F.replace(F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit(NO_TEXT)), F.lit("|"), F.lit("\\|"))


def _text(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def written_index(docs: DataFrame, pages: DataFrame, images: DataFrame) -> DataFrame:
    """docs (doc_id, stem, source_path, output_path, generated, version, n_overrides, n_files), pages (doc_id, page, image_count, is_substantive, context, drawings,
    area, rendered), images (doc_id, page, pos, file_path, xref, width, height, size_bytes, is_substantive, reason): doc_id, md with totals, a table of pages with images, one of
    images, one of substantive pages, notes on vector drawings and a summary. An image without a class counts as substantive, but not in the table of
    substantive pages. A document's pages and images fit a row, as its index does."""
    own = images.groupBy("doc_id", "page").agg(F.count_if("is_substantive").alias("n_sub"))
    p = pages.join(own, ["doc_id", "page"], "left").withColumn("drawn", F.coalesce(has_vector_content(F.col("drawings"), F.col("area")), F.lit(False)))
    some = F.col("image_count") > 0
    yes = F.coalesce(F.col("is_substantive"), F.lit(False))
    row = F.when(some, _text("| ", F.col("page"), " | ", F.col("image_count"), " | ", F.when(yes, "Yes").otherwise("No"), " | ", _said("context"), " |"))
    only = F.when(yes, _text("| ", F.col("page"), " | ", F.coalesce("n_sub", F.lit(0)), " | ", _said("context"), " |"))
    found = _text("- Page ", F.col("page"), ": ", F.col("drawings"), " vector drawings detected ")
    note = F.when(F.col("drawn") & F.coalesce("rendered", F.lit(False)), _text(found, "(page rendered as PNG)")).when(F.col("drawn") & some, _text(found, "(figure may contain additional vector elements)"))
    fates = p.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_pages"), F.count_if(some).alias("with_images"), F.sum("image_count").alias("n_images"), F.count_if(yes).alias("sub_pages"), F.count_if(some & ~yes).alias("dec_pages"), F.count_if("rendered").alias("n_rendered"))
    kept = F.coalesce(F.col("is_substantive"), F.lit(True))
    name = F.when(F.coalesce("file_path", F.lit("")) != "", F.regexp_extract("file_path", "([^/]*)$", 1)).otherwise(_text("xref-", F.coalesce(F.col("xref").cast("string"), F.lit("?"))))
    size = F.when(F.coalesce("file_path", F.lit("")) == "", "").otherwise(F.coalesce(F.concat(F.format_number("size_bytes", 0), F.lit("B")), F.lit("?")))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    image = _text("| ", F.col("page"), " | ", name, " | ", zero("width"), "x", zero("height"), " | ", size, " | ", F.when(kept, "SUB").otherwise("DEC"), " | ", F.coalesce("reason", F.lit("unknown")), " |")
    classes = images.groupBy("doc_id").agg(F.count_if(kept).alias("sub"), F.count_if(~kept).alias("dec"))
    x = docs.join(fates, "doc_id", "left").join(classes, "doc_id", "left").fillna(0, ["n_pages", "with_images", "n_images", "sub_pages", "dec_pages", "n_rendered", "sub", "dec", "n_overrides", "n_files"])
    for rows, order, to in ((p.withColumn("line", row), ["page"], "t_pages"), (images.withColumn("line", image), ["page", "pos"], "t_images"), (p.withColumn("line", only), ["page"], "t_only"), (p.withColumn("line", note), ["page"], "t_notes")):
        x = x.join(_listed(rows, order, to), "doc_id", "left")
    several = F.col("n_overrides") > 0
    filtered = F.when(several, _text("(after filtering + ", F.col("n_overrides"), " override(s))")).otherwise("(after filtering)")
    rule = F.lit("\n---\n")
    head = F.concat_ws(
        "\n",
        _text("# Image Index: ", F.col("stem"), "\n"),
        _text("Source: ", F.col("source_path")),
        _text("Converted: ", F.col("output_path")),
        _text("Generated: ", F.col("generated")),
        _text("Pipeline version: v", F.col("version"), "\n"),
        _text("Total pages: ", F.col("n_pages")),
        _text("Pages with images: ", F.col("with_images")),
        _text("Total images detected: ", F.col("n_images")),
        _text(ESTIMATE, " ", F.col("sub_pages"), " ", filtered),
        _text("Substantive image files: ", F.col("sub")),
        _text("Decorative image files: ", F.col("dec")),
    )
    told = F.concat_ws(
        "\n",
        F.lit("## Filtering Summary\n"),
        _text("- Pages scanned: ", F.col("n_pages")),
        _text("- Pages with images: ", F.col("with_images")),
        F.when((F.col("n_files") > 0) & (F.col("n_files") != F.col("n_images")), _text("- Total image files on disk: ", F.col("n_files"))),
        _text("- Images classified SUB: ", F.col("sub")),
        _text("- Images classified DEC: ", F.col("dec")),
        _text(DECORATIVE_PAGES, " ", F.col("dec_pages")),
        _text(SUBSTANTIVE_PAGES, " ", F.col("sub_pages")),
        _text(CRITERIA_LINE, " ", CRITERIA, F.when(F.col("n_rendered") > 0, _text(", vector rendering (", F.col("n_rendered"), " pages)")).otherwise("")),
        F.when(several, F.format_string(OVERRIDDEN, "n_overrides")),
        F.lit(""),
    )
    parts = [head, rule, F.lit(PAGE_HEAD), F.col("t_pages"), F.when(F.col("with_images") == 0, NO_IMAGES), rule, F.lit(IMAGE_HEAD), F.col("t_images"), rule, F.lit(SUBSTANTIVE_HEAD), F.coalesce("t_only", F.lit(NO_SUBSTANTIVE)), rule]
    notes = F.when(F.col("t_notes").isNotNull(), _text("## Vector Content Notes\n\n", F.col("t_notes"), "\n\n---\n"))
    return x.select("doc_id", F.concat_ws("\n", *parts, notes, told).alias("md"))


# The filters that an office index names, by its source
OFFICE_CRITERIA = {True: "manifest blank flag, manifest duplicate flag, manifest decorative flag, dimensions (<50x50px), title/cover page, last-page decorations, figure keywords", False: "dimensions (<50x50px), repeated image (>50% pages), title/cover page, last-page decorations, figure keywords"}


def written_office_index(docs: DataFrame, pages: DataFrame) -> DataFrame:
    """docs (doc_id, stem, source_path, output_path, generated, version, manifest, total_pages, total_images), pages (doc_id, page, images, label, is_substantive,
    lost, n_decorative, context, notes array) of those with images: doc_id, md. With a manifest (its name, else null) tables have a column of notes, and images that
    it flags are counted. images are those shown: neither duplicates nor flagged."""
    p = pages.join(docs.select("doc_id", F.col("manifest").isNotNull().alias("listed")), "doc_id")
    sub = F.coalesce(F.col("is_substantive"), F.lit(False))
    said = F.when(F.length("context") > 150, F.concat(F.left("context", F.lit(150)), F.lit("..."))).otherwise(F.coalesce(F.nullif(F.col("context"), F.lit("")), F.lit("[no text context]")))
    note = F.when(F.size("notes") > 0, F.concat(F.lit(" | "), F.array_join("notes", "; "))).otherwise("")
    barred = lambda c: F.replace(c, F.lit("|"), F.lit("\\|"))
    tail = F.concat(F.lit(" | "), barred(said), F.when(F.col("listed"), F.concat(F.lit(" | "), barred(note))).otherwise(""), F.lit(" |"))
    row = _text("| ", F.col("page"), " | ", F.col("images"), " | ", F.col("label"), tail)
    only = F.when(sub, _text("| ", F.col("page"), " | ", F.col("images"), tail))
    flagged = F.when(F.col("listed"), F.col("n_decorative")).otherwise(0)
    n = p.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.sum("images").alias("shown"), F.sum(F.when(sub, F.col("images"))).alias("sub_images"), F.count_if(sub).alias("sub"), F.count_if(~sub).alias("dec"), F.sum(flagged).alias("flagged"), F.count_if(sub & F.col("lost") & F.col("listed")).alias("lost"))
    x = docs.join(n, "doc_id", "left").fillna(0, ["n", "shown", "sub_images", "sub", "dec", "flagged", "lost"])
    x = x.join(_listed(p.withColumn("line", row), ["page"], "t_pages"), "doc_id", "left").join(_listed(p.withColumn("line", only), ["page"], "t_only"), "doc_id", "left")
    listed = F.col("manifest").isNotNull()
    either = lambda a, b: F.when(listed, a).otherwise(b)
    rule = F.lit("\n---\n")
    head = F.concat_ws(
        "\n",
        _text("# Image Index: ", F.col("stem"), "\n"),
        _text("Source: ", F.col("source_path")),
        _text("Converted: ", F.col("output_path")),
        _text("Generated: ", F.col("generated")),
        _text("Pipeline version: v", F.col("version")),
        F.when(listed, _text("Data source: manifest (", F.col("manifest"), ")")),
        _text("\nTotal pages: ", F.col("total_pages")),
        _text("Pages with images: ", F.col("n")),
        _text("Total images detected: ", F.col("total_images")),
        F.when(listed & (F.col("shown") != F.col("total_images")), _text("Unique non-decorative images: ", F.col("shown"), " (excludes duplicates and manifest-decorative)")),
        _text(ESTIMATE, " ", F.col("sub_images"), " (after filtering)"),
        F.when(F.col("flagged") > 0, _text("Manifest-decorative images: ", F.col("flagged"), " (small icons/badges flagged during extraction)")),
        F.when(F.col("lost") > 0, _text("Pages with content lost (WMF failure): ", F.col("lost"))),
    )
    page_head = either(PAGE_HEAD.replace("150 chars) |", "150 chars) | Notes |") + "-------|", PAGE_HEAD)
    only_head = either(SUBSTANTIVE_HEAD.replace("Context |", "Context | Notes |") + "-------|", SUBSTANTIVE_HEAD)
    told = F.concat_ws(
        "\n",
        F.lit("## Filtering Summary\n"),
        _text("- Pages scanned: ", F.col("total_pages")),
        _text("- Pages with images: ", F.col("n")),
        _text(DECORATIVE_PAGES, " ", F.col("dec")),
        _text(SUBSTANTIVE_PAGES, " ", F.col("sub")),
        F.when(F.col("flagged") > 0, _text("- Individual images flagged decorative (manifest): ", F.col("flagged"))),
        F.when(F.col("lost") > 0, _text("- Pages with content lost (WMF render failure): ", F.col("lost"))),
        F.when(listed, "- Data source: manifest JSON (includes renders, blank/duplicate flags)"),
        _text(CRITERIA_LINE, " ", either(OFFICE_CRITERIA[True], OFFICE_CRITERIA[False])),
        F.lit(""),
    )
    pages_told = F.coalesce("t_pages", either(NO_IMAGES + " |", NO_IMAGES))
    only_told = F.coalesce("t_only", either(NO_SUBSTANTIVE + " |", NO_SUBSTANTIVE))
    return x.select("doc_id", F.concat_ws("\n", head, rule, page_head, pages_told, rule, only_head, only_told, rule, told).alias("md"))


# ---- overrides in a written index --------------------------------------------------------------------


def _cells(line: str) -> list[str]:
    return [c.strip() for c in line.split("|")][1:-1]


def _moved(line: str, start: str, by: int) -> str:
    m = re.match(re.escape(start) + r"\s*(-?\d+)\s*$", line)
    return f"{start} {max(0, int(m[1]) + by)}" if m else line


def rewritten_index(md: str, classes: dict[int, str]) -> tuple[str, int]:
    """An index with the pages of classes (SUBSTANTIVE or DECORATIVE) changed in its table of pages, the substantive table made anew and totals moved; and how many
    pages changed. Without a change the text stays as it is."""
    out, shown, changed, moved = [], [], 0, 0
    part = head = width = None  # in the substantive table: None, then its head, then its rows
    for line in md.split("\n"):
        if line.startswith("## "):
            part = head = None
            if line.startswith("## Substantive Images Only"):
                part = "substantive"
        cells = _cells(line) if line.startswith("|") else []
        if part == "substantive" and cells:
            if head is None and any("Page" in c for c in cells):
                head, width = "named", len(cells)
            elif head == "named" and all(not c.strip("-") for c in cells):
                head = "ruled"
                rows = [r if width >= 4 else r[:3] for r in shown] or [["—", "—", "No substantive images found", ""][: 4 if width >= 4 else 3]]
                out += [line, *("| " + " | ".join(r) + " |" for r in rows)]
                continue
            elif head == "ruled":
                continue
        elif len(cells) >= 4 and re.fullmatch(r"[+-]?\d+", cells[0]):
            to = classes.get(int(cells[0]))
            was = cells[2].startswith("Yes")
            if to and was != (to == "SUBSTANTIVE"):
                cells[2] = "No" if was else "Yes"
                changed, moved = changed + 1, moved + (-1 if was else 1)
                line = "| " + " | ".join(cells) + " |"
            if cells[2] == "Yes":
                shown.append([cells[0], cells[1], cells[3], cells[4] if len(cells) > 4 else ""])
        out.append(line)
    if not changed:
        return md, 0
    done = []
    for line in out:
        if moved and line.startswith(ESTIMATE) and (m := re.match(rf"{ESTIMATE}\s*(\d+)", line)):
            line = f"{ESTIMATE} {max(0, int(m[1]) + moved)} (after filtering + {changed} override(s))"
        line = _moved(_moved(line, DECORATIVE_PAGES, -moved), SUBSTANTIVE_PAGES, moved)
        done += [line, OVERRIDDEN % changed] if line.startswith(CRITERIA_LINE) else [line]
    return "\n".join(done), changed


def overridden_indexes(docs: DataFrame, overrides: DataFrame) -> DataFrame:
    """docs (doc_id, file, md) and overrides (ord, regex, page, classification), a rule table: doc_id, md, n_changed. The last rule that
    matches a page wins; classes other than SUBSTANTIVE and DECORATIVE don't count. A null md stays null."""
    rules = overrides.withColumn("classification", F.upper("classification")).filter("classification in ('SUBSTANTIVE', 'DECORATIVE')")
    files = docs.select("file").distinct()  # rules meet file names, not texts
    hit = files.join(rules, F.expr("file rlike regex")).groupBy("file", "page").agg(F.max_by("classification", "ord").alias("c"))
    hit = hit.groupBy("file").agg(F.collect_list("page").alias("at"), F.collect_list("c").alias("c"))

    @F.pandas_udf("struct<md string, n_changed long>")
    def run(md: pd.Series, at: pd.Series, c: pd.Series) -> pd.DataFrame:
        rows = [(t, 0) if t is None or a is None else rewritten_index(t, dict(zip(map(int, a), k))) for t, a, k in zip(md, at, c)]
        return pd.DataFrame(rows, columns=["md", "n_changed"])

    x = docs.join(hit, "file", "left").select("doc_id", run("md", "at", "c").alias("x"))
    return x.select("doc_id", "x.md", "x.n_changed")
