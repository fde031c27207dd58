"""Structure of Markdown documents: sections, titles, tables, references."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from inkstrata.functions.text import words

def _by_doc():
    return Window.partitionBy("doc_id").orderBy("line_no")


def sections(lines: DataFrame) -> DataFrame:
    """A row per heading: doc_id, section, heading, level, line_start, line_end, word_count (heading line included), n_images. Text before the first heading is in none."""
    level = F.length(F.regexp_extract("line", r"^(#{1,6})\s", 1))
    marked = lines.withColumn("level", level).withColumn("section", F.sum((level > 0).cast("int")).over(_by_doc()))
    return (
        marked.filter("section > 0")
        .groupBy("doc_id", "section")
        .agg(
            F.max(F.when(F.col("level") > 0, F.regexp_replace("line", r"^#{1,6}\s+", ""))).alias("heading"),
            F.max("level").alias("level"),
            F.min("line_no").alias("line_start"),
            F.max("line_no").alias("line_end"),
            F.sum(F.size(words(F.col("line")))).cast("long").alias("word_count"),
            F.sum(F.regexp_count("line", F.lit(r"!\[[^\]]*\]\("))).cast("long").alias("n_images"),
        )
    )


def heading_jumps(lines: DataFrame) -> DataFrame:
    """Headings more than one level below the heading before."""
    h = lines.withColumn("level", F.length(F.regexp_extract("line", r"^(#{1,6})\s", 1))).filter("level > 0")
    h = h.withColumn("before", F.lag("level").over(_by_doc()))
    return h.filter("level > before + 1").select("doc_id", "line_no", F.col("before").alias("from_level"), F.col("level").alias("to_level"))


def section_of_page(sections: DataFrame, pages: DataFrame) -> DataFrame:
    """pages (doc_id, page, total): the section that holds the page's estimated line, else the nearest that ends before it."""
    ends = sections.groupBy("doc_id").agg(F.max("line_end").alias("last"))
    at = pages.join(ends, "doc_id").withColumn("est", F.floor(F.col("page") * F.col("last") / F.col("total")))
    hit = at.join(sections.select("doc_id", "heading", "line_start", "line_end"), "doc_id")
    inside = F.col("est").between(F.col("line_start"), F.col("line_end"))
    rank = F.when(inside, F.struct(F.lit(1).alias("in"), (-F.col("line_start")).alias("near"))).when(F.col("line_end") <= F.col("est"), F.struct(F.lit(0).alias("in"), F.col("line_end").alias("near")))
    return hit.groupBy("doc_id", "page").agg(F.max_by("heading", rank).alias("heading"))


def last_heading_before(headings: DataFrame, points: DataFrame) -> DataFrame:
    """As-of join: for points (doc_id, page) the heading (doc_id, page, heading) of the greatest page at or before it."""
    both = headings.select("doc_id", "page", "heading", F.lit(0).alias("side")).unionByName(points.select("doc_id", "page", F.lit(None).cast("string").alias("heading"), F.lit(1).alias("side")))
    w = Window.partitionBy("doc_id").orderBy("page", "side").rowsBetween(Window.unboundedPreceding, 0)
    return both.withColumn("heading", F.last("heading", True).over(w)).filter("side = 1").drop("side")


def title(lines: DataFrame, rejected: list[str], first: int = 80) -> DataFrame:
    """The first level-1 heading among the first lines that isn't short or institutional."""
    h = lines.filter((F.col("line_no") <= first) & F.col("line").rlike(r"^# ")).withColumn("t", F.trim(F.substring("line", 3, 100000)))
    ok = F.length("t") > 5
    for r in rejected:
        ok = ok & ~F.lower("t").contains(r)
    return h.filter(ok).groupBy("doc_id").agg(F.min_by("t", "line_no").alias("title"))


# What headings of institutions and programs contain, and are as a whole; how names of journals begin, and such names
INSTITUTIONAL = ["health technology assessment", "statens legemiddelverk", "folkehelseinstituttet", "table of contents", "contents", "systematic review", "rapid review", "technology appraisal", "evidence report", "clinical practice guideline", "erasmus school of health policy", "university of oslo", "uio"]
SOMEWHERE = ["microsoft word", "untitled", "slide ", "powerpoint", "health technology assessment", "statens legemiddelverk", "folkehelseinstituttet", "table of contents", "erasmus school of health policy", "university of oslo"]
WHOLLY = ["presentation", "document", "pdf", "contents", "systematic review", "rapid review", "technology appraisal", "evidence report", "clinical practice guideline", "uio"]
JOURNAL_STARTS = ["journal of", "the journal of", "annals of", "proceedings of", "transactions on", "archives of", "bulletin of", "international journal", "european journal", "american journal", "british journal"]
JOURNALS = ["value in health", "pharmacoeconomics", "medical decision making", "the lancet", "the bmj", "nature", "science", "plos one", "bmc health services research", "bmc medicine", "health technology assessment", "journal of medical economics"]


def is_institutional(heading: Column) -> Column:
    """Short headings, and those of institutions and kinds of report."""
    low = F.lower(heading)
    return (F.length(heading) <= 5) | F.exists(F.array(*map(F.lit, INSTITUTIONAL)), lambda x: low.contains(x))


def is_no_title(heading: Column) -> Column:
    """Short headings, names of institutions and programs anywhere, kinds of report and names of journals as a whole."""
    low = F.trim(F.lower(heading))
    some = lambda names, test: F.exists(F.array(*map(F.lit, names)), test)
    return (F.length(heading) <= 5) | some(SOMEWHERE, lambda x: low.contains(x)) | low.isin(WHOLLY + JOURNALS) | some(JOURNAL_STARTS, lambda x: low.startswith(x))


def title_or_subtitle(lines: DataFrame, first: int = 30) -> DataFrame:
    """The first level-1 heading among the first lines that can be a title, else the first such of level 2, without marks: doc_id, title. Documents without either have no row."""
    h = lines.filter((F.col("line_no") <= first) & F.col("line").rlike("^##? ")).withColumn("level", F.when(F.col("line").startswith("## "), 2).otherwise(1))
    t = F.trim(F.regexp_replace(F.trim(F.regexp_replace("line", r"^#+\s*", "")), r"\*+", ""))
    t = F.trim(F.regexp_replace(F.trim(F.regexp_replace(t, r"\s*\{#[^}]*\}\s*$", "")), "^`+|`+$", ""))
    h = h.withColumn("title", t).filter(~is_no_title(F.col("title")))
    return h.groupBy("doc_id").agg(F.min_by("title", F.struct("level", "line_no")).alias("title"))


def table_blocks(lines: DataFrame) -> DataFrame:
    """Maximal runs of lines that begin and end with a pipe: doc_id, table_no, start, end, n_rows."""
    t = lines.filter(F.col("line").rlike(r"^\s*\|.*\|\s*$"))
    t = t.withColumn("island", F.col("line_no") - F.row_number().over(_by_doc()))
    b = t.groupBy("doc_id", "island").agg(F.min("line_no").alias("start"), F.max("line_no").alias("end"), F.count(F.lit(1)).alias("n_rows"), F.min(F.size(F.split("line", r"\|")) - 2).alias("min_cols"), F.max(F.size(F.split("line", r"\|")) - 2).alias("max_cols"))
    return b.withColumn("table_no", F.row_number().over(Window.partitionBy("doc_id").orderBy("start"))).drop("island")


def numeric_tokens(rows: DataFrame) -> DataFrame:
    """rows (doc_id, row): numbers in each cell, where dates, ranges and sizes count once: doc_id, cell_no, n."""
    cells = rows.select("doc_id", F.posexplode(F.expr(r"slice(split(row, '\\|'), 2, size(split(row, '\\|')) - 2)")))
    x = F.regexp_replace("col", r"\d{4}-\d{2}-\d{2}", "7")
    x = F.regexp_replace(x, r"\d+(\.\d+)?\s*[-x]\s*\d+(\.\d+)?", "7")
    return cells.select("doc_id", (F.col("pos") + 1).alias("cell_no"), F.regexp_count(x, F.lit(r"\d+(\.\d+)?")).cast("long").alias("n"))


def unexplained_tables(lines: DataFrame, within: int = 49) -> DataFrame:
    """First mentions of `Table N` without a pipe row in the lines that follow: doc_id, table_ref, line_no."""
    m = lines.withColumn("ref", F.regexp_extract("line", r"Table (\d+)", 1)).filter("ref <> ''").groupBy("doc_id", F.col("ref").cast("int").alias("table_ref")).agg(F.min("line_no").alias("line_no"))
    pipes = lines.filter(F.col("line").startswith("|")).select("doc_id", F.col("line_no").alias("at"))
    near = (m.doc_id == pipes.doc_id) & pipes["at"].between(m.line_no + 1, m.line_no + within)
    return m.join(pipes, near, "left_anti")


def joined_references(lines: DataFrame) -> DataFrame:
    """After a References heading, continuation lines joined to the entry `[n]` or `n.` they belong to: doc_id, entry_no, entry."""
    flag = F.col("line").rlike(r"(?i)^(#{1,6} )?(references?|bibliography)\s*$").cast("int")
    refs = lines.withColumn("in", F.sum(flag).over(_by_doc())).filter((F.col("in") > 0) & (flag == 0) & (F.trim("line") != ""))
    refs = refs.withColumn("line", F.regexp_replace("line", r"^#{1,6} ", ""))
    new = F.col("line").rlike(r"^(\[\d+\]|\d+\.)").cast("int")
    refs = refs.withColumn("entry_no", F.sum(new).over(_by_doc())).filter("entry_no > 0")
    got = refs.groupBy("doc_id", "entry_no").agg(F.array_sort(F.collect_list(F.struct("line_no", "line"))).alias("x"))
    return got.select("doc_id", "entry_no", F.array_join("x.line", " ").alias("entry"))


def reference_gaps(docs: DataFrame, top: int = 9999) -> DataFrame:
    """Numbers cited as [n], [a-b] (at most 50 wide) or [a,b]; years dropped; the span and what is missing in it."""
    refs = F.regexp_extract_all("text", F.lit(r"\[(\d+(?:\s*[-,]\s*\d+)*)\]"), 1)
    groups = docs.select("doc_id", F.explode(refs).alias("g")).select("doc_id", F.explode(F.split("g", r"\s*,\s*")).alias("p"))
    lo, hi = F.split("p", r"\s*-\s*")[0].cast("int"), F.element_at(F.split("p", r"\s*-\s*"), -1).cast("int")
    n = groups.withColumn("lo", lo).withColumn("hi", hi).filter(f"lo between 1 and {top} and hi between lo and lo + 50")
    n = n.select("doc_id", F.explode(F.sequence("lo", "hi")).alias("n")).filter("n not between 1900 and 2099")
    s = n.groupBy("doc_id").agg(F.array_sort(F.collect_set("n")).alias("s"))
    gaps = F.array_except(F.sequence(F.array_min("s"), F.array_max("s")), F.col("s"))
    return s.select("doc_id", F.array_min("s").alias("first_ref"), F.array_max("s").alias("last_ref"), F.array_join(F.array_sort(gaps), ",").alias("missing"))


# Headings that are a publisher's, and those of major sections; whole headings, in any case
BOILERPLATE = [r"ScienceDirect", r"ORIGINAL\s+RESEARCH", r"ISPOR\s+Report", r"Elsevier", r"Taylor\s*&\s*Francis", r"Springer", r"Wiley", r"BMJ", r"Oxford\s+Academic"]
MAJOR = [r"Introduction", r"Background", r"Methods", r"Methodology", r"Materials?\s+and\s+Methods", r"Results", r"Discussion", r"Conclusions?", r"Summary", r"References", r"Acknowledgm?ents?", r"Transparency", r"Supplementary\s+Materials?", r"Appendix", r"ABSTRACT", r"Keywords?", r"Disclosures?", r"Funding", r"Limitations", r"Conflicts?\s+of\s+Interest", r"Author\s+Contributions?", r"Data\s+Availability", r"Ethics"]


def whole(forms: list[str]) -> str:
    return f"(?i)^({'|'.join(forms)})$"


def releveled(lines: DataFrame) -> DataFrame:
    """lines (doc_id, line_no, line) with headings of levels 1 to 4 by their role; only headings are shuffled.

    A publisher's heading becomes an empty line. The title gets level 1: the first heading of over 15 characters, unless a
    shorter major section comes before it; then the heading before that section or, without one, that section. Major
    sections and other headings of level 1 get 2. A heading deeper than the one before it gets that one's new level plus 1, and
    any other 3; none exceeds 4. Without a long heading or a major section there is no title. So a run of ever deeper headings counts on from the heading it starts at.
    Null lines are no headings."""
    form = r"^(#{1,6})\s+(.+)$"
    is_heading = F.coalesce(F.col("line").rlike(form), F.lit(False))
    heads = lines.filter(is_heading).select("doc_id", "line_no", F.length(F.regexp_extract("line", form, 1)).alias("level"), F.trim(F.regexp_extract("line", form, 2)).alias("heading"))
    heads = heads.withColumn("plain", F.trim(F.regexp_replace("heading", r"^[* ]+|[* ]+$", "")))
    boilerplate = F.col("plain").rlike(whole(BOILERPLATE))
    heads = heads.withColumn("major", F.col("plain").rlike(whole(MAJOR)))
    kept = heads.filter(~boilerplate).withColumn("n", F.row_number().over(_by_doc()))
    every = Window.partitionBy("doc_id")
    telling = F.when((F.length("plain") > 15) | F.col("major"), F.struct("n", (F.length("plain") > 15).alias("long")))
    kept = kept.withColumn("first", F.min(telling).over(every))
    title = F.when(F.col("first.long"), F.col("first.n")).when(F.col("first.n") > 1, F.col("first.n") - 1).otherwise(F.col("first.n"))
    is_title = F.coalesce(F.col("n") == title, F.lit(False))
    top = F.when(is_title, 1).when(F.col("major") | (F.col("level") == 1), 2)
    kept = kept.withColumn("top", top).withColumn("before", F.lag("level").over(_by_doc()))
    start = F.when(F.col("top").isNotNull(), F.col("top")).when(F.coalesce(F.col("level") <= F.col("before"), F.lit(True)), 3)
    kept = kept.withColumn("start", F.when(start.isNotNull(), F.struct(start.alias("at"), "n")))
    kept = kept.withColumn("run", F.last("start", ignorenulls=True).over(_by_doc()))
    new = F.least(F.col("run.at") + F.col("n") - F.col("run.n"), F.lit(4))
    return (
        lines.filter(~is_heading).select("doc_id", "line_no", "line")
        .unionByName(heads.filter(boilerplate).select("doc_id", "line_no", F.lit("").alias("line")))
        .unionByName(kept.select("doc_id", "line_no", F.concat(F.repeat(F.lit("#"), new), F.lit(" "), "heading").alias("line")))
    )
