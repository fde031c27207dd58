"""Quality-control checks, each a table of issues (doc_id, check_name, severity, message), and the gate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

# Header keys that a converted document must have
HEADER_KEYS = ["source_file", "conversion_date", "conversion_tool", "fidelity_standard", "document_type"]


def _issue(check: str, severity: Column | str, message: Column) -> list[Column]:
    return ["doc_id", F.lit(check).alias("check_name"), (F.lit(severity) if isinstance(severity, str) else severity).alias("severity"), message.alias("message")]


# The key of the page count, by format
COUNT_KEYS = {"pdf": "pages", "pptx": "slides"}


def header_issues(docs: DataFrame) -> DataFrame:
    """docs (doc_id, md): missing header keys, among them that of the page count of its format, or no header at all."""
    head = F.regexp_extract("md", r"(?s)^---\n(.*?)\n---", 1)
    there = docs.withColumn("head", head).withColumn("has", F.col("md").rlike(r"(?s)^---\n.*?\n---"))
    none = there.filter("not has").select(*_issue("header", "FAIL", F.lit("no header block")))
    fmt = F.lower(F.regexp_extract("head", r"source_format:\s*(\w+)", 1))
    own = F.create_map(*[F.lit(x) for kv in COUNT_KEYS.items() for x in kv])[fmt]
    needed = F.array_compact(F.concat(F.array(*map(F.lit, HEADER_KEYS)), F.array(own)))
    keys = there.filter("has").select("doc_id", "head", F.explode(needed).alias("k")).filter(~F.contains("head", F.concat("k", F.lit(":"))))
    return none.unionByName(keys.select(*_issue("header", "FAIL", F.concat(F.lit("missing "), "k"))))


def section_issues(docs: DataFrame) -> DataFrame:
    """docs (doc_id, md, pages): no H1-H3 heading fails; fewer than 3, or than a third of the pages, warns."""
    n = docs.withColumn("n", F.regexp_count("md", F.lit(r"(?m)^#{1,3}\s"))).withColumn("want", F.floor(F.col("pages") / 3))
    rules = F.array(
        F.when(F.col("n") == 0, F.struct(F.lit("FAIL").alias("s"), F.lit("no headings").alias("m"))),
        F.when((F.col("n") > 0) & (F.col("n") < 3), F.struct(F.lit("WARN").alias("s"), F.lit("few headings").alias("m"))),
        F.when((F.col("n") > 0) & (F.col("n") < F.col("want")), F.struct(F.lit("WARN").alias("s"), F.lit("fewer headings than pages suggest").alias("m"))),
    )
    x = n.select("doc_id", F.explode(F.array_compact(rules)).alias("x"))
    return x.select(*_issue("sections", F.col("x.s"), F.col("x.m")))


def table_issues(blocks: DataFrame) -> DataFrame:
    """blocks of table_blocks(): rows with different numbers of cells fail."""
    return blocks.filter("min_cols <> max_cols").select(*_issue("tables", "FAIL", F.format_string("table %d has rows of %d to %d cells", "table_no", "min_cols", "max_cols")))


def collapsed_tables(cells: DataFrame) -> DataFrame:
    """cells (doc_id, table_no, row_no from 0, cell, n_numbers): tables whose columns seem merged: zero numbers, at most 4 rows and under 60%
    of cells filled; or one column with 3 body rows or more; or more than half the body rows with a cell of over 2 numbers."""
    rows = cells.groupBy("doc_id", "table_no", "row_no").agg(F.count(F.lit(1)).alias("n_cells"), F.count_if(F.trim("cell") != "").alias("filled"), F.sum("n_numbers").alias("numbers"), F.max("n_numbers").alias("most"))
    t = rows.groupBy("doc_id", "table_no").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.max("n_cells").alias("cols"),
        F.sum("numbers").alias("numbers"),
        (F.sum("filled") / F.sum("n_cells")).alias("share"),
        F.count_if((F.col("row_no") > 0) & (F.col("filled") > 0)).alias("body"),
        F.count_if((F.col("row_no") > 0) & (F.col("most") > 2)).alias("crowded"),
    )
    why = F.when((F.col("cols") == 1) & (F.col("body") >= 3), "single_column").when((F.col("numbers") == 0) & (F.col("n_rows") <= 4) & (F.col("share") < 0.6), "sparse").when((F.col("body") > 0) & (F.col("crowded") > 0.5 * F.col("body")), "crowded_cells")
    return t.withColumn("reason", why).filter("reason is not null").select("doc_id", "table_no", "reason")


def encoding_issues(lines: DataFrame, most: int = 10) -> DataFrame:
    """Numbers of the first lines with control characters or U+FFFD."""
    bad = lines.filter(F.col("line").rlike("[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F\\x{FFFD}]")).withColumn("k", F.row_number().over(Window.partitionBy("doc_id").orderBy("line_no")))
    got = bad.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.array_join(F.array_sort(F.collect_list(F.when(F.col("k") <= most, F.col("line_no")))), ",").alias("at"))
    return got.select(*_issue("encoding", "WARN", F.concat(F.col("n").cast("string"), F.lit(" lines: "), "at")))


def syntax_issues(docs: DataFrame) -> DataFrame:
    """docs (doc_id, md): odd numbers of bold marks, and of single stars but for list items, escaped ones not counted; links whose bracket stays open in their line, and
    links without target."""
    bare = F.replace("md", F.lit("\\*"), F.lit(""))
    single = F.regexp_replace(F.replace(bare, F.lit("**"), F.lit("")), r"(?m)^\* ", "- ")
    n = docs.select("doc_id", F.regexp_count(bare, F.lit(r"\*\*")).alias("bold"), F.regexp_count(single, F.lit(r"\*")).alias("italic"), F.regexp_count("md", F.lit(r"(?m)\[([^\]]+)\]\([^)]*$")).alias("open"), F.regexp_count("md", F.lit(r"\]\(\s*\)")).alias("links"))
    rules = [("bold % 2 = 1", "odd bold marks: ", "bold"), ("italic % 2 = 1", "odd italic marks: ", "italic"), ("open > 0", "links left open: ", "open"), ("links > 0", "links without target: ", "links")]
    told = F.array_compact(F.array(*[F.when(F.expr(rule), F.concat(F.lit(text), F.col(c).cast("string"))) for rule, text, c in rules]))
    return n.select("doc_id", F.explode(told).alias("m")).select(*_issue("syntax", "WARN", F.col("m")))


def gate(docs: DataFrame, issues: DataFrame) -> DataFrame:
    """(doc_id, n_issues, exit_code): 1 with a FAIL, else 2 with a WARN, else 0, for each of docs."""
    rank = F.when(F.col("severity") == "FAIL", 2).when(F.col("severity") == "WARN", 1).otherwise(0)
    top = issues.groupBy("doc_id").agg(F.max(rank).alias("r"), F.count(F.lit(1)).alias("n_issues"))
    code = F.when(F.col("r") == 2, 1).when(F.col("r") == 1, 2).otherwise(0)
    return docs.select("doc_id").join(top, "doc_id", "left").select("doc_id", F.coalesce("n_issues", F.lit(0)).alias("n_issues"), code.alias("exit_code"))


def set_differences(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Keys on one side only, with `side`: left or right."""
    l, r = left.select(keys).distinct().withColumn("l", F.lit(1)), right.select(keys).distinct().withColumn("r", F.lit(1))
    side = F.when(F.col("r").isNull(), "left").otherwise("right")
    return l.join(r, keys, "full_outer").filter("l is null or r is null").select(*keys, side.alias("side"))


def new_issues(found: DataFrame, recorded: DataFrame, prefix: int = 50) -> DataFrame:
    """Of found (message) what no recorded message begins with, by its first characters."""
    key = F.left("message", F.lit(prefix))
    return found.join(recorded.select(key.alias("k")).distinct(), key == F.col("k"), "left_anti")


# ---- whole tables from lines -----------------------------------------------------------------------

# Cells of separator rows; what counts as one number: sizes, dates, ranges, then numbers; file names; words of an index's header row
SEPARATOR_CELL, SEPARATOR_ROW = r"^[\s:]*-[\s\-:]*$", r"^\|[\s\-:]+\|$"
ONE_NUMBER = [r"\d+\s*[xX]\s*\d+", r"\d{4}[-/]\d{1,2}[-/]\d{1,2}", r"-?\d+(?:[,.]\d+)*%?[-–]-?\d+(?:[,.]\d+)*%?"]
NUMBER = r"-?\d+(?:\.\d+)?(?:[eE][+-]?\d+)?%?"
IMAGE_FILE = r"(?i)\.(png|jpg|jpeg|gif|tiff|svg|bmp|webp)"
INDEX_WORDS = ["page", "file", "classification", "dimensions", "figure_num", "filename", "image_path", "fig_", "page_num", "img_"]
GRID_BORDER = r"^\+[-=+]+\+$"

def _in_order() -> WindowSpec:
    return Window.partitionBy("doc_id").orderBy("line_no")


def _stripped(c: str) -> Column:
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def _cells(row: Column) -> Column:
    parts = F.split(row, r"\|", -1)
    return F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 2, F.lit(0)))


def n_numbers(cell: Column) -> Column:
    """Numbers in a cell; a size, a date or a range is one."""
    x = F.regexp_replace(cell, r"\*{1,2}", "")
    for pattern in ONE_NUMBER:
        x = F.regexp_replace(x, pattern, "\x01")
    return F.regexp_count(x, F.lit(rf"\x01|{NUMBER}"))


def _pipe_rows(lines: DataFrame) -> DataFrame:
    """Rows of pipe tables: doc_id, line_no, row, table_no and the nearest heading before."""
    x = lines.select("doc_id", "line_no", _stripped("line").alias("row")).withColumn("pipe", F.col("row").rlike(r"(?s)^\|(.*\|)?$"))
    x = x.filter(F.col("pipe") | F.col("row").startswith("#"))
    goes_on = F.coalesce(F.lag("pipe").over(_in_order()) & (F.lag("line_no").over(_in_order()) == F.col("line_no") - 1), F.lit(False))
    x = x.withColumn("new", (F.col("pipe") & ~goes_on).cast("long"))
    x = x.withColumn("table_no", F.sum("new").over(_in_order())).withColumn("heading", F.last(F.when(~F.col("pipe"), F.col("row")), ignorenulls=True).over(_in_order()))
    return x.filter("pipe").select("doc_id", "line_no", "row", "table_no", "heading")


def judged_tables(lines: DataFrame) -> DataFrame:
    """lines (doc_id, line_no, line) of Markdown: a row for each pipe table: doc_id, table_no, start, end, n_rows (without separators), n_cols (the most frequent,
    the first on ties), n_values (the most numbers of a body row), is_index (a listing of images) and reason, why its columns seem merged: `sparse` (four rows at most, no number, under
    60 % of cells with more than three characters, or one column), `single_column` (three body rows or more), `crowded_cells` (more than half the body rows have
    a cell of three numbers or more); null if they don't, for listings and without body rows."""
    r = _pipe_rows(lines).withColumn("cells", _cells(F.col("row")))
    r = r.withColumn("data", ~((F.size("cells") > 0) & F.forall("cells", lambda c: c.rlike(SEPARATOR_CELL))))
    r = r.withColumn("head_no", F.min(F.when(F.col("data"), F.col("line_no"))).over(Window.partitionBy("doc_id", "table_no")))
    r = r.withColumn("body", F.col("data") & (F.col("line_no") > F.col("head_no"))).withColumn("numbers", F.transform("cells", n_numbers))
    total = F.aggregate("numbers", F.lit(0), lambda a, n: a + n)
    long = F.size(F.filter("cells", lambda c: F.length(F.trim(F.regexp_replace(c, r"\*{1,2}", ""))) > 3))
    crowded = F.size(F.filter("numbers", lambda n: n > 2))
    r = r.withColumn("total", F.when(F.col("body"), total)).withColumn("long", F.when(F.col("body"), long)).withColumn("crowded", F.when(F.col("body"), crowded))
    t = r.groupBy("doc_id", "table_no").agg(
        F.min("line_no").alias("start"),
        F.max("line_no").alias("end"),
        F.count_if("data").alias("n_rows"),
        F.count_if("body").alias("n_body"),
        F.array_sort(F.collect_list(F.when(F.col("data"), F.struct("line_no", F.greatest(F.size("cells"), F.lit(1)).alias("n"))))).alias("widths"),
        F.coalesce(F.max("total"), F.lit(0)).alias("n_values"),
        F.sum("total").alias("sum_values"),
        F.count_if(F.col("body") & (F.regexp_replace("row", r"[| *]", "") != "")).alias("told"),
        (F.sum("long") / F.sum(F.when(F.col("body"), F.size("cells")))).alias("filled"),
        F.count_if(F.col("crowded") > 0).alias("n_crowded"),
        F.max("crowded").alias("worst"),
        (F.count_if(F.col("row").rlike(IMAGE_FILE)) / F.count(F.lit(1))).alias("files"),
        F.first("heading").alias("heading"),
        F.min_by(F.when(F.col("data"), F.lower("row")), F.when(F.col("data"), F.col("line_no"))).alias("header"),
    )
    widths = F.col("widths.n")
    often = F.array_max(F.transform(F.array_distinct(widths), lambda w, i: F.struct(F.size(F.filter(widths, lambda x: x == w)).alias("k"), (-i).alias("i"), w.alias("w"))))
    t = t.withColumn("n_cols", F.coalesce(often["w"], F.lit(1)))
    hits = sum((F.contains("header", F.lit(w)).cast("int") for w in INDEX_WORDS), F.lit(0))
    index = F.coalesce(F.lower("heading").contains("image index"), F.lit(False)) | (F.col("files") > 0.5) | F.coalesce(hits >= 2, F.lit(False))
    sparse = (F.col("sum_values") == 0) & (F.col("n_rows") <= 4) & (F.col("told") > 0) & ~((F.col("n_cols") >= 2) & (F.coalesce(F.col("filled"), F.lit(0.0)) >= 0.6))
    why = F.when(sparse, "sparse").when(F.col("n_cols") <= 1, F.when(F.col("told") >= 3, "single_column")).when(F.col("n_crowded") > 0.5 * F.col("n_body"), "crowded_cells")
    t = t.withColumn("is_index", index).withColumn("reason", F.when(~F.col("is_index") & (F.col("n_rows") >= 2), why))
    return t.select("doc_id", "table_no", "start", "end", "n_rows", "n_cols", "n_values", "is_index", "reason", "told", "n_body", "n_crowded", "worst")


def collapse_issues(tables: DataFrame) -> DataFrame:
    """Warnings for the tables of judged_tables() with a reason."""
    told = (
        F.when(F.col("reason") == "sparse", F.format_string("Table has %d row(s) with zero numeric values across all data cells — expected data appears missing.", "n_rows"))
        .when(F.col("reason") == "single_column", F.format_string("Single-column table with %d data row(s) detected. Multi-column tables frequently collapse to 1 column during DOCX-to-markdown conversion.", "told"))
        .otherwise(F.format_string("Detected cells with multiple numeric values (%d multi-value cell(s) in worst row) across %d column(s). %d/%d data rows affected.", "worst", "n_cols", "n_crowded", "n_body"))
    )
    text = F.concat(F.format_string("Table %d may have collapsed columns. ", "table_no"), told, F.lit(" Manual verification recommended."))
    return tables.filter("reason is not null").select(*_issue("collapsed_columns", "WARN", text))


def _listing(n: Column) -> Column:
    return F.concat(F.lit("["), F.array_join(F.array_sort(F.collect_set(n)), ", "), F.lit("]"))


def table_structure_issues(lines: DataFrame) -> DataFrame:
    """lines (doc_id, line_no, line): pipe tables whose rows, and grid tables whose borders, differ in columns fail; and what tables there are. A grid
    table begins with a border, goes on with borders and rows, and has two borders or more."""
    pipe = _pipe_rows(lines).withColumn("n", F.when(~F.col("row").rlike(SEPARATOR_ROW), F.size(F.split("row", r"\|", -1)) - 2))
    pipe = pipe.groupBy("doc_id", "table_no").agg(_listing(F.col("n")).alias("widths"), F.count_distinct("n").alias("kinds"), F.count(F.lit(1)).alias("n_rows")).withColumn("kind", F.lit("Pipe"))
    g = lines.select("doc_id", "line_no", _stripped("line").alias("row")).withColumn("border", F.col("row").rlike(GRID_BORDER)).filter(F.col("border") | F.col("row").startswith("|"))
    g = g.withColumn("run", F.col("line_no") - F.row_number().over(_in_order()))
    in_run = Window.partitionBy("doc_id", "run")
    g = g.withColumn("first", F.min(F.when(F.col("border"), F.col("line_no"))).over(in_run)).filter("line_no >= first")
    n = F.when(F.col("border"), F.length("row") - F.length(F.replace("row", F.lit("+"), F.lit(""))) - 1)
    g = g.withColumn("n", n).groupBy("doc_id", "run").agg(F.min("line_no").alias("start"), _listing(F.col("n")).alias("widths"), F.count_distinct("n").alias("kinds"), F.count(F.lit(1)).alias("n_rows"), F.count_if("border").alias("borders")).filter("borders >= 2")
    grid = g.withColumn("table_no", F.row_number().over(Window.partitionBy("doc_id").orderBy("start"))).select("doc_id", "table_no", "widths", "kinds", "n_rows", F.lit("Grid").alias("kind"))
    both = pipe.unionByName(grid)
    fails = both.filter("kinds > 1").select(*_issue("tables", "FAIL", F.format_string("%s table %d has inconsistent column counts: %s. Rows: %d", "kind", "table_no", "widths", "n_rows")))
    count = both.groupBy("doc_id").agg(F.count_if(F.col("kind") == "Pipe").alias("p"), F.count_if(F.col("kind") == "Grid").alias("g"))
    told = F.concat_ws(", ", F.when(F.col("p") > 0, F.format_string("%d pipe", "p")), F.when(F.col("g") > 0, F.format_string("%d grid", "g")))
    count = lines.select("doc_id").distinct().join(count, "doc_id", "left")
    text = F.when(F.col("p").isNull(), "No markdown tables found").otherwise(F.concat(F.lit("Found "), (F.col("p") + F.col("g")).cast("string"), F.lit(" table(s) ("), told, F.lit(")")))
    return fails.unionByName(count.select(*_issue("tables", "INFO", text)))
