"""Queries of the engine's operators, each with SQL that another engine can run on the same tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkstrata.functions import text as X
from inkstrata.operators import assemble as A
from inkstrata.operators import classify as C
from inkstrata.operators import noise as N
from inkstrata.operators import quality as Q
from inkstrata.operators import structure as S
from inkstrata.operators import validate as V
from inkstrata.plans.fixtures import Fixture, typed, wide
from inkstrata.sources import tables as T
from inkstrata.streaming import events as E

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None, cols: str | None = None):
    """Registers a plan (spark, sf_dir) -> DataFrame under its name, with its SQL; cols types the SQL's columns."""

    def put(f):
        QUERIES[f.__name__] = lambda spark, sf_dir: wide(f(spark, sf_dir))
        if sql is not None:
            ORACLE_SQL[f.__name__] = typed(sql, cols) if cols else sql
        return f

    return put


def _quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _md_sql() -> str:
    out = "html"
    for p, r in T.HTML_RULES:
        out = f"regexp_replace({out}, {_quoted(p)}, {_quoted(r)}, 'g')"
    return f"select page_id doc_id, {out} md from pages"


_LINES = f"md as ({_md_sql()}), l as (select doc_id, unnest(range(1, len(string_split(md, chr(10))) + 1)) line_no, unnest(string_split(md, chr(10))) line from md)"
_WORDS = "len(list_filter(regexp_split_to_array({0}, '\\s+'), lambda w: w <> ''))"
_SECTIONS = _LINES + r""", m as (select *, length(regexp_extract(line, '^(#{1,6})\s', 1)) lv from l),
n as (select *, sum(case when lv > 0 then 1 else 0 end) over (partition by doc_id order by line_no) section from m),
s as (select doc_id, section, max(case when lv > 0 then regexp_replace(line, '^#{1,6}\s+', '') end) heading, max(lv) "level", min(line_no) line_start, max(line_no) line_end, sum(""" + _WORDS.format("line") + r""") word_count, sum(len(regexp_extract_all(line, '!\[[^\]]*\]\('))) n_images from n where section > 0 group by doc_id, section)"""


# ---- structure -----------------------------------------------------------------------------------


@query(f"with {_SECTIONS} select * from s", 'doc_id bigint, section bigint, heading varchar, "level" bigint, line_start bigint, line_end bigint, word_count bigint, n_images bigint')
def sections_from_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.sections(T.lines(T.page_markdown(spark, sf_dir)))


DOCS = Fixture(
    "doc_id long, pages long, md string",
    (
        (1, 3, "---\nsource_file: a.pdf\nconversion_date: x\nconversion_tool: t\nfidelity_standard: f\ndocument_type: d\n---\n# A long title\ntext **bold** here\n### Deep one\n| a | b |\n|---|---|\n| 1.5 | 2 |\n| 0.85 (0.12) | 10-20 |\nsee Table 1 and Table 2\n## Part two\n[x](y.png)\n## Part three\n"),
        (2, 9, "# Alpha beta\n\n**odd\n## Two [link]( )\n| a | b | c |\n| 1 | 2 |\ntail\n| z |\n"),
        (3, 40, "no heading at all\nTable 3 is missing\n"),
        (4, 1, "---\nsource_file: b\n---\n# Ministry of Health\n# The real title\n#### Jump\nAbstract\nword word\n"),
        (5, 2, ""),
        (6, 2, None),
    ),
)
_FL = f"f as {DOCS.sql()}, l as (select doc_id, unnest(range(1, len(string_split(md, chr(10))) + 1)) line_no, unnest(string_split(md, chr(10))) line from f where md is not null)"


@query(f"with {_FL}, h as (select *, length(regexp_extract(line, '^(#{{1,6}})\\s', 1)) lv from l), j as (select doc_id, line_no, lv, lag(lv) over (partition by doc_id order by line_no) b from h where lv > 0) select doc_id, line_no, b from_level, lv to_level from j where lv > b + 1", "doc_id bigint, line_no bigint, from_level bigint, to_level bigint")
def heading_level_jumps(spark, sf_dir):
    return S.heading_jumps(T.lines(DOCS.spark(spark)))


@query(f"with {_FL}, t as (select doc_id, line_no, trim(line[3:]) t from l where line_no <= 80 and line like '# %') select doc_id, arg_min(t, line_no) title from t where length(t) > 5 and not contains(lower(t), 'ministry of health') group by doc_id")
def title_first_h1(spark, sf_dir):
    return S.title(T.lines(DOCS.spark(spark)), ["ministry of health"])


_BLOCKS = _FL + r""", p as (select doc_id, line_no, len(string_split(line, '|')) - 2 c, line_no - row_number() over (partition by doc_id order by line_no) g from l where regexp_matches(line, '^\s*\|.*\|\s*$')),
b as (select doc_id, min(line_no) "start", max(line_no) "end", count(*) n_rows, min(c) min_cols, max(c) max_cols from p group by doc_id, g), tb as (select *, row_number() over (partition by doc_id order by "start") table_no from b)"""


@query(f"with {_BLOCKS} select * from tb", 'doc_id bigint, "start" bigint, "end" bigint, n_rows bigint, min_cols bigint, max_cols bigint, table_no bigint')
def table_blocks_islands(spark, sf_dir):
    return S.table_blocks(T.lines(DOCS.spark(spark)))


@query(f"with {_BLOCKS} select doc_id, 'tables' check_name, 'FAIL' severity, 'table ' || table_no || ' has rows of ' || min_cols || ' to ' || max_cols || ' cells' message from tb where min_cols <> max_cols")
def table_inconsistent_columns(spark, sf_dir):
    return Q.table_issues(S.table_blocks(T.lines(DOCS.spark(spark))))


@query(f"with {_FL}, r as (select doc_id, cast(regexp_extract(line, 'Table (\\d+)', 1) as bigint) table_ref, min(line_no) line_no from l where regexp_matches(line, 'Table \\d') group by 1, 2) select * from r where not exists (select 1 from l where l.doc_id = r.doc_id and l.line like '|%' and l.line_no between r.line_no + 1 and r.line_no + 49)", "doc_id bigint, table_ref bigint, line_no bigint")
def missing_table_after_mention(spark, sf_dir):
    return S.unexplained_tables(T.lines(DOCS.spark(spark)))


ROWS = Fixture("doc_id long, row string", ((1, "| 0.85 (0.12) | 10-20 | 2026-01-15 | 1920x1080 |"), (2, "| 1.5 0.3 2.1 | x |"), (3, "| a |")))


@query(rf"with f as {ROWS.sql()}, c as (select doc_id, unnest(list_slice(string_split(row, '|'), 2, -2)) x, unnest(range(1, len(string_split(row, '|')) - 1)) cell_no from f) select doc_id, cell_no, len(regexp_extract_all(regexp_replace(regexp_replace(x, '\d{{4}}-\d{{2}}-\d{{2}}', '7', 'g'), '\d+(\.\d+)?\s*[-x]\s*\d+(\.\d+)?', '7', 'g'), '\d+(\.\d+)?')) n from c", "doc_id bigint, cell_no bigint, n bigint")
def numeric_tokens_per_cell(spark, sf_dir):
    return S.numeric_tokens(ROWS.spark(spark))


CITES = Fixture("doc_id long, text string", ((1, "[1] [2] [4-6] [2017]"), (2, "[1,000]"), (3, "x [3, 5] y [9] [12-80]"), (4, None)))


@query(rf"with f as {CITES.sql()}, g as (select doc_id, unnest(regexp_extract_all(text, '\[(\d+(?:\s*[-,]\s*\d+)*)\]', 1)) g from f), p as (select doc_id, unnest(regexp_split_to_array(g, '\s*,\s*')) p from g), r as (select doc_id, cast(regexp_split_to_array(p, '\s*-\s*')[1] as bigint) lo, cast(regexp_split_to_array(p, '\s*-\s*')[-1] as bigint) hi from p), n as (select distinct doc_id, unnest(range(lo, hi + 1)) n from r where lo between 1 and 9999 and hi between lo and lo + 50), k as (select * from n where n not between 1900 and 2099), a as (select doc_id, min(n) first_ref, max(n) last_ref, list(n) s from k group by doc_id) select doc_id, first_ref, last_ref, array_to_string(list_sort(list_filter(range(first_ref, last_ref + 1), lambda x: not list_contains(s, x))), ',') missing from a", "doc_id bigint, first_ref bigint, last_ref bigint, missing varchar")
def reference_gaps(spark, sf_dir):
    return S.reference_gaps(CITES.spark(spark))


@query(f"with {_SECTIONS}, p as (select doc_id, unnest(range(1, 6)) page from (select distinct doc_id from s)), a as (select p.doc_id, page, cast(floor(page * last / 5.0) as bigint) est from p join (select doc_id, max(line_end) last from s group by doc_id) e on p.doc_id = e.doc_id) select a.doc_id, page, arg_max(heading, (case when est between line_start and line_end then 1 else 0 end, case when est between line_start and line_end then -line_start else line_end end)) filter (est between line_start and line_end or line_end <= est) heading from a join s on a.doc_id = s.doc_id group by a.doc_id, page", "doc_id bigint, page bigint, heading varchar")
def asof_section(spark, sf_dir):
    s = S.sections(T.lines(T.page_markdown(spark, sf_dir)))
    pages = s.select("doc_id").distinct().select("doc_id", F.explode(F.sequence(F.lit(1), F.lit(5))).alias("page"), F.lit(5).alias("total"))
    return S.section_of_page(s, pages)


@query("with h as (select user_id doc_id, event_id page, event_type heading from events where event_type in ('signup', 'purchase')), p as (select user_id doc_id, event_id page from events where event_type = 'error') select p.doc_id, p.page, h.heading from p asof left join h on p.doc_id = h.doc_id and p.page >= h.page")
def asof_heading(spark, sf_dir):
    e = T.load(spark, sf_dir, "events").select(F.col("user_id").alias("doc_id"), F.col("event_id").alias("page"), F.col("event_type").alias("heading"))
    return S.last_heading_before(e.filter(F.col("heading").isin("signup", "purchase")), e.filter("heading = 'error'").drop("heading"))


REFS = Fixture("doc_id long, md string", ((1, "text\n## References\n[1] Ann A.\n## Title one\n[2] Bob B.\n\nmore of two\n"), (2, "no refs here")))


@query(rf"with f as {REFS.sql()}, l as (select doc_id, unnest(range(1, len(string_split(md, chr(10))) + 1)) i, unnest(string_split(md, chr(10))) x from f), a as (select *, regexp_matches(x, '(?i)^(#{{1,6}} )?(references?|bibliography)\s*$') h from l), b as (select *, sum(h::int) over (partition by doc_id order by i) k from a), c as (select doc_id, i, regexp_replace(x, '^#{{1,6}} ', '') x from b where k > 0 and not h and trim(x) <> ''), d as (select *, sum(regexp_matches(x, '^(\[\d+\]|\d+\.)')::int) over (partition by doc_id order by i) entry_no from c) select doc_id, entry_no, string_agg(x, ' ' order by i) entry from d where entry_no > 0 group by 1, 2", "doc_id bigint, entry_no bigint, entry varchar")
def references_joined(spark, sf_dir):
    return S.joined_references(T.lines(REFS.spark(spark)))


@query("with t as (select l_orderkey doc_id, cast(l_linenumber as bigint) * 1000000000 + l_partkey * 1000 + cast(l_quantity as bigint) pos, case when l_quantity > 25 then l_shipmode else '' end body from (select *, l_returnflag l_shipmode from lineitem where l_linenumber < 5)), s as (select l_orderkey doc_id, cast(l_linenumber as bigint) * 1000000000 + l_partkey * 1000 + cast(l_quantity as bigint) pos, l_linestatus body from lineitem), f as (select doc_id, body f, row_number() over (partition by doc_id order by pos) k from t), g as (select doc_id, body s, row_number() over (partition by doc_id order by pos) k from s) select doc_id, k, case when f is null or f = '' then s else f end body, case when f is null then 'appended' when f = '' then 'replaced' else 'kept' end how from f full join g using (doc_id, k)")
def positional_table_repair(spark, sf_dir):
    li = T.load(spark, sf_dir, "lineitem")
    pos = F.col("l_linenumber").cast("long") * 1000000000 + F.col("l_partkey") * 1000 + F.col("l_quantity").cast("long")
    found = li.filter("l_linenumber < 5").select(F.col("l_orderkey").alias("doc_id"), pos.alias("pos"), F.when(F.col("l_quantity") > 25, F.col("l_returnflag")).otherwise("").alias("body"))
    return A.repair_tables(found, li.select(F.col("l_orderkey").alias("doc_id"), pos.alias("pos"), F.col("l_linestatus").alias("body")))


# ---- quality -------------------------------------------------------------------------------------

_SEC_ISSUES = r"""select doc_id, 'sections' check_name, 'FAIL' severity, 'no headings' message from c where n = 0 union all
select doc_id, 'sections', 'WARN', 'few headings' from c where n > 0 and n < 3 union all select doc_id, 'sections', 'WARN', 'fewer headings than pages suggest' from c where n > 0 and n < pages // 3"""


@query(f"with md as ({_md_sql()}), c as (select doc_id, len(regexp_extract_all(md, '(?m)^#{{1,3}}\\s')) n, 9 pages from md), i as ({_SEC_ISSUES}) select c.doc_id, count(i.doc_id) n_issues, case when max((severity = 'FAIL')::int) = 1 then 1 when count(i.doc_id) > 0 then 2 else 0 end exit_code from c left join i on c.doc_id = i.doc_id group by c.doc_id", "doc_id bigint, n_issues bigint, exit_code bigint")
def section_counts_gate(spark, sf_dir):
    docs = T.page_markdown(spark, sf_dir).withColumn("pages", F.lit(9))
    return Q.gate(docs, Q.section_issues(docs))


@query(rf"with f as {DOCS.sql()}, h as (select doc_id, regexp_matches(md, '(?s)^---\n.*?\n---') has, regexp_extract(md, '(?s)^---\n(.*?)\n---', 1) head from f), k as (select unnest([{', '.join(map(_quoted, Q.HEADER_KEYS))}]) k) select doc_id, 'header' check_name, 'FAIL' severity, 'no header block' message from h where not has union all select doc_id, 'header', 'FAIL', 'missing ' || k from h, k where has and not contains(head, k)")
def header_fields(spark, sf_dir):
    return Q.header_issues(DOCS.spark(spark))


@query(rf"with f as {DOCS.sql()}, n as (select doc_id, len(regexp_extract_all(md, '\*\*')) b, len(regexp_extract_all(md, '\]\(\s*\)')) k from f) select doc_id, 'syntax' check_name, 'WARN' severity, 'odd bold marks: ' || b message from n where b % 2 = 1 union all select doc_id, 'syntax', 'WARN', 'links without target: ' || k from n where k > 0")
def markdown_parity(spark, sf_dir):
    return Q.syntax_issues(DOCS.spark(spark))


CELLS = Fixture("doc_id long, table_no long, row_no long, cell string, n_numbers long", tuple((1, 1, r, c, n) for r, cs in enumerate([[("h", 0), ("i", 0), ("j", 0)], [("1.5 0.3 2.1", 3), ("x", 0), ("", 0)], [("1 2 3", 3), ("4", 1), ("5", 1)]]) for c, n in cs) + tuple((1, 2, r, f"v {r}", 1) for r in range(4)) + tuple((2, 1, r, c, 0) for r, cs in enumerate([["a", ""], ["", ""]]) for c in cs) + ((3, 1, 0, "p", 0), (3, 1, 0, "q", 0), (3, 1, 1, "1", 1), (3, 1, 1, "2", 1)))


@query(f"with f as {CELLS.sql()}, r as (select doc_id, table_no, row_no, count(*) c, count(*) filter (trim(cell) <> '') filled, sum(n_numbers) s, max(n_numbers) m from f group by 1, 2, 3), t as (select doc_id, table_no, count(*) n, max(c) cols, sum(s) s, sum(filled) / sum(c) sh, count(*) filter (row_no > 0 and filled > 0) body, count(*) filter (row_no > 0 and m > 2) crowd from r group by 1, 2) select * from (select doc_id, table_no, case when cols = 1 and body >= 3 then 'single_column' when s = 0 and n <= 4 and sh < 0.6 then 'sparse' when body > 0 and crowd > 0.5 * body then 'crowded_cells' end reason from t) where reason is not null")
def table_collapse(spark, sf_dir):
    return Q.collapsed_tables(CELLS.spark(spark))


BAD = Fixture("doc_id long, line_no long, line string", tuple((1, i, "a\x0cb" if i % 2 else "fine") for i in range(1, 26)) + ((2, 1, "x\ufffd"), (3, 1, "tab\tok")))


@query(rf"with f as {BAD.sql()}, b as (select *, row_number() over (partition by doc_id order by line_no) k from f where regexp_matches(line, '[\x00-\x08\x0B\x0C\x0E-\x1F\x{{FFFD}}]')) select doc_id, 'encoding' check_name, 'WARN' severity, count(*) || ' lines: ' || string_agg(case when k <= 10 then line_no end, ',' order by line_no) message from b group by doc_id")
def encoding_lines(spark, sf_dir):
    return Q.encoding_issues(BAD.spark(spark))


@query("select coalesce(o, c) k, case when c is null then 'left' else 'right' end side from (select distinct o_custkey o from orders where o_orderpriority like '1%') full join (select c_custkey c from customer where c_acctbal > 0) on o = c where o is null or c is null", "k bigint, side varchar")
def manifest_index_full_outer(spark, sf_dir):
    o = T.load(spark, sf_dir, "orders").filter(F.startswith("o_orderpriority", F.lit("1"))).select(F.col("o_custkey").alias("k"))
    return Q.set_differences(o, T.load(spark, sf_dir, "customer").filter("c_acctbal > 0").select(F.col("c_custkey").alias("k")), ["k"])


@query("select doc_id from documents d where not exists (select 1 from labels l where l.doc_id = d.doc_id and l.toxic = 0)")
def coverage_anti(spark, sf_dir):
    return T.load(spark, sf_dir, "documents").select("doc_id").join(T.load(spark, sf_dir, "labels").filter("toxic = 0"), "doc_id", "left_anti")


@query("select distinct l_partkey from lineitem where not exists (select 1 from part where p_partkey = l_partkey and p_size < 25)")
def missing_files_anti(spark, sf_dir):
    return T.load(spark, sf_dir, "lineitem").select("l_partkey").join(T.load(spark, sf_dir, "part").filter("p_size < 25"), F.expr("l_partkey = p_partkey"), "left_anti").distinct()


@query("select event_id, message from (select event_id, event_type || ' ' || props message from events where event_type <> 'view') f where not exists (select 1 from events e where e.event_type = 'error' and left(f.message, 50) = left('error ' || e.props, 50))")
def issue_append_new_only(spark, sf_dir):
    e = T.load(spark, sf_dir, "events").select("event_id", "event_type", F.concat_ws(" ", "event_type", "props").alias("message"))
    return Q.new_issues(e.filter("event_type <> 'view'").select("event_id", "message"), e.filter("event_type = 'error'"))


# ---- classification ------------------------------------------------------------------------------


def _domain_sql(text: str) -> str:
    low = f"lower({text})"
    hits = lambda ws: " + ".join(f"contains({low}, {_quoted(w.lower())})::int" for w in ws)
    over = " ".join(f"when {hits(ws)} > 0 then '{n}'" for n, ws in C.OVERRIDES.items())
    best = f"greatest({', '.join(hits(ws) for ws in C.DOMAINS.values())})"
    return f"case {over} when {best} = 0 then 'general' " + " ".join(f"when {hits(ws)} = {best} then '{n}'" for n, ws in C.DOMAINS.items()) + " end"


@query(f"select doc_id, {_domain_sql('text')} as domain from documents")
def domain_argmax(spark, sf_dir):
    return T.load(spark, sf_dir, "documents").select("doc_id", C.domain(F.col("text")).alias("domain"))


_TERMS = ["the", "ing", "tion", "est", "und", "que", "ment", "cost"]


@query("with t as (select doc_id, ord, term, (length(lower(text)) - length(replace(lower(text), term, ''))) // length(term) n from documents, (values " + ", ".join(f"({i}, '{t}')" for i, t in enumerate(_TERMS)) + ") v(ord, term)), r as (select *, row_number() over (partition by doc_id order by n desc, ord) rank from t where n > 0) select doc_id, rank, term, n from r where rank <= 5", "doc_id bigint, rank bigint, term varchar, n bigint")
def key_terms_top5(spark, sf_dir):
    return C.key_terms(T.load(spark, sf_dir, "documents"), _TERMS)


CONTEXTS = Fixture("doc_id long, context string, path string", ((1, "costing model", "a/current/x.pdf"), (2, "utility and eq-5d", "b/paper.pdf"), (3, "nothing", "wg/2025.pptx"), (4, "discounting; country", "z"), (5, "", "workgroup notes"), (6, "a model of cost", "slides 2026")))


def _topic_sql() -> str:
    s = {n: " + ".join(f"case when regexp_matches(lower(context), '\\b{w}\\b') then 2 when contains(lower(context), '{w}') then 1 else 0 end" for w in ws) for n, ws in C.TOPICS.items()}
    best = f"greatest({', '.join(s.values())})"
    return f"case when {best} = 0 then 'Uncategorised' " + " ".join(f"when {v} = {best} then {_quoted(n)}" for n, v in s.items()) + " end"


_CATEGORY_SQL = "case " + " ".join(f"when {' or '.join(f'contains(lower(path), {_quoted(w)})' for w in ws)} then {_quoted(n)}" for n, ws in C.SOURCES.items()) + " else 'LITERATURE' end"


@query(f"select doc_id, {_topic_sql()} topic, {_CATEGORY_SQL} category from {CONTEXTS.sql()}")
def topic_weighted(spark, sf_dir):
    return CONTEXTS.spark(spark).select("doc_id", C.topic(F.col("context")).alias("topic"), C.source_category(F.col("path")).alias("category"))


@query(f"with c as (select *, {_topic_sql()} topic, {_CATEGORY_SQL} category from {CONTEXTS.sql()}) select row_number() over (order by topic = 'Uncategorised', topic, case category when 'CURRENT SLIDES' then 0 when 'PREVIOUS SLIDES' then 1 when 'LITERATURE' then 2 else 3 end, doc_id) place, doc_id, topic, category from c", "place bigint, doc_id bigint, topic varchar, category varchar")
def testable_index_ordering(spark, sf_dir):
    from pyspark.sql.window import Window

    prio = F.array_position(F.array(*map(F.lit, C.SOURCES)), F.col("category"))
    c = CONTEXTS.spark(spark).select("doc_id", C.topic(F.col("context")).alias("topic"), C.source_category(F.col("path")).alias("category"))
    return c.select(F.row_number().over(Window.orderBy(F.col("topic") == "Uncategorised", "topic", prio, "doc_id")).alias("place"), "doc_id", "topic", "category")


MESSAGES = Fixture("id long, message string", ((1, "manifest file not found"), (2, "Extraction of p. 3 FAILED"), (3, "empty image, no manifest"), (4, "all fine"), (5, "image of 2000px"), (6, None)))


@query(f"select id, case {' '.join(f'when regexp_matches(message, {_quoted(chr(40) + chr(63) + chr(105) + chr(41) + p)}) then {_quoted(n)}' for n, _, p in C.FAILURES)} end failure, case {' '.join(f'when regexp_matches(message, {_quoted(chr(40) + chr(63) + chr(105) + chr(41) + p)}) then {_quoted(s)}' for _, s, p in C.FAILURES)} end severity from {MESSAGES.sql()}")
def known_failure_first_match(spark, sf_dir):
    f = C.known_failure(F.col("message"))
    return MESSAGES.spark(spark).select("id", f["name"].alias("failure"), f["severity"].alias("severity"))


_IMAGES = "select l_orderkey doc_id, l_linenumber image_id, l_linenumber page, l_suppkey % 4 xref, cast(l_quantity as bigint) * (l_partkey % 23) width, cast(l_quantity as bigint) * (l_suppkey % 11) height, (l_partkey * 37) % 120000 size_bytes, l_partkey % 12 on_page, 7 total_pages, case when l_partkey % 5 = 0 then 'vector-render' else 'xref' end source, l_partkey % 40 words, case when l_partkey % 3 = 0 then 'a figure of something quite long' when l_partkey % 3 = 1 then 'plot' else 'x' end context from lineitem"
_BRANDING = "(width > 0 and height > 0 and ((width < 100 and height < 100) or ((width * 1.0 / nullif(height, 0) > 10 or width * 1.0 / nullif(height, 0) < 0.1) and size_bytes < 5000) or (size_bytes > 0 and size_bytes < 5000 and case when page = 1 then width < 400 or height < 400 else width < 200 and height < 200 end) or (page = 1 and on_page > 3 and size_bytes > 0 and size_bytes < 50000 and width < 500 and height < 500) or (page = 1 and on_page > 8 and size_bytes > 0 and size_bytes < 100000) or (page = 1 and width < 300 and height < 300 and size_bytes > 0 and size_bytes < 50000)))"
_CLASSED = f"i as ({_IMAGES}), j as (select *, count(xref) over (partition by doc_id, xref) times from i), c as (select doc_id, image_id, page, case when height > 0 and height < 50 and width >= 50 then 'narrow_fragment (h=' || height || 'px)' when width > 0 and width < 50 and height >= 50 then 'narrow_fragment (w=' || width || 'px)' when width < 50 and height < 50 and width > 0 and height > 0 then 'tiny_dimensions' when {_BRANDING} then 'journal_branding' when times > total_pages * 0.5 then 'repeated_watermark' when source = 'vector-render' and words < 20 then 'low_word_count_render' when width > 200 and height > 200 and length(context) > 20 then 'large_with_context' when {' or '.join(f'contains(context, {_quoted(w)})' for w in C.FIGURE_WORDS)} then 'figure_keyword' else 'conservative_default' end reason from j)"


def _images(spark, sf_dir) -> DataFrame:
    q, p, s, n = F.col("l_quantity").cast("long"), F.col("l_partkey"), F.col("l_suppkey"), F.col("l_linenumber")
    context = F.when(p % 3 == 0, "a figure of something quite long").when(p % 3 == 1, "plot").otherwise("x")
    li = T.load(spark, sf_dir, "lineitem")
    return C.image_class(
        li.select(F.col("l_orderkey").alias("doc_id"), n.alias("image_id"), n.alias("page"), (s % 4).alias("xref"), (q * (p % 23)).alias("width"), (q * (s % 11)).alias("height"), (p * 37 % 120000).alias("size_bytes"), (p % 12).alias("on_page"), F.lit(7).alias("total_pages"), F.when(p % 5 == 0, "vector-render").otherwise("xref").alias("source"), (p % 40).alias("words"), context.alias("context"))
    )


@query(f"with {_CLASSED} select reason, count(*) n, count(distinct doc_id) n_docs from c group by reason", "reason varchar, n bigint, n_docs bigint")
def image_rule_chain(spark, sf_dir):
    return _images(spark, sf_dir).groupBy("reason").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("doc_id").alias("n_docs"))


_KEPT = "reason in ('large_with_context', 'figure_keyword', 'conservative_default')"


@query(f"with {_CLASSED} select doc_id, page, bool_or({_KEPT}) substantive, count(*) n_images, count(*) filter ({_KEPT}) n_substantive from c group by doc_id, page", "doc_id bigint, page bigint, substantive boolean, n_images bigint, n_substantive bigint")
def page_any_substantive(spark, sf_dir):
    return A.page_verdicts(_images(spark, sf_dir))


@query(f"with {_CLASSED} select count(distinct doc_id) n_docs, count(distinct (doc_id, page)) n_pages, count(*) n_images, count(*) filter ({_KEPT}) n_substantive, count(*) filter (not {_KEPT}) n_decorative from c", "n_docs bigint, n_pages bigint, n_images bigint, n_substantive bigint, n_decorative bigint")
def image_index_totals(spark, sf_dir):
    i = _images(spark, sf_dir)
    return i.agg(F.count_distinct("doc_id").alias("n_docs"), F.count_distinct("doc_id", "page").alias("n_pages"), F.count(F.lit(1)).alias("n_images"), F.count_if("is_substantive").alias("n_substantive"), F.count_if(~F.col("is_substantive")).alias("n_decorative"))


SHAPES = Fixture("id long, w long, h long, page long, total long, context string, filename string, chart boolean, repeated boolean", ((1, 8000, 4500, 2, 9, "three words here", "a.png", False, False), (2, 8000, 4500, 2, 9, "a b c d e f g h i j k l m n o", "a", False, False), (3, 40, 40, 3, 9, "", "x", False, False), (4, 40, 40, 3, 9, "", "x", True, False), (5, 300, 300, 1, 9, "", "Cover.png", False, False), (6, 300, 300, 9, 9, "Thank you", "x", False, False), (7, 300, 300, 4, 9, "", "x", False, True), (8, 300, 300, 4, 9, "", "x", False, False)))


@query(f"select id, not chart and ((w > 0 and h > 0 and w < 50 and h < 50) or (w >= 7000 and h >= 4000 and {_WORDS.format('context')} < 15) or repeated or (page = 1 and regexp_matches(lower(filename), 'title|cover')) or (page = total and regexp_matches(lower(context), 'thank|question'))) decorative from {SHAPES.sql()}")
def office_decorative(spark, sf_dir):
    c = [F.col(x) for x in ("w", "h", "page", "total", "context", "filename", "chart", "repeated")]
    return SHAPES.spark(spark).select("id", C.is_decorative(*c).alias("decorative"))


_KINDS = list(C.PERSONAS)


def _personas_sql() -> str:
    out = "case kind "
    for n, (always, cond) in C.PERSONAS.items():
        parts = [f"[{', '.join(map(_quoted, always))}]::varchar[]"] + [f"case when {' or '.join(f'contains(lower(context), {_quoted(k.lower())})' for k in ks)} then [{_quoted(w)}] else []::varchar[] end" for w, ks in cond.items()]
        out += f"when {_quoted(n)} then list_sort(list_distinct({' || '.join(parts)})) "
    return out + "end"


_PERSONA_ROWS = f"p as (select doc_id, ([{', '.join(map(_quoted, _KINDS))}])[1 + doc_id % {len(_KINDS)}] kind, text || case when doc_id % 2 = 0 then ' trial cost model HTA' else '' end context from documents)"


def _persona_docs(spark, sf_dir) -> DataFrame:
    d = T.load(spark, sf_dir, "documents")
    kind = F.get(F.array(*map(F.lit, _KINDS)), (F.col("doc_id") % len(_KINDS)).cast("int"))
    d = d.select("doc_id", kind.alias("kind"), F.concat("text", F.when(F.col("doc_id") % 2 == 0, " trial cost model HTA").otherwise("")).alias("context"))
    return d.select("doc_id", "kind", C.personas(F.col("kind"), F.col("context")).alias("personas"))


@query(f"with {_PERSONA_ROWS} select doc_id, kind, array_to_string({_personas_sql()}, ',') personas from p")
def persona_activation(spark, sf_dir):
    return _persona_docs(spark, sf_dir).select("doc_id", "kind", F.array_join("personas", ",").alias("personas"))


@query(f"with {_PERSONA_ROWS}, e as (select unnest({_personas_sql()}) persona from p) select persona, count(*) n from e group by persona", "persona varchar, n bigint")
def persona_frequency(spark, sf_dir):
    return _persona_docs(spark, sf_dir).select(F.explode("personas").alias("persona")).groupBy("persona").agg(F.count(F.lit(1)).alias("n"))


@query("with c as (select s_nationkey table_id, row_number() over (partition by s_nationkey order by s_suppkey) - 1 row_no, s_name c0, cast(s_suppkey as varchar) c1 from supplier), u as (select table_id, row_no, 0 col_no, c0 cell from c union all select table_id, row_no, 1, c1 from c), s as (select table_id, col_no, sqrt(greatest(avg(length(cell)), max(case when row_no = 0 then length(cell) end), 3.0)) r from u group by 1, 2), w as (select table_id, col_no, greatest(r / sum(r) over (partition by table_id) * 16.0, 1.5) w from s) select table_id, col_no, round(w / sum(w) over (partition by table_id) * 16.0, 6) width_cm from w", "table_id bigint, col_no bigint, width_cm double")
def column_widths_sqrt(spark, sf_dir):
    from pyspark.sql.window import Window

    s = T.load(spark, sf_dir, "supplier").withColumn("row_no", F.row_number().over(Window.partitionBy("s_nationkey").orderBy("s_suppkey")) - 1)
    return C.column_widths(s.select(F.col("s_nationkey").alias("table_id"), "row_no", F.posexplode(F.array("s_name", F.col("s_suppkey").cast("string"))).alias("col_no", "cell")))


# ---- routing and validation ----------------------------------------------------------------------

CAPS = Fixture("extractor string, available boolean", (("tesseract", False), ("mineru", True), ("zerox", True), ("marker", False), ("docling", True), ("pymupdf4llm", True), ("markitdown", True)))
_PAGES = "pg as (select doc_id, unnest(range(0, len(string_split(text, chr(10))))) page, unnest(string_split(text, chr(10))) text, len(string_split(text, chr(10))) total from documents)"


def _doc_pages(spark, sf_dir) -> DataFrame:
    lines = F.split("text", "\n")
    return T.load(spark, sf_dir, "documents").select("doc_id", F.size(lines).alias("total"), F.posexplode(lines).alias("page", "text"))


@query(f"with {_PAGES} select doc_id, avg(length(text)) avg_chars, count(*) n_sampled from pg where page % greatest(1, total // 10) = 0 group by doc_id", "doc_id bigint, avg_chars double, n_sampled bigint")
def sampled_density(spark, sf_dir):
    return V.density(_doc_pages(spark, sf_dir))


@query(f"with {_PAGES}, d as (select doc_id, avg(length(text)) a from pg where page % greatest(1, total // 10) = 0 group by doc_id) select doc_id, a < 50 is_scanned, case when doc_id % 50 = 0 then 'zerox' when a < 50 then 'mineru' else 'docling' end extractor from d")
def router_choice(spark, sf_dir):
    d = V.density(_doc_pages(spark, sf_dir)).withColumn("pages", F.col("n_sampled")).withColumn("forced", F.when(F.col("doc_id") % 50 == 0, "zerox"))
    return V.route(d, CAPS.spark(spark))


CHAIN = Fixture("pos long, extractor string, available boolean", ((0, "marker", True), (1, "docling", False), (2, "pymupdf4llm", True), (3, "markitdown", True)))
CURRENT = Fixture("doc_id long, extractor string", ((1, "marker"), (2, "pymupdf4llm"), (3, "markitdown"), (4, None)))


@query(f"with c as {CHAIN.sql()}, d as {CURRENT.sql()}, a as (select d.doc_id, coalesce(c.pos, -1) cur from d left join c on d.extractor = c.extractor) select doc_id, arg_min(c.extractor, c.pos) next_extractor from a left join c on c.pos > cur and c.available group by doc_id")
def next_fallback(spark, sf_dir):
    return V.next_in_chain(CURRENT.spark(spark), CHAIN.spark(spark))


_WORDLIST = "list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> '')"


def _dropped(spark, sf_dir) -> DataFrame:
    """Documents' texts as the secondary, and without every 7th word as the primary."""
    w = X.words(F.col("text"))
    kept = F.array_join(F.filter(w, lambda x, i: i % 7 != 0), " ")
    return T.load(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("secondary"), kept.alias("primary"))


@query(f"with w as (select doc_id, {_WORDLIST} w from documents), d as (select doc_id, list_distinct(w) s, list_distinct(list_filter(w, lambda x, i: (i - 1) % 7 <> 0)) p from w), g as (select doc_id, len(s) n, list_sort(list_filter(s, lambda x: not list_contains(p, x))) gone from d) select doc_id, round(1 - len(gone) / n, 4) completeness, array_to_string(gone[1:10], ' ') missing_sample from g where n > 0 and len(gone) / n > 0.05", "doc_id bigint, completeness double, missing_sample varchar")
def missing_words_ratio(spark, sf_dir):
    return V.missing_words(_dropped(spark, sf_dir))


@query(f"with p as (select doc_id, length(text) n, {_WORDS.format('text')} r, {_WORDS.format('left(text, 500)')} o from documents) select doc_id, case when r = 0 then 'no_reference' when o / r < 0.1 then 'fallback' when o / r < 0.3 then 'warn' when o / r < 0.6 then 'info' else 'ok' end verdict from p")
def word_ratio_gate(spark, sf_dir):
    return V.word_ratio(T.load(spark, sf_dir, "documents").select("doc_id", F.left("text", F.lit(500)).alias("out_text"), F.col("text").alias("ref_text")))


@query("select l_orderkey doc_id, count(*) n_pages, avg((l_discount > 0.05)::int) rate from lineitem group by 1 having count(*) >= 5 and avg((l_discount > 0.05)::int) >= 0.4", "doc_id bigint, n_pages bigint, rate double")
def flag_rate_trigger(spark, sf_dir):
    return V.flag_rate(T.load(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("doc_id"), (F.col("l_discount") > 0.05).alias("flagged")), pages=5)


@query("select distinct l_orderkey doc_id, l_linenumber page from lineitem a where l_quantity >= 10 and l_partkey % 90 >= 50 and not exists (select 1 from lineitem b where b.l_orderkey = a.l_orderkey and b.l_linenumber = a.l_linenumber and b.l_returnflag = 'R')", "doc_id bigint, page bigint")
def gap_pages_anti(spark, sf_dir):
    li = T.load(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("doc_id"), F.col("l_linenumber").alias("page"), (F.col("l_quantity") * 5).alias("width"), (F.col("l_partkey") % 90).alias("height"), "l_returnflag")
    return V.gap_pages(li, li.filter("l_returnflag = 'R'"))


@query(rf"select doc_id, case when md is null then 'missing' when length(md) = 0 then 'empty' when not regexp_matches(md, '\S') then 'blank' else 'ok' end verdict, coalesce(starts_with(md, '---'), false) has_header from {DOCS.sql()}")
def output_verdict(spark, sf_dir):
    return V.output_verdict(DOCS.spark(spark))


SLIDES = Fixture("doc_id long, width double, height double, n_words long", tuple((1, 960.0, 540.0, 20 + i) for i in range(5)) + tuple((2, 595.0, 842.0, 400) for _ in range(5)) + ((3, 960.0, 540.0, 5),) + tuple((4, 595.0, 842.0, 10) for _ in range(4)))


@query(f"with g as (select doc_id, count(*) n, avg((width > height)::int) wide, count(distinct (round(width / 10), round(height / 10))) sizes, avg((n_words < 80)::int) brief, avg(((width / height > 1.2 and width / height < 1.5) or (width / height > 1.6 and width / height < 2.0))::int) screen from {SLIDES.sql()} group by doc_id) select doc_id, n >= 3 and (wide >= 0.8)::int + (sizes <= 2 and (wide >= 0.8 or screen >= 0.8))::int + (brief >= 0.6)::int + (screen >= 0.8)::int >= 2 is_slides from g")
def slide_signals(spark, sf_dir):
    return V.is_slides(SLIDES.spark(spark))


@query("select doc_id from documents d where exists (select 1 from documents r where r.doc_id % 3 = 0 and sha256(r.text) = sha256(d.text))")
def already_converted_semi(spark, sf_dir):
    d = T.load(spark, sf_dir, "documents").select("doc_id", X.content_key(F.col("text")).alias("sha"))
    return d.join(d.filter("doc_id % 3 = 0").select("sha").distinct(), "sha", "left_semi").select("doc_id")


# ---- assembly and registry -----------------------------------------------------------------------


@query("select doc_id, row_number() over w > 1 is_duplicate, case when row_number() over w > 1 then first_value(doc_id) over w end original from documents window w as (partition by sha256(text) order by doc_id)")
def sha256_dedup_keep_first(spark, sf_dir):
    d = T.load(spark, sf_dir, "documents").select(F.lit(0).alias("all"), "doc_id", X.content_key(F.col("text")).alias("sha"))
    got = A.flag_duplicates(d.select(F.col("all").alias("doc_id"), F.col("doc_id").alias("pos"), F.col("doc_id").alias("file"), "sha"))
    return got.select(F.col("pos").alias("doc_id"), "is_duplicate", "original")


@query("select l_orderkey doc_id, cast(l_suppkey % 5 as varchar) sha, count(*) times from lineitem group by 1, 2 having count(*) > 7 * 0.5", "doc_id bigint, sha varchar, times bigint")
def watermark_occurrence(spark, sf_dir):
    li = T.load(spark, sf_dir, "lineitem")
    return A.watermarks(li.select(F.col("l_orderkey").alias("doc_id"), F.col("l_linenumber").alias("page"), (F.col("l_suppkey") % 5).cast("string").alias("sha"), F.lit(7).alias("total_pages")))


@query("with b as (select user_id source_hash, event_type output_path, ts converted_at, event_id from events), k as (select *, row_number() over (partition by source_hash order by converted_at desc, (event_id % 2 = 1) desc, output_path desc) k from b) select source_hash, output_path, converted_at from k where k = 1")
def registry_keep_newest(spark, sf_dir):
    e = T.load(spark, sf_dir, "events").select(F.col("user_id").alias("source_hash"), F.col("event_type").alias("output_path"), F.col("ts").alias("converted_at"), "event_id")
    return A.upsert(e.filter("event_id % 2 = 0").drop("event_id"), e.filter("event_id % 2 = 1").drop("event_id"), ["source_hash"])


REQUESTS = Fixture("path string, sha string", (("in/a.pdf", "h1"), ("in/b.pdf", "h2"), ("in/c.docx", "h3"), ("in/d.pdf", None), ("in/e.pdf", "h5")))
REGISTRY = Fixture("source_hash string, output_path string", (("h1", "out/a.md"), ("h2", "gone/b.md"), ("h3", "out/c.txt"), ("h1", "out/a2.md")))
FILES = Fixture("file string", (("out/a.md",), ("in/b.md",), ("out/c.txt",), ("in/d.md",)))


@query(f"with q as {REQUESTS.sql()}, r as {REGISTRY.sql()}, f as {FILES.sql()}, g as (select path, bool_or(coalesce(o.file is not null and ends_with(output_path, '.md'), false)) reg, bool_or(b.file is not null) near from q left join r on q.sha = r.source_hash left join f o on o.file = r.output_path left join f b on b.file = regexp_replace(path, '\\.[^.]+$', '.md') group by path) select path, case when reg or near then 0 else 2 end exit_code, case when reg then 'registry' when near then 'co-located' else 'none' end via from g", "path varchar, exit_code bigint, via varchar")
def registry_gate_lookup(spark, sf_dir):
    return A.gate_lookup(REQUESTS.spark(spark), REGISTRY.spark(spark), FILES.spark(spark))


OVERRIDES = (("*.pdf", 5, "DECORATIVE"), ("deck-?.pdf", 5, "SUBSTANTIVE"), ("x*", 1, "DECORATIVE"))
AUTO = Fixture("file string, page long, auto string", (("deck-1.pdf", 5, "DECORATIVE"), ("other.pdf", 5, "SUBSTANTIVE"), ("x.docx", 1, "SUBSTANTIVE"), ("x.docx", 2, "SUBSTANTIVE")))
_OVERRIDES = Fixture("ord long, regex string, page long, classification string", tuple((i, A.glob_regex(p), n, c) for i, (p, n, c) in enumerate(OVERRIDES)))


@query(f"with p as {AUTO.sql()}, o as {_OVERRIDES.sql()}, g as (select file, p.page, auto, arg_max(classification, ord) c from p left join o on p.page = o.page and regexp_matches(file, regex) group by 1, 2, 3) select file, page, coalesce(c, auto) classification, c is not null and c <> auto changed from g")
def overrides_glob_join(spark, sf_dir):
    return A.apply_overrides(AUTO.spark(spark), _OVERRIDES.spark(spark))


HAVE = Fixture("doc_id long, filename string, figure_num string", ((1, "a.png", "1"), (1, "b.png", "3a"), (1, "c.png", "7"), (2, "z.png", "x")))
RENDERS = Fixture("doc_id long, filename string", ((1, "a.png"), (1, "r2.png"), (1, "r1.png"), (2, "y.png"), (3, "n.png")))


@query(f"with h as {HAVE.sql()}, r as {RENDERS.sql()}, t as (select doc_id, max(try_cast(figure_num as bigint)) t from h group by 1), n as (select r.*, row_number() over (partition by doc_id order by filename) k from r where not exists (select 1 from h where h.doc_id = r.doc_id and h.filename = r.filename)) select * from h union all select n.doc_id, filename, cast(coalesce(t, 0) + k as varchar) from n left join t on n.doc_id = t.doc_id")
def new_renders_anti(spark, sf_dir):
    return A.append_renders(HAVE.spark(spark), RENDERS.spark(spark))


_BOXES = "select vec_id id, label page, least(embedding[1], embedding[3]) x0, least(embedding[2], embedding[4]) y0, greatest(embedding[1], embedding[3]) x1, greatest(embedding[2], embedding[4]) y1 from embeddings"


@query(f"with b as (select id, page, x0::double x0, y0::double y0, x1::double x1, y1::double y1 from ({_BOXES})), p as (select a.page, a.id a_id, b.id b_id, greatest(0, least(a.x1, b.x1) - greatest(a.x0, b.x0)) * greatest(0, least(a.y1, b.y1) - greatest(a.y0, b.y0)) i, (a.x1 - a.x0) * (a.y1 - a.y0) + (b.x1 - b.x0) * (b.y1 - b.y0) u from b a join b on a.page = b.page where a.id % 2 = 0 and b.id % 2 = 1), q as (select *, i / (u - i) iou, row_number() over (partition by page, a_id order by i / (u - i) desc, b_id) k from p where i / (u - i) >= 0.05) select 0 doc_id, page, a_id, b_id, round(iou, 6) iou from q where k = 1", "doc_id bigint, page bigint, a_id bigint, b_id bigint, iou double")
def iou_best_candidate(spark, sf_dir):
    e = [F.get("embedding", F.lit(i)).cast("double") for i in range(4)]
    b = T.load(spark, sf_dir, "embeddings").select(F.lit(0).alias("doc_id"), F.col("label").alias("page"), F.col("vec_id").alias("id"), F.least(e[0], e[2]).alias("x0"), F.least(e[1], e[3]).alias("y0"), F.greatest(e[0], e[2]).alias("x1"), F.greatest(e[1], e[3]).alias("y1"))
    return A.best_overlap(b.filter("id % 2 = 0"), b.filter("id % 2 = 1"))


@query("select event_type, count(*) n, count(*) filter (json_extract_string(props, '$.k') is not null) n_keyed, count(distinct user_id) n_users, min(ts) first_ts from events group by event_type", "event_type varchar, n bigint, n_keyed bigint, n_users bigint, first_ts timestamp")
def health_check_counts(spark, sf_dir):
    e = T.load(spark, sf_dir, "events")
    return e.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.count(F.get_json_object("props", "$.k")).alias("n_keyed"), F.count_distinct("user_id").alias("n_users"), F.min("ts").alias("first_ts"))


@query("select time_bucket(interval '1 hour', ts) window_start, event_type, count(*) n from events group by 1, 2", "window_start timestamp, event_type varchar, n bigint")
def interception_windows(spark, sf_dir):
    return E.windowed_counts(T.load(spark, sf_dir, "events")).withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query("with n as (select conv_id, max(turn) m from conversations group by 1), s as (select conv_id, unnest(range(0, m + 1)) page from n) select s.conv_id doc_id, page, count(c.turn) n_images from s left join conversations c on c.conv_id = s.conv_id and c.turn = page and c.role = 'user' group by 1, 2", "doc_id bigint, page bigint, n_images bigint")
def dense_page_spine(spark, sf_dir):
    c = T.load(spark, sf_dir, "conversations")
    spine = c.groupBy(F.col("conv_id").alias("doc_id")).agg(F.max("turn").alias("m")).select("doc_id", F.explode(F.sequence(F.lit(0), F.col("m").cast("int"))).alias("page"))
    u = c.filter("role = 'user'").groupBy(F.col("conv_id").alias("doc_id"), F.col("turn").alias("page")).agg(F.count(F.lit(1)).alias("n"))
    return spine.join(u, ["doc_id", "page"], "left").select("doc_id", "page", F.coalesce("n", F.lit(0)).alias("n_images"))


# ---- text repair ---------------------------------------------------------------------------------

MESSY = Fixture("id long, t string", ((1, "METHODS\n 12 \nR [2] is\n`o` item\n>75 year\ncosteffectiveness Costutility\n\n\n\n\nend"), (2, "a/C15b /C3x/C77 GLYPH(9)"), (3, "Costeffectiveness COSTEFFECTIVENESS xcosteffective"), (4, "ofﬁce ﬂow"), (5, "a þ b ¼ c а"), (6, "# **Bold** head\nbody **x**\n42: Analyses\nAC 25 and \\~ 3。5"), (7, "camelCase 9lives"), (8, "  x  \n\n\n\ny\t\n ")))


@query(rf"select doc_id, regexp_replace(regexp_replace(regexp_replace(text, '[ \t]+(\n|$)', '\1', 'g'), '\n{{3,}}', chr(10) || chr(10), 'g'), '^\s+|\s+$', '', 'g') cleaned, trim(regexp_replace(text, '\s+', ' ', 'g')) comment from documents")
def whitespace_cleanup(spark, sf_dir):
    return T.load(spark, sf_dir, "documents").select("doc_id", X.clean_whitespace(F.col("text")).alias("cleaned"), X.sanitized_comment(F.col("text")).alias("comment"))


def _repair_sql(t: str) -> str:
    r = lambda x, p, s: f"regexp_replace({x}, {_quoted(p)}, {_quoted(s)}, 'g')"
    x = r(r(t, r"(?m)^## \d+ \d+\s*$", ""), r"(?m)^\s*\d{1,3}\s*$", "")
    for h in X.CAPITAL_HEADINGS:
        x = r(x, rf"(?m)^{h}\s*$", f"## {h.title()}")
    x = r(r(r(x, r"R\s*\[2\]", "R^2"), r"(?m)^\s*`o`\s+", "- "), r"(?m)^>(\d)", r"\\>\1")
    for c in X.COMPOUNDS:
        x = f"replace(replace({x}, '{c.replace('-', '')}', '{c}'), '{c.replace('-', '').title()}', '{c.title()}')"
    return r(x, r"\n{4,}", "\n\n\n")


@query(f"select id, {_repair_sql('t')} fixed from {MESSY.sql()}")
def extraction_repair(spark, sf_dir):
    return MESSY.spark(spark).select("id", X.repaired_extraction(F.col("t")).alias("fixed"))


def _fonts_sql(t: str) -> str:
    x = f"regexp_replace({t}, 'GLYPH\\([^)]*\\)', '', 'g')"
    for code, glyph in sorted(X.FONT_CODES.items(), key=lambda kv: (-len(kv[0]), kv[0])):
        x = f"replace({x}, '{code}', '{glyph}')"
    return f"regexp_replace({x}, '/C[0-9]{{1,3}}', '•', 'g')"


def _replaced_sql(t: str, table: dict) -> str:
    for a, b in table.items():
        t = f"replace({t}, '{a}', '{b}')"
    return t


@query(f"select id, {_fonts_sql('t')} fonts, {_replaced_sql('t', X.LIGATURES)} ligatures from {MESSY.sql()}")
def font_code_map(spark, sf_dir):
    t = F.col("t")
    return MESSY.spark(spark).select("id", X.decoded_fonts(t).alias("fonts"), X.expanded_ligatures(t).alias("ligatures"))


def _hyphen_sql(t: str) -> str:
    for c in X.COMPOUNDS:
        for form in (c, c[0].upper() + c[1:], c.upper()):
            t = f"regexp_replace({t}, '\\b{form.replace('-', '')}\\b', '{form}', 'g')"
    return t


@query(f"select id, {_hyphen_sql('t')} fixed from {MESSY.sql()}")
def domain_hyphens(spark, sf_dir):
    return MESSY.spark(spark).select("id", X.hyphenated(F.col("t")).alias("fixed"))


@query(rf"select id, array_to_string(list_transform(string_split(t, chr(10)), lambda l: case when regexp_matches(l, '^#{{1,6}}\s') then replace(l, '**', '') else l end), chr(10)) headings, regexp_replace(regexp_replace(regexp_replace(regexp_replace(t, '\bAC ?(\d)', '€\1', 'g'), '(?m)^(\d{{1,3}}): ([A-Z])', 'Table \1: \2', 'g'), '\\([~*])', '\1', 'g'), '([0-9])。([0-9])', '\1.\2', 'g') repaired, regexp_replace(regexp_replace(t, '([a-z])([A-Z])', '\1 \2', 'g'), '([0-9])([A-Za-z])', '\1 \2', 'g') split from {MESSY.sql()}")
def case_boundary_split(spark, sf_dir):
    t = F.col("t")
    return MESSY.spark(spark).select("id", X.plain_headings(t).alias("headings"), X.repaired_markdown(t).alias("repaired"), X.case_split(t).alias("split"))


CAPTIONS = Fixture("id long, caption string, n long", ((1, "Figure 2: survival curve", 1023), (2, "Table 1", 1024), (3, "Photo", 1048576), (4, "Fig. 3 Kaplan and scatter", 5000), (5, None, 0), (6, "Bad  Thing!", 99999999)))


@query(f"select id, case {' '.join(f'when contains(lower(caption), {_quoted(k)}) then {_quoted(v)}' for k, v in X.CAPTION_TYPES.items())} end kind, case when n < 1024 then n || ' bytes' when n < 1048576 then format('{{:.1f}}', n / 1024) || ' KB' else format('{{:.1f}}', n / 1048576) || ' MB' end size, regexp_replace(regexp_replace(lower(left(caption, 50)), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') slug from {CAPTIONS.sql()}")
def caption_type(spark, sf_dir):
    c = CAPTIONS.spark(spark)
    return c.select("id", X.caption_type(F.col("caption")).alias("kind"), X.size_label(F.col("n")).alias("size"), X.slug(F.col("caption")).alias("slug"))


@query("with c as (select doc_id, line_no, unnest(string_split(line, '')) ch, line from (select doc_id, unnest(range(1, len(string_split(text, chr(10))) + 1)) line_no, unnest(string_split(text, chr(10))) line from documents) where length(line) >= 20), g as (select doc_id, line_no, any_value(length(line)) len, ch, count(*) n from c group by doc_id, line_no, ch) select doc_id, line_no, round(-sum(n / cast(len as double) * log2(n / cast(len as double))), 6) entropy from g group by doc_id, line_no having -sum(n / cast(len as double) * log2(n / cast(len as double))) > 4.3", "doc_id bigint, line_no bigint, entropy double")
def line_entropy_filter(spark, sf_dir):
    d = T.lines(T.load(spark, sf_dir, "documents"), "text").filter(F.length("line") >= 20)
    return d.select("doc_id", "line_no", N.entropy(F.col("line")).alias("entropy")).filter("entropy > 4.3").withColumn("entropy", F.round("entropy", 6))


PATHS = Fixture("path string", (("a/B.PDF",), ("c.docx",), ("d.tar.gz",), ("noext",), ("s.xlsm",), ("t.txt",)))


@query(f"with f as (select path, lower(regexp_extract(path, '\\.([^./]+)$', 1)) fmt from {PATHS.sql()}) select path, fmt, case when fmt = 'pdf' then 'pdf' when fmt in ('docx', 'pptx') then 'office' when fmt = 'txt' then 'text' when fmt in ('xlsx', 'xlsm') then 'refused' else 'unknown' end route from f")
def format_dispatch(spark, sf_dir):
    p = PATHS.spark(spark).withColumn("fmt", T.source_format(F.col("path")))
    f = F.col("fmt")
    return p.select("path", "fmt", F.when(f == "pdf", "pdf").when(f.isin("docx", "pptx"), "office").when(f == "txt", "text").when(f.isin("xlsx", "xlsm"), "refused").otherwise("unknown").alias("route"))
