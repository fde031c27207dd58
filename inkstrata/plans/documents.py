"""Queries of line repairs, document metadata and image tables; importing this module registers them."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkstrata.functions import lines as L
from inkstrata.functions.text import LIGATURES, expanded_ligatures
from inkstrata.operators import images as I
from inkstrata.operators import metadata as M
from inkstrata.operators import structure as S
from inkstrata.plans.catalog import _SECTIONS, _TERMS, _domain_sql, _md_sql, _quoted, query
from inkstrata.plans.fixtures import Fixture
from inkstrata.sources import tables as T

# ---- text ----------------------------------------------------------------------------------------

GLYPHS = Fixture("doc_id long, text string", ((1, "CrI 20.26 to 20.10, 20.5 (CI:21.5)"), (2, "P \\ 0.05 and p - 0.01, n - 123"), (3, "aged .65 years; x 2 1 exp (y)"), (4, "e/unifb03cient /uni00e9t/uni00E9 /uniD800 /uniZZ"), (5, "a�b/uni00DF"), (6, ""), (7, None)))


def _signs_sql(t: str) -> str:
    for pattern, put in L.SIGNS:
        t = f"regexp_replace({t}, {_quoted(pattern)}, {_quoted(re.sub(r'[$](.)', lambda m: chr(92) + m[1], put))}, 'g')"
    return t


def _escapes_sql(t: str) -> str:
    digit = lambda k: f"(strpos('0123456789ABCDEF', upper(p[{k}])) - 1)"
    code = f"({digit(1)} * 4096 + {digit(2)} * 256 + {digit(3)} * 16 + {digit(4)})"
    one = f"case when i = 1 then p when not regexp_matches(p, '^[0-9A-Fa-f]{{4}}') or regexp_matches(p, '^[Dd][89A-Fa-f]') then '/uni' || p else chr({code}::int) || p[5:] end"
    out = f"array_to_string(list_transform(string_split({t}, '/uni'), lambda p, i: {one}), '')"
    for lig, plain in LIGATURES.items():
        out = f"replace({out}, '{lig}', '{plain}')"
    return f"replace({out}, chr(65533), '')"


@query(f"select doc_id, {_escapes_sql(_signs_sql('text'))} as text from {GLYPHS.sql()}")
def sign_and_escape_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return GLYPHS.spark(spark).select("doc_id", L.decoded_escapes(L.repaired_signs(F.col("text"))).alias("text"))


BLANKS = Fixture("doc_id long, text string", ((1, "a  b\n  - c   d  \n```\nx   y\n```\np   q\n| a   b |\n<!-- x   y -->"), (2, "```\nopen   fence"), (3, "   \n\tt \t u    "), (4, ""), (5, None)))


def _blanks_sql(source: str) -> str:
    rest = r"substring(line, length(regexp_extract(line, '^\s*')) + 1)"
    hard = f"{rest} like '%  '"
    body = rf"regexp_replace(case when {hard} then left({rest}, length({rest}) - 2) else {rest} end, '[ \t]{{2,}}', ' ', 'g')"
    return rf"""with s as ({source}), l as (select doc_id, unnest(range(1, len(string_split(text, chr(10))) + 1)) i, unnest(string_split(text, chr(10))) line from s), f as (select *, regexp_matches(line, '^[ \t]*```') fence from l),
g as (select *, sum(fence::int) over (partition by doc_id order by i) k from f), o as (select doc_id, i, case when fence or k % 2 = 1 or regexp_matches(line, '^\s*(\||<!--)') then line else regexp_extract(line, '^\s*') || {body} || case when {hard} then '  ' else '' end end line from g),
t as (select doc_id, string_agg(line, chr(10) order by i) t from o group by doc_id) select s.doc_id, t as text from s left join t on s.doc_id = t.doc_id"""


@query(_blanks_sql(f"select * from {BLANKS.sql()} union all select doc_id + 100, text from documents"))
def blanks_collapsed(spark, sf_dir):
    docs = T.load(spark, sf_dir, "documents").select((F.col("doc_id") + 100).alias("doc_id"), "text")
    return BLANKS.spark(spark).unionByName(docs).select("doc_id", L.single_spaced(F.col("text")).alias("text"))


HEADS = Fixture(
    "doc_id long, text string",
    (
        (1, "# Kept\n## ab\n\n\n## Methods\n\n\n## Figure 3 shows\n\n\n## 12.5 (3%)\n\n\n## p < 0.05 held\n\n\n## N = 12 here\n\n\n## (12 left)\n\n\n## a | b cells\n\n\n### The cost of care in wards\n\n\n## In Conclusion"),
        (2, "## A long heading here\n## Short one\n\n## Longer than that heading before"),
        (3, "\n\n\n".join(f"## Heading number {k} ends." for k in "abcdefghi")),
        (4, "## one two three four five six seven eight nine ten eleven twelve thirteen"),
        (5, ""),
        (6, None),
    ),
)
_HEADS_SQL = (
    rf"""with s as (select * from {HEADS.sql()}), l as (select doc_id, unnest(range(1, len(string_split(text, chr(10))) + 1)) i, unnest(string_split(text, chr(10))) line from s), h as (select *, regexp_matches(line, '{L.HEADING}') h, trim(regexp_extract(line, '{L.HEADING}', 2)) t from l),
c as (select doc_id, count(*) filter (h) n, greatest(count(*) filter (trim(line) <> '') / 50.0, 1) pages from h group by doc_id), p as (select *, lag(i) over (partition by doc_id order by i) pi, lag(t) over (partition by doc_id order by i) pt from h where h),
d as (select p.doc_id, i from p join c on p.doc_id = c.doc_id where length(t) < 3 or length(t) > 200 or len(string_split_regex(t, '\s+')) > 12 or contains(t, '|') or contains(t, chr(9)) or (n > 8 * pages and t like '%.') or """
    + " or ".join(f"regexp_matches(t, {_quoted(p)})" for p in L.NO_HEADING)
    + rf""" or (len(string_split_regex(t, '\s+')) >= 5 and regexp_matches(t, '^({"|".join(L.SENTENCE_STARTS)})')) or (i - pi <= 2 and length(t) < length(pt))),
o as (select h.doc_id, string_agg(case when d.i is null then line else regexp_extract(line, '{L.HEADING}', 2) end, chr(10) order by h.i) text from h left join d on h.doc_id = d.doc_id and h.i = d.i group by h.doc_id) select s.doc_id, o.text from s left join o on s.doc_id = o.doc_id"""
)


@query(_HEADS_SQL)
def headings_demoted(spark, sf_dir):
    return HEADS.spark(spark).select("doc_id", L.demoted_headings(F.col("text")).alias("text"))


FIGURES = Fixture("doc_id long, text string", ((1, "![a](b.png)\n\nFigure 1: one\ntext\nFigure 2: alone"), (2, '## <img src="x.png"/> Title\nbody\n#### <img src="y.png">'), (3, "<img src='q'>\n\n\n  **Fig. 3** caption\nFigure 4 follows a caption"), (4, "![a](b)\n\n\n\nFigure 5: too far"), (5, ""), (6, None)))
_LIFT = r"'^(#{1,6}\s+)(.*?)(<img\s[^>]*>)(.*)$'"


@query(
    rf"""with s as (select * from {FIGURES.sql()}), a as (select doc_id, unnest(range(1, len(string_split(text, chr(10))) + 1)) i, unnest(string_split(text, chr(10))) line from s),
b as (select doc_id, i, case when not regexp_matches(line, {_LIFT}) then line else regexp_extract(line, {_LIFT}, 3) || case when trim(regexp_extract(line, {_LIFT}, 2) || regexp_extract(line, {_LIFT}, 4)) = '' then '' else chr(10) || chr(10) || regexp_extract(line, {_LIFT}, 1) || trim(trim(regexp_extract(line, {_LIFT}, 2)) || ' ' || trim(regexp_extract(line, {_LIFT}, 4))) end end line from a),
c as (select doc_id, string_agg(line, chr(10) order by i) t from b group by doc_id), l as (select doc_id, unnest(range(1, len(string_split(t, chr(10))) + 1)) i, unnest(string_split(t, chr(10))) line from c),
m as (select *, (contains(line, '<img') or regexp_matches(line, '^\s*!\[')) im, max(case when trim(line) <> '' then i end) over (partition by doc_id order by i rows between unbounded preceding and 1 preceding) last from l),
o as (select m.doc_id, m.i, case when regexp_matches(m.line, '{L.CAPTION}') and not contains(m.line, '<figcaption>') and p.im and m.i - p.i <= 3 then '<figcaption>' || trim(m.line) || '</figcaption>' else m.line end line from m left join m p on m.doc_id = p.doc_id and m.last = p.i),
t as (select doc_id, string_agg(line, chr(10) order by i) t from o group by doc_id) select s.doc_id, t as text from s left join t on s.doc_id = t.doc_id"""
)
def images_lifted_and_captioned(spark, sf_dir):
    return FIGURES.spark(spark).select("doc_id", L.captioned_images(L.lifted_images(F.col("text"))).alias("text"))


@query("select n_regionkey doc_id, '| name | key |' || chr(10) || '| --- | --- |' || chr(10) || string_agg('| ' || n_name || ' | ' || n_nationkey || ' |', chr(10) order by n_nationkey) md, false empty from nation group by 1", "doc_id bigint, md varchar, empty boolean")
def pipe_tables(spark, sf_dir):
    n = T.load(spark, sf_dir, "nation").groupBy("n_regionkey").agg(F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name"))).alias("x"))
    rows = F.concat(F.array(F.array(F.lit("name"), F.lit("key"))), F.transform("x", lambda r: F.array(r.n_name, r.n_nationkey.cast("string"))))
    return n.select(F.col("n_regionkey").alias("doc_id"), L.pipe_table(rows).alias("md"), L.is_empty_table(rows).alias("empty"))


LINKED = Fixture("doc_id long, text string", ((1, 'see <img src="media/image1.png" w="3"/> x\n![alt](../media/image2.emf) y\n![](other/image9.png)'), (2, '<img alt="q" src="./image1.png">'), (3, "no image"), (4, None)))
MEDIA = Fixture("doc_id long, source string, name string", ((1, "media/image1.png", "img01.png"), (1, "media/image2.emf", "img02.png"), (2, "media/image1.png", "img07.png")))


@query(
    rf"""with s as (select * from {LINKED.sql()}), l as (select doc_id, unnest(range(1, len(string_split(text, chr(10))) + 1)) i, unnest(string_split(text, chr(10))) line from s),
f as (select *, case when contains(line, '<img') then regexp_extract(line, 'src="([^"]+)"', 1) else regexp_extract(line, '\]\(([^)]+)\)', 1) end src from l), o as (select f.doc_id, i, case when name is null then line else replace(line, src, 'pics/' || name) end line from f left join {MEDIA.sql()} m on f.doc_id = m.doc_id and m.source = 'media/' || regexp_extract(src, '[^/]*$')),
t as (select doc_id, string_agg(line, chr(10) order by i) t from o group by doc_id) select s.doc_id, t as text from s left join t on s.doc_id = t.doc_id"""
)
def images_relinked(spark, sf_dir):
    names = MEDIA.spark(spark).groupBy("doc_id").agg(F.map_from_entries(F.collect_list(F.struct("source", "name"))).alias("names"))
    found = LINKED.spark(spark).join(names, "doc_id", "left")
    text = F.when(F.col("names").isNull(), F.col("text")).otherwise(L.relinked_images(F.col("text"), F.col("names"), F.lit("pics")))
    return found.select("doc_id", text.alias("text"))


# ---- metadata ------------------------------------------------------------------------------------

PAPERS = Fixture(
    "doc_id long, md string, n_images long",
    (
        (1, "---\ntitle: \"A study\n  of things\"\ndocument_type: paper\ndocument_domain: general\n---\n# A study of cost\nAuthors: Ann Lee, Bo Ek and C; the team, x@y.org, Carl Correspondence\n## Abstract\nFirst  line\n\nsecond the line\n## Intro\nthe end", 3),
        (2, "---\nauthor_note: z\ndocument_domain: 'epidemiology'\n---\n# Ministry of Health\n# Short\n### abstract of it\n" + "word " * 150, 0),
        (3, "---\ntitle: Plain\ndocument_type: memo\n---\nno heading", None),
        (4, "--- broken\ntitle: no end", 1),
        (5, "", 0),
        (6, None, 0),
    ),
)
_PL = f"s as (select * from {PAPERS.sql()}), l as (select doc_id, unnest(range(1, len(string_split(md, chr(10))) + 1)) i, unnest(string_split(md, chr(10))) line from s)"
_AUTHORS = r"""a as (select doc_id, arg_min(regexp_extract(line, '(?i)authors?:?\s*(.+)', 1), i) a from l where i <= 80 and regexp_matches(line, '(?i)\bauthor') and regexp_matches(line, '(?i)authors?:?\s*.+') group by doc_id),
au as (select doc_id, array_to_string(list_filter(list_transform(string_split_regex(a, '[,;]\s*|\sand\s'), lambda x: trim(x)), lambda x: length(x) > 2 and not regexp_matches(x, '(?i)^(for|the|and|or|of)\b') and not contains(lower(x), 'correspondence') and not contains(x, '@') and not starts_with(x, 'http')), '; ') authors from a),
b as (select *, regexp_matches(line, '(?i)^#{1,3}\s*abstract') ab from l), b1 as (select doc_id, min(i) i0 from b where ab group by doc_id), b2 as (select b.doc_id, i0, min(i) filter (regexp_matches(line, '^#{1,3}\s') and not ab and i > i0) i1 from b join b1 on b.doc_id = b1.doc_id group by 1, 2),
ac as (select b.doc_id, left(trim(regexp_replace(string_agg(line, ' ' order by i) filter (not ab), '\s+', ' ', 'g')), 500) abstract from b join b2 on b.doc_id = b2.doc_id and i > i0 and (i1 is null or i < i1) group by b.doc_id)"""


@query(f"with {_PL}, {_AUTHORS} select s.doc_id, case when md is null then null else coalesce(authors, '') end authors, case when abstract <> '' then abstract end abstract from s left join au on s.doc_id = au.doc_id left join ac on s.doc_id = ac.doc_id")
def authors_and_abstract(spark, sf_dir):
    p = PAPERS.spark(spark)
    found = F.when(F.col("md").isNotNull(), F.array_join(M.authors(F.col("md")), "; "))
    return p.select("doc_id", found.alias("authors"), M.abstract(F.col("md")).alias("abstract"))


_FM = r"regexp_extract(md, '(?s)^---(.*?)\n---', 1)"


@query(
    rf"""with s as (select doc_id, md, {_FM} fm from {PAPERS.sql()}), l as (select doc_id, unnest(range(1, len(string_split(fm, chr(10))) + 1)) i, unnest(string_split(fm, chr(10))) line from s), k as (select *, regexp_matches(line, '^[a-zA-Z_]') key from l),
g as (select *, sum(key::int) over (partition by doc_id order by i) g from k), v as (select doc_id, trim(regexp_replace(string_agg(trim(replace(regexp_replace(line, '^title:', ''), '"', '')), ' ' order by i), '\s+', ' ', 'g')) title from g join (select doc_id d, g gg from g where line like 'title:%') on doc_id = d and g = gg group by doc_id),
d as (select doc_id, min(trim(regexp_extract(line, '^document_domain:\s*(\S+)', 1), '''"')) dom from l where line like 'document_domain:%' group by doc_id)
select s.doc_id, v.title, case when dom <> 'general' then dom end as domain, case when fm = '' or contains(fm, 'document_domain:') or not starts_with(md, '---' || chr(10)) then md when contains(fm, 'document_type:') then regexp_replace(md, '(document_type:[^\n]*)', '\1' || chr(10) || 'document_domain: other') else '---' || fm || chr(10) || 'document_domain: other' || md[length(fm) + 4:] end md from s left join v on s.doc_id = v.doc_id left join d on s.doc_id = d.doc_id"""
)
def front_matter(spark, sf_dir):
    md = F.col("md")
    return PAPERS.spark(spark).select("doc_id", M.front_title(md).alias("title"), M.front_domain(md).alias("domain"), M.with_domain(md, F.lit("other")).alias("md"))





@query(
    f"with {_SECTIONS}, ti as (select doc_id, arg_min(trim(line[3:]), line_no) title from l where line_no <= 80 and line like '# %' and length(trim(line[3:])) > 5 and not contains(lower(line), 'ministry of health') group by doc_id), {_AUTHORS.replace('from l', 'from (select doc_id, line_no i, line from l)')}, sm as (select doc_id, count(*) n, sum(word_count) w from s group by doc_id), "
    + "kt as (select doc_id, ord, term, (length(lower(md)) - length(replace(lower(md), term, ''))) // length(term) n from md, (values "
    + ", ".join(f"({i}, '{t}')" for i, t in enumerate(_TERMS))
    + f") v(ord, term)), kr as (select *, row_number() over (partition by doc_id order by n desc, ord) r from kt where n > 0), kk as (select doc_id, string_agg(term, '; ' order by r) key_terms from kr where r <= 5 group by doc_id) "
    "select md.doc_id, coalesce(title, 'Unknown Title') title, coalesce(authors, '') authors, case when abstract <> '' then abstract end abstract, coalesce(sm.n, 0) total_sections, coalesce(w, 0) total_words, 2 total_images, " + _domain_sql("md") + " document_domain, coalesce(key_terms, '') key_terms "
    "from md left join ti on md.doc_id = ti.doc_id left join au on md.doc_id = au.doc_id left join ac on md.doc_id = ac.doc_id left join sm on md.doc_id = sm.doc_id left join kk on md.doc_id = kk.doc_id",
    "doc_id bigint, title varchar, authors varchar, abstract varchar, total_sections bigint, total_words bigint, total_images bigint, document_domain varchar, key_terms varchar",
)
def context_summary(spark, sf_dir):
    return M.context_summary(T.page_markdown(spark, sf_dir).withColumn("n_images", F.lit(2)), ["ministry of health"], _TERMS)


# ---- images --------------------------------------------------------------------------------------

#: Measurements made from orders' lines, the same in both engines.
_MEASURED = {
    "doc_id": "l_orderkey",
    "pos": "l_linenumber",
    "page": "l_linenumber % 3",
    "size_bytes": "cast(floor(l_extendedprice) as bigint)",
    "width": "cast(floor(l_quantity) as bigint) * 20",
    "height": "l_suppkey * 9 % 700",
    "mean": "l_partkey % 256 * 1.0e0",
    "std": "l_partkey % 45 * 1.0e0",
    "colors": "l_partkey % 130",
    "alpha": "case when l_returnflag = 'R' then 200.0e0 end",
}
_MEASURED_SQL = "(select " + ", ".join(f"{v} {k}" for k, v in _MEASURED.items()) + ", l_returnflag rf, l_linestatus ls from lineitem)"


def _measured(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.load(spark, sf_dir, "lineitem").selectExpr(*[f"{v} as {k}" for k, v in _MEASURED.items()], "l_returnflag as rf", "l_linestatus as ls")


@query(
    f"""select doc_id, pos, size_bytes < 2000 or (size_bytes between 1 and 4999 and mean < 30 and colors < 16) or (std < 5 and coalesce(alpha, 255) >= 250) or (colors < 32 and mean < 240 and std < 30) or (size_bytes between 1 and 50000 and size_bytes < 0.15 * width * height and colors < 50 and std < 40) blank,
not (size_bytes > 50000 or (std > 20 and colors > 100)) and (mean > 240 or width = 0 or height = 0 or (not (width > 500 and height > 500 and colors * 50 > 5000) and mean / 256 > 0.99)) blank_render, mean < 10 and (std < 5 or mean / 10 > 0.95) near_black, greatest(width, height) > 600 oversized from {_MEASURED_SQL}"""
)
def blank_images(spark, sf_dir):
    size, w, h, mean, std, colors, alpha = (F.col(c) for c in I.PIXELS)
    return _measured(spark, sf_dir).select(
        F.col("doc_id"), F.col("pos"), I.is_blank(size, w, h, mean, std, colors, alpha).alias("blank"), I.is_blank_render(size, w, h, std, colors, mean, colors * 50, mean / 256).alias("blank_render"), I.is_near_black(mean, std, mean / 10).alias("near_black"), I.is_oversized(w, h, 600).alias("oversized")
    )


@query(
    f"""with r as (select *, case when rf = 'A' and ls = 'F' and pos <> 2 then 'near-black (render failed)' when width > 0 and height > 0 and height < 50 and width >= 50 then 'narrow_fragment (h=' || height || 'px)' when width > 0 and height > 0 and width < 50 and height >= 50 then 'narrow_fragment (w=' || width || 'px)'
when width > 0 and height > 0 and width < 50 and height < 50 then 'tiny image (< 50x50)' when size_bytes < 2048 then 'tiny file (< 2KB)' end bad from {_MEASURED_SQL}) select doc_id, pos, coalesce(bad, case when rf = 'R' then 'table screenshot' when ls = 'O' then 'fallback extraction' else 'default' end) reason, bad is null is_substantive from r"""
)
def extracted_image_class(spark, sf_dir):
    m = _measured(spark, sf_dir).withColumn("near_black", F.expr("rf = 'A' and ls = 'F'")).withColumn("rerendered", F.col("pos") == 2).withColumn("table_shot", F.col("rf") == "R").withColumn("fallback", F.col("ls") == "O")
    return I.extracted_class(m).select("doc_id", "pos", "reason", "is_substantive")


@query(
    f"""with i as (select *, rf = 'R' dup, size_bytes < 5000 blank, colors = 1 render, colors = 2 chart, height < 100 flagged, width < 300 decorative from {_MEASURED_SQL}), p as (select doc_id, page, count(*) n_images, bool_or(not dup and (blank or render or chart or not (flagged or decorative))) y, bool_and(dup) d, bool_or(blank) b from i group by 1, 2)
select doc_id, page, n_images, case when d then 'No (duplicate)' when y then 'Yes' else 'No' end "label", case when d then 'all images are duplicates' when b and y then 'content lost' else '' end notes from p""",
    'doc_id bigint, page bigint, n_images bigint, "label" varchar, notes varchar',
)
def office_page_labels(spark, sf_dir):
    flags = {"is_duplicate": "rf = 'R'", "is_blank": "size_bytes < 5000", "is_render": "colors = 1", "is_chart": "colors = 2", "flagged": "height < 100", "decorative": "width < 300"}
    return I.office_pages(_measured(spark, sf_dir).withColumns({k: F.expr(v) for k, v in flags.items()}))


DETAILS = Fixture("doc_id long, page long, pos long, rendered boolean", ((1, 5, 1, False), (1, 5, 2, False), (1, 5, 3, False), (1, 6, 1, True), (1, 7, 1, False), (2, 5, 1, False)))
FILES = Fixture("doc_id long, path string", ((1, "d/page5-img2.jpeg"), (1, "d/page5-img1.png"), (1, "d/page6-vector-render.png"), (1, "d/fig2-p7.PNG"), (1, "d/page5.txt"), (1, "d/logo.png"), (2, "d/Page_6-img1.png")))


@query(
    rf"""with f as (select *, regexp_extract(path, '([^/]+?)(\.[^./]*)?$', 1) stem from {FILES.sql()} where regexp_matches(lower(path), '\.(png|jpe?g|bmp|tiff?|gif)$')), g as (select doc_id, path, contains(stem, 'render') r, coalesce(try_cast(regexp_extract(stem, '(?i)page[-_]?(\d+)', 1) as bigint), try_cast(regexp_extract(stem, '(?i)(^|[-_])p(\d+)([-_]|$)', 2) as bigint)) page from f),
h as (select *, row_number() over (partition by doc_id, page, r order by path) k from g where page is not null), d as (select *, row_number() over (partition by doc_id, page, rendered order by pos) k from {DETAILS.sql()}) select d.doc_id, d.page, pos, path from d join h on d.doc_id = h.doc_id and d.page = h.page and d.rendered = h.r and (case when rendered then 1 else d.k end) = h.k"""
)
def image_file_match(spark, sf_dir):
    return I.matched_files(DETAILS.spark(spark), FILES.spark(spark))


IMAGES = Fixture(
    "doc_id long, pos long, figure_num string, description string, filename string, page long, width long, height long, source_format string, excluded boolean, heading string, nearby string",
    ((1, 1, "1", "a plot", "a.png", 2, 30, 40, "png", False, "Results|all", "x | " + "near " * 40), (1, 2, "2", None, "b.png", None, 5, None, "jpeg", True, None, ""), (1, 3, None, "c", "c.png", 2, 7, 8, "emf", False, "Intro", None), (2, 1, "1", "d", "d.png", 9, 1, 1, "png", True, None, None)),
)
INDEXED = Fixture("doc_id long, md string", ((1, "# T\nNo images extracted.\nend"), (2, "No images extracted."), (3, "No images extracted."), (4, "nothing")))


@query(
    f"""with r as (select doc_id, string_agg('| ' || coalesce(figure_num, '?') || ' | ' || coalesce(description, '') || ' | [' || filename || '](pics/' || filename || ') | ' || coalesce(page::varchar, '-') || ' | ' || coalesce(width::varchar, '?') || 'x' || coalesce(height::varchar, '?') || ' | ' || source_format || ' |', chr(10) order by pos) body from {IMAGES.sql()} group by doc_id)
select d.doc_id, '## Image Index' || chr(10) || chr(10) || case when body is null then 'No images extracted.' else '| Fig | Description | File | Page/Slide | Size | Source |' || chr(10) || '|-----|-------------|------|------------|------|--------|' || chr(10) || body end || chr(10) || chr(10) md from {INDEXED.sql()} d left join r on d.doc_id = r.doc_id"""
)
def image_index_text(spark, sf_dir):
    return I.image_index(INDEXED.spark(spark), IMAGES.spark(spark), "pics")


@query(
    f"""with r as (select doc_id, string_agg('| ' || coalesce(figure_num, '?') || ' | ' || filename || ' | ' || coalesce(page::varchar, '?') || ' | ' || coalesce(width::varchar, '?') || 'x' || coalesce(height::varchar, '?') || ' |', chr(10) order by pos) filter (not excluded) body, count(*) filter (excluded) x, count(*) n from {IMAGES.sql()} group by doc_id),
t as (select doc_id, '| Figure | File | Page | Size |' || chr(10) || '|--------|------|------|------|' || coalesce(chr(10) || body, '') || case when x > 0 then chr(10) || chr(10) || '*Showing ' || (n - x) || ' substantive images. ' || x || ' decorative/blank/duplicate images excluded.*' else '' end t from r)
select d.doc_id, case when t is null then md else replace(md, 'No images extracted.', t) end md from {INDEXED.sql()} d left join t on d.doc_id = t.doc_id"""
)
def placeholder_filled(spark, sf_dir):
    return I.filled_placeholder(INDEXED.spark(spark), IMAGES.spark(spark))


SPOTS = Fixture("doc_id long, page long, context string", ((1, 2, "the context"), (1, 3, "a | b"), (2, 9, "c" * 130), (3, 1, None)))


@query(
    f"""with j as (select p.doc_id, p.page, figure_num, filename, heading, coalesce(nullif(nearby, ''), context, '') n, i.doc_id is not null has from {SPOTS.sql()} p left join {IMAGES.sql()} i on p.doc_id = i.doc_id and p.page = i.page)
select doc_id, page, coalesce(figure_num, '?') figure_num, case when has then coalesce(filename, '?') else '(see manifest)' end file_path, replace(coalesce(heading, '—'), '|', '\\|') "section", replace(left(n, 120), '|', '\\|') || case when has and length(n) > 120 then '...' else '' end nearby from j""",
    'doc_id bigint, page bigint, figure_num varchar, file_path varchar, "section" varchar, nearby varchar',
)
def agent_image_rows(spark, sf_dir):
    return I.agent_rows(SPOTS.spark(spark), IMAGES.spark(spark).withColumnRenamed("filename", "file_path"))


TABLES = Fixture("doc_id long, text string", ((1, "a\n| x |\n| y |\nb\n| z |\n\n<!-- c -->\n<!-- WARNING: Table may have collapsed columns. -->"), (2, "<!-- WARNING: Table may have collapsed columns. -->\n\n| x |\ntext"), (3, "<!-- WARNING: Table may have collapsed columns. -->\nblock\n| x |"), (4, "no table")))
FLAGGED = Fixture("doc_id long, start long, end long, n_values long, n_cols long", ((1, 2, 3, 9, 2), (1, 5, 5, 4, 1), (2, 3, 3, 5, 1), (3, 3, 3, 7, 3)))


@query(
    f"""with l as (select doc_id, unnest(range(1, len(string_split(text, chr(10))) + 1)) i, unnest(string_split(text, chr(10))) line from {TABLES.sql().replace(" end ", ' "end" ')}), f as (select doc_id, c0 s, c1 e, c2 v, c3 c from (values (1, 2, 3, 9, 2), (1, 5, 5, 4, 1), (2, 3, 3, 5, 1), (3, 3, 3, 7, 3)) t(doc_id, c0, c1, c2, c3)),
b as (select distinct f.doc_id, f.e from f join l w on f.doc_id = w.doc_id and contains(w.line, 'WARNING: Table may have') and (w.i between f.e + 1 and f.e + 5 or w.i between f.s - 5 and f.s - 1) where not exists (select 1 from l x where x.doc_id = f.doc_id and trim(x.line) <> '' and x.line not like '<!--%' and (x.i > f.e and x.i < w.i or x.i < f.s and x.i > w.i))),
a as (select doc_id, i, 0 late, line from l union all select f.doc_id, f.e, 1, '<!-- WARNING: Table may have collapsed columns. Original had ' || v || ' values but only ' || c || ' columns detected. Manual verification recommended. -->' from f left join b on f.doc_id = b.doc_id and f.e = b.e where b.e is null) select doc_id, row_number() over (partition by doc_id order by i, late) line_no, line from a""",
    "doc_id bigint, line_no bigint, line varchar",
)
def collapsed_tables_annotated(spark, sf_dir):
    return I.annotated_tables(T.lines(TABLES.spark(spark), "text"), FLAGGED.spark(spark))


OUTLINE = Fixture(
    "doc_id long, md string",
    (
        (1, "# ScienceDirect\n# **A long enough title here**\ntext\n#### Methods\n##### Sample\n###### Site\n###### Ward\n## Costs\n# Other top\n### Below\n#### Deeper\n##### Deepest"),
        (2, "### Short\n## **Introduction**\n### One\n## Two\n##### Three"),
        (3, "## Results\n### Elsevier\n### A heading after the results"),
        (4, "## Ab\n### Cd\n### Ef\n#### Gh"),
        (5, "no heading\n#none"),
        (6, ""),
        (7, None),
    ),
)
_OUTLINE_SQL = rf"""with recursive s as (select * from {OUTLINE.sql()} union all select doc_id + 100, md from ({_md_sql()}) m_),
l as (select doc_id, unnest(range(1, len(string_split(md, chr(10))) + 1)) line_no, unnest(string_split(md, chr(10))) line from s),
h as (select *, length(regexp_extract(line, '^(#{{1,6}})\s+(.+)$', 1)) lv, trim(regexp_extract(line, '^(#{{1,6}})\s+(.+)$', 2)) t, trim(regexp_extract(line, '^(#{{1,6}})\s+(.+)$', 2), '* ') p from l),
c as (select *, regexp_matches(p, {_quoted(S.whole(S.BOILERPLATE))}) b, regexp_matches(p, {_quoted(S.whole(S.MAJOR))}) m from h where lv > 0),
k as (select *, row_number() over (partition by doc_id order by line_no) n from c where not b),
e as (select doc_id, min(n) n from k where length(p) > 15 or m group by doc_id),
w as (select k.doc_id, case when length(p) > 15 or k.n = 1 then k.n else k.n - 1 end n from k join e on k.doc_id = e.doc_id and k.n = e.n),
r as (select k.*, w.n is not null title from k left join w on k.doc_id = w.doc_id and k.n = w.n),
f as (select doc_id, line_no, n, lv, t, case when title then 1 when m or lv = 1 then 2 else 3 end target from r where n = 1
union all select r.doc_id, r.line_no, r.n, r.lv, r.t, case when title then 1 when m or r.lv = 1 then 2 when r.lv > f.lv then least(f.target + 1, 4) else 3 end from f join r on f.doc_id = r.doc_id and r.n = f.n + 1)
select h.doc_id, h.line_no, case when f.n is not null then repeat('#', f.target::int) || ' ' || f.t when h.lv > 0 then '' else h.line end line from h left join f on h.doc_id = f.doc_id and h.line_no = f.line_no"""


@query(_OUTLINE_SQL, "doc_id bigint, line_no bigint, line varchar")
def headings_releveled(spark, sf_dir):
    pages = T.page_markdown(spark, sf_dir).select((F.col("doc_id") + 100).alias("doc_id"), "md")
    return S.releveled(T.lines(OUTLINE.spark(spark).unionByName(pages)))


ZONED = Fixture("doc_id long, text string", ((1, "the  ﬁrst\n```\ncode  ﬁx\n```\nand <!-- a  ﬁ\nb --> then  ﬁn"), (2, "```a  b```  <!-- c  d -->"), (3, "see https://x.org/a  ﬁ and sub.site.com  or  ﬂow"), (4, "```open  fence  ﬁ"), (5, ""), (6, None)))
_ZONES_SQL = _quoted("|".join([L.CODE_ZONE, L.COMMENT_ZONE, L.URL_ZONE, L.HOST_ZONES[0].replace(r"(?!Table\b|Fig\b|Eq\b|Ref\b)", ""), L.HOST_ZONES[1]]))  # without the look-ahead, which no row needs


@query(
    f"""with s as (select * from {ZONED.sql()}), c as (select doc_id, text, regexp_extract_all(text, {_ZONES_SQL}) z, string_split_regex(text, {_ZONES_SQL}) o from s)
select doc_id, case when text is not null then array_to_string(list_transform(o, lambda x, i: regexp_replace(replace(replace(x, 'ﬁ', 'fi'), 'ﬂ', 'fl'), '  +', ' ', 'g') || coalesce(z[i], '')), '') end as text from c"""
)
def repaired_outside_zones(spark, sf_dir):
    return ZONED.spark(spark).select("doc_id", L.outside_zones(F.col("text"), lambda x: F.regexp_replace(expanded_ligatures(x), "  +", " ")).alias("text"))


SPACED = Fixture("doc_id long, text string", ((1, "don ' t , the patient ’ s ( first ) cost - effective 95 % of 3 - 4"), (2, "cost-\n  effective and well- \nknown, a - \nend"), (3, "a - b - c [ x ] ! We ‘ VE done"), (4, ""), (5, None)))


def _spacing_sql(t: str) -> str:
    t = rf"regexp_replace({t}, '([\p{{L}}\p{{N}}_])-\s*\n\s*([\p{{L}}\p{{N}}_])', '\1-\2', 'g')"
    for pattern, put in L.SPACINGS:
        t = f"regexp_replace({t}, {_quoted(pattern)}, {_quoted(re.sub(r'[$](.)', lambda m: chr(92) + m[1], put))}, 'g')"
    return t


@query(f"select doc_id, {_spacing_sql('text')} as text from (select * from {SPACED.sql()} union all select doc_id + 100, text from documents) s")
def spacing_closed(spark, sf_dir):
    docs = T.load(spark, sf_dir, "documents").select((F.col("doc_id") + 100).alias("doc_id"), "text")
    return SPACED.spark(spark).unionByName(docs).select("doc_id", L.closed_spacing(L.joined_hyphen_breaks(F.col("text"))).alias("text"))
