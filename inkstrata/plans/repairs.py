"""Queries of text repairs by rule and dictionary, reports and checks; importing this module registers them. Their SQL states the expected rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from inkstrata.functions import rejoin as R
from inkstrata.functions import segment as G
from inkstrata.functions import text as X
from inkstrata.operators import assemble as A
from inkstrata.operators import classify as C
from inkstrata.operators import images as I
from inkstrata.operators import index_text as W
from inkstrata.operators import noise as N
from inkstrata.operators import quality as Q
from inkstrata.operators import repair
from inkstrata.operators import reports as P
from inkstrata.operators import structure as S
from inkstrata.operators import validate as V
from inkstrata.plans.catalog import query
from inkstrata.plans.fixtures import Fixture
from inkstrata.sources import tables as T


def _rows(ddl: str, *rows: tuple) -> str:
    return Fixture(ddl, rows).sql()[1:-1]


_TEXT = "doc_id long, text string"

# ---- text ----------------------------------------------------------------------------------------

NOISY = Fixture(
    _TEXT,
    (
        (1, "Keep this ordinary sentence of many words.\nxq7 zkw3 p0vb #9rt lmn4 qd8 &hj2 w5x v6c tgb1\nend"),
        (2, "![fig](a.png)\nabcd ghjkl mnpqr stvwx bcdfg hjklm\n\nabcd ghjkl mnpqr stvwx bcdfg hjklm"),
        (3, "xq7 zkw3 p0vb #9rt lmn4 qd8 &hj2 w5x v6c p = 0.03\n# xq7 zkw3 p0vb #9rt lmn4 qd8 &hj2 w5x\n| xq7 zkw3 p0vb #9rt lmn4 qd8 &hj2 w5x |\nxq7 zkw3"),
        (4, "a\n\n\n\n\nb"),
        (5, ""),
    ),
)


@query(
    _rows(
        _TEXT,
        (1, "Keep this ordinary sentence of many words.\nend"),
        (2, "![fig](a.png)\n\nabcd ghjkl mnpqr stvwx bcdfg hjklm"),
        (3, "xq7 zkw3 p0vb #9rt lmn4 qd8 &hj2 w5x v6c p = 0.03\n# xq7 zkw3 p0vb #9rt lmn4 qd8 &hj2 w5x\n| xq7 zkw3 p0vb #9rt lmn4 qd8 &hj2 w5x |\nxq7 zkw3"),
        (4, "a\n\nb"),
        (5, ""),
    )
)
def ocr_noise_stripped(spark, sf_dir):
    return N.without_noise(NOISY.spark(spark))


@query(
    r"""with l as (select doc_id, unnest(range(1, len(string_split(text, chr(10))) + 1)) line_no, regexp_replace(unnest(string_split(text, chr(10))), '^\s+|\s+$', '', 'g') x from documents),
m as (select *, length(x) >= 20 and not regexp_matches(x, '^(#|\||!|<!--|```|---|>)') o from l),
c as (select doc_id, line_no, length(x) n, unnest(string_split(lower(x), '')) ch from m where o), f as (select doc_id, line_no, ch, count(*) / cast(any_value(n) as double) p from c group by all),
e as (select doc_id, line_no, -sum(p * log2(p)) bits from f group by all),
w as (select doc_id, line_no, list_filter(regexp_split_to_array(x, '\s+'), lambda a: a <> '') a from m where o)
select e.doc_id, cast(e.line_no as bigint) line_no, round(bits, 6) bits, round(len(list_filter(a, lambda y: length(y) >= 2 and regexp_matches(y, '[aeiouAEIOU]'))) / cast(len(a) as double), 6) as "real" from e join w using (doc_id, line_no) where bits > 4.2"""
)
def line_noise_measures(spark, sf_dir):
    """What the noise rule measures, over all documents; their lines hold none of its statistics."""
    x = T.lines(T.load(spark, sf_dir, "documents"), "text").withColumn("x", F.regexp_replace("line", r"^\s+|\s+$", ""))
    x = x.filter((F.length("x") >= 20) & ~F.col("x").rlike(N.STRUCTURAL)).withColumn("bits", N.entropy(F.lower("x"))).filter("bits > 4.2")
    return x.select("doc_id", "line_no", F.round("bits", 6).alias("bits"), F.round(N.real_words(F.col("x")), 6).alias("real"))


MARKED = Fixture(
    _TEXT,
    (
        (1, "# **Head** **two**\nbody **kept**"),
        (2, "see 中 the arrow 文字 here but 中文文字字 stays and 中文, too Ezamy"),
        (3, "one two ab1c de2f gh3i\n\none two three four ab1c\n\nbcdfghjkl mnpqrstvw a b c"),
        (4, "AC9 and AC 12, ACE 9\n42: Analyses made\n42: analyses"),
        (5, "Ren\\'ee \\\"uber ma\\~nana caf'e fianc'ee \\~5 \\* 3。5 3。 5 a。5"),
        (6, ""),
        (7, None),
    ),
)


@query(
    _rows(
        _TEXT,
        (1, "# Head two\nbody **kept**"),
        (2, "see  the arrow  here but 中文文字字 stays and 中文, too "),
        (3, "[OCR garbled — refer to source document]\none two ab1c de2f gh3i\n\none two three four ab1c\n\n[OCR garbled — refer to source document]\nbcdfghjkl mnpqrstvw a b c"),
        (4, "€9 and €12, ACE 9\nTable 42: Analyses made\n42: analyses"),
        (5, "Renée über mañana café fiancée ~5 * 3.5 3. 5 a。5"),
        (6, ""),
        (7, None),
    )
)
def markdown_post_processed(spark, sf_dir):
    return MARKED.spark(spark).select("doc_id", X.post_processed(F.col("text")).alias("text"))


BRACKETED = Fixture(_TEXT, ((1, "Staf[inski and Kof[ijberg, f[l"), (2, "Figure[a] model[fit] x[1]"), (3, '<span id="page-1"></span> Text <span id="k" > </span>\nafter\n- 0[12] Ref\n- 1[3]'), (4, None)))


@query(_rows(_TEXT, (1, "Stafinski and Kofijberg, fl"), (2, "Figure[a] model[fit] x[1]"), (3, "Text after\n- [12] Ref\n- 1[3]"), (4, None)))
def marker_artifacts(spark, sf_dir):
    return BRACKETED.spark(spark).select("doc_id", X.without_anchors(X.closed_ligature_brackets(F.col("text"))).alias("text"))


WORDS = ["difficulties", "office", "findings", "flow", "staff", "different", "first", "coefficient", "stifle"]  # a dictionary for the fixture
SPLIT = Fixture(
    _TEXT,
    (
        (1, "dif fi culties in the of fi ce"),
        (2, "if fi had; we fi go"),
        (3, "Kof fi jberg and xo fi zzz"),
        (4, "the staf fi\nend of fi, a staf fi"),
        (5, "fi ndings fl ow fi zzz"),
        (6, "  dif-  fi- cul ties di f fe rent\nfi rst coef fi cient"),
        (7, "no change  here\tat all"),
        (8, None),
    ),
)


@query(
    _rows(
        _TEXT,
        (1, "difficulties in the office"),
        (2, "if fi had; we fi go"),
        (3, "Koffijberg and xo fi zzz"),
        (4, "the staf fi\nend of fi, a staffi"),
        (5, "findings flow fi zzz"),
        (6, "  difficulties different\nfirst coefficient"),
        (7, "no change  here\tat all"),
        (8, None),
    )
)
def ligature_words_rejoined(spark, sf_dir):
    return SPLIT.spark(spark).select("doc_id", R.rejoined(F.col("text"), WORDS).alias("text"))


ACCENTED = Fixture(_TEXT, ((1, "é s  ́ äb"), (2, "plain é"), (3, "n ̃o"), (4, ""), (5, None)))


@query(_rows(_TEXT, (1, "é ś äb"), (2, "plain é"), (3, "ño"), (4, ""), (5, None)))
def characters_composed(spark, sf_dir):
    return ACCENTED.spark(spark).select("doc_id", R.composed(F.col("text")).alias("text"))


@query("select distinct doc_id, w word, lower(w) in ('the', 'data', 'und', 'les', 'de', 'del') valid from (select doc_id, unnest(list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '')) w from documents where doc_id < 1000000000) x")
def words_in_dictionary(spark, sf_dir):
    w = T.load(spark, sf_dir, "documents").select("doc_id", F.explode(X.words(F.col("text"))).alias("word")).distinct()
    return w.select("doc_id", "word", R.is_valid(F.col("word"), ["the", "data", "und", "les", "de", "del"]).alias("valid"))


COUNTS = {"health": 50, "technology": 30, "value": 40, "in": 500, "the": 1000, "and": 800, "outcomes": 20, "for": 600, "example": 30, "increase": 20, "correspondingly": 5, "results": 20, "state": 20, "million": 20, "analyses": 10, "gained": 10, "both": 20, "pin": 5, "cost": 30, "a": 900, "of": 800, "existing": 5, "difficulties": 3, "model": 10, "patient": 10, "however": 10, "see": 9, "first": 9, "said": 9, "don't": 9, "office": 9, "utility": 5, "x": 2, "by": 70, "li": 3, "k": 3}  # a dictionary for the fixtures
MERGED = Fixture(
    _TEXT,
    (
        (1, "healthTechnology VOIanalyses ISPORValue QALYgained ICERresults"),
        (2, "  inthehealth,  InHealthTechnology   (inthehealth). \nkept  as   is"),
        (3, "outcomes.Forexample FitzmauriceC,Dicker Correspondingly,theincrease"),
        (4, "M+Pinboth. 3state 3.5million 3rd pre-existing cost-utility HIV/AIDS xqzwv"),
        (5, ""),
        (6, None),
    ),
)


@query(
    _rows(
        _TEXT,
        (1, "health Technology VOI analyses ISPOR Value QALY gained ICER results"),
        (2, "  in the health, In Health Technology (in the health).\nkept  as   is"),
        (3, "outcomes. For example FitzmauriceC, Dicker Correspondingly, the increase"),
        (4, "M+Pin both. 3-state 3.5 million 3rd pre-existing cost-utility HIV/AIDS xqzwv"),
        (5, ""),
        (6, None),
    )
)
def run_togethers_split(spark, sf_dir):
    return MERGED.spark(spark).select("doc_id", G.split_run_togethers(F.col("text"), COUNTS).alias("text"))


SPACED = Fixture(
    _TEXT,
    ((1, "A B S T RACT\nthe Wei bull\nby Egging ton."), (2, "# A B C D\nin the\nA B C D E"), (3, "De Vries — the  patient, however"), (4, "  mod el  of\nTech nology and a  model"), (5, "pati ent, heal th"), (6, ""), (7, None)),
)


@query(_rows(_TEXT, (1, "ABSTRACT\nthe Weibull\nby Eggington."), (2, "# A B C D\nin the\nABCDE"), (3, "De Vries — the  patient, however"), (4, "  model of\nTechnologyand a model"), (5, "patient, health"), (6, ""), (7, None)))
def space_splits_merged(spark, sf_dir):
    return SPACED.spark(spark).select("doc_id", G.merge_space_splits(F.col("text"), COUNTS).alias("text"))


CITED = Fixture(
    _TEXT,
    ((1, "x\n## References\n\n## [1] A b\ncontinued\n\n2. Zed\n### more\nLi, K. Text\n1.5 no\n# Appendix A\nrest\nmore"), (2, "References\nloose\n[1] a\n  b"), (3, "## References"), (4, "Our references\nare [1]\nhere"), (5, None)),
)


@query(_rows(_TEXT, (1, "x\n## References\n\n[1] A b continued\n\n2. Zed more\nLi, K. Text 1.5 no\n# Appendix A\nrest\nmore"), (2, "References\nloose\n[1] a b"), (3, "## References"), (4, "Our references\nare [1]\nhere"), (5, None)))
def references_tidied(spark, sf_dir):
    return CITED.spark(spark).select("doc_id", G.repaired_references(F.col("text")).alias("text"))


BROKEN = Fixture(
    _TEXT,
    (
        (1, "the  dif fi culties of\tthe of\ufb01ce (a costutility mod el , 95 %) /C15 see inthehealth"),
        (2, "see https://x.org/inthehealth/a  and `` the\n```\ninthehealth  a\n```\nInHealthTechnology"),
        (3, "the cost-\nutility model don ' t\nxq7 zkw3 p0vb #9rt lmn4 qd8 &hj2 w5x v6c tgb1\n## References\n[1] a model\nof health"),
        (4, "a\x00b e\u0301"),
        (5, ""),
        (6, None),
    ),
)


@query(
    _rows(
        _TEXT,
        (1, "the difficulties of the office (a cost-utility model, 95%) • see in the health"),
        (2, "see https://x.org/inthehealth/a and `` the\n```\ninthehealth  a\n```\nIn Health Technology"),
        (3, "the cost-utility model don't\n## References\n[1] a model of health"),
        (4, "a\x00b \u00e9"),
        (5, ""),
        (6, None),
    ).replace("\x00", "' || chr(0) || '")
)
def documents_repaired(spark, sf_dir):
    return repair.repaired_documents(BROKEN.spark(spark), COUNTS)


@query(_rows(_TEXT, (1, "xofizzz of the office, don't"), (2, "in fi ab"), (3, ""), (4, None)))
def documents_repaired_by_older_rule(spark, sf_dir):
    return repair.legacy_repaired_documents(Fixture(_TEXT, ((1, "xo fi zzz of the of\ufb01ce , don ' t"), (2, "in fi ab"), (3, ""), (4, None))).spark(spark), WORDS)


# ---- sources and headers ----------------------------------------------------------------------------

FILES = Fixture("name string, body string", (("my_first-note.txt", "line one\nline two"), ("plain", ""), ("a.b.txt", "é")))


def _text_file(title: str, name: str, body: str) -> tuple:
    return (name, f'---\ntitle: "{title}"\nsource_file: "{name}"\nsource_format: "txt"\ndocument_type: "text"\nfidelity_standard: "text_content"\ntotal_images: 0\nimage_notes: none\n---\n\n# {title}\n\n{body}')


@query(_rows("name string, md string", _text_file("my first note", "my_first-note.txt", "line one\nline two"), _text_file("plain", "plain", ""), _text_file("a.b", "a.b.txt", "é"), _text_file("latin", "latin.txt", "é")))
def text_files_as_markdown(spark, sf_dir):
    files = FILES.spark(spark).select("name", F.encode("body", "UTF-8").alias("body"))
    latin = spark.createDataFrame([("latin.txt", bytearray(b"\xe9"))], "name string, body binary")
    return files.unionByName(latin).select("name", N.text_document(F.col("name"), F.col("body")).alias("md"))


KINDS = Fixture("doc_id long, format string", ((1, "pdf"), (2, "pptx"), (3, "docx"), (4, "pdf")))
PAGED = Fixture("doc_id long, page long", ((1, 1), (1, 2), (1, 2), (2, 1), (3, 1)))


@query(_rows("doc_id long, format string, pages long, estimate long", (1, "pdf", 2, 2), (2, "pptx", 1, 1), (3, "docx", None, 1), (4, "pdf", None, 1)))
def page_counts(spark, sf_dir):
    return N.page_count(PAGED.spark(spark), KINDS.spark(spark))


HEADED = Fixture("path string, format string, pages long, images long, day string", (("/a/b.pdf", "pdf", 3, 1, "2026-01-02"), ("c.pptx", "pptx", 5, 0, "2026-01-02"), ("d.docx", "docx", None, 0, "2026-01-02")))


@query(
    _rows(
        "path string, header string",
        ("/a/b.pdf", "---\nsource_file: b.pdf\nsource_path: /a/b.pdf\nsource_format: pdf\npages: 3\nconversion_date: 2026-01-02\nconversion_tool: docling + PyMuPDF\nfidelity_standard: verbatim (QC required)\ndocument_type: research_paper\nimage_notes: pending\n---\n\n"),
        ("c.pptx", "---\nsource_file: c.pptx\nsource_path: c.pptx\nsource_format: pptx\nslides: 5\nconversion_date: 2026-01-02\nconversion_tool: MarkItDown + python-pptx\nfidelity_standard: verbatim (QC required)\ndocument_type: presentation\nimage_notes: none\n---\n\n"),
        ("d.docx", "---\nsource_file: d.docx\nsource_path: d.docx\nsource_format: docx\nconversion_date: 2026-01-02\nconversion_tool: MarkItDown + python-docx\nfidelity_standard: verbatim (QC required)\ndocument_type: document\nimage_notes: none\n---\n\n"),
    )
)
def document_headers(spark, sf_dir):
    return HEADED.spark(spark).select("path", N.header(F.col("path"), F.col("format"), F.col("pages"), F.col("images"), F.to_date("day")).alias("header"))


META = Fixture("doc_id long, n_pages long, title string, author string, stat_pages long", ((1, 4, " A proper title ", "Li", None), (2, None, "Short", "X", 7), (3, None, "Ministry of Health", None, None)))


@query(_rows("doc_id long, page_count long, title string, author string", (1, 4, "A proper title", "Li"), (2, 7, None, None), (3, 0, None, None)))
def metadata_validated(spark, sf_dir):
    return P.validated_metadata(META.spark(spark), F.lower("title").contains("ministry"))


@query(_rows("index string", ("# Image Index: paper\n\nSource: /x/paper.pdf\n\n**Error:** no pages\n\n---\n\n## Page-by-Page Index\n\n| Page | Images | Substantive | Context (first 150 chars) |\n|------|--------|-------------|---------------------------|\n| — | — | — | no pages |\n",)))
def error_image_index(spark, sf_dir):
    return spark.range(1).select(P.error_index(F.lit("paper-image-index"), F.lit("/x/paper.pdf"), F.lit("no pages")).alias("index"))


VECTORS = Fixture("page long, drawings long, area double", ((1, 50, 1.0), (2, 50, 0.9), (3, 49, 5.0), (4, 7, 4.9), (5, 6, 50.0), (6, 7, 5.0)))


@query(_rows("page long, significant boolean", (1, True), (2, False), (3, True), (4, False), (5, False), (6, True)))
def vector_pages(spark, sf_dir):
    return VECTORS.spark(spark).select("page", C.has_vector_content(F.col("drawings"), F.col("area")).alias("significant"))


# ---- checks -----------------------------------------------------------------------------------------

INDEXED = Fixture(
    "doc_id long, md string",
    (
        (1, "# T\n## Image Index\n\n| 1 | [a.png](images/p/a.png) |\n| 2 | [b.jpg](images/p/b.jpg) |\n---\n[c.gif](c.gif)"),
        (2, "## Image Index\n\nnone [x](y.html)"),
        (3, "no section"),
        (4, "no section either"),
        (5, "## Image Index\n\n[k.png](k.png)\n## Next\n[z.png](z.png)"),
    ),
)
COMPANIONS = Fixture("doc_id long, filename string", ((4, "d-image-index.md"), (4, "c-image-index.md")))


@query(_rows("doc_id long, issue string", (1, "INFO: 3 image reference(s) in index"), (2, "INFO: No image file references found"), (3, "WARN: No Image Index section found"), (4, "INFO: Image Index companion file found: c-image-index.md"), (5, "INFO: 2 image reference(s) in index")))
def image_index_checked(spark, sf_dir):
    return P.image_index_check(INDEXED.spark(spark), COMPANIONS.spark(spark))


@query(_rows("doc_id long, links string, section string, names string", (1, "images/p/a.png,images/p/b.jpg,c.gif", "| 1 | [a.png](images/p/a.png) |\n| 2 | [b.jpg](images/p/b.jpg) |", "a.png,b.jpg"), (2, "", "none [x](y.html)", ""), (3, "", None, None), (4, "", None, None), (5, "k.png,z.png", "[k.png](k.png)", "k.png")))
def index_links(spark, sf_dir):
    md = F.col("md")
    return INDEXED.spark(spark).select("doc_id", F.array_join(P.image_links(md), ",").alias("links"), P.index_section(md).alias("section"), F.array_join(P.index_filenames(P.index_section(md)), ",").alias("names"))


WRITTEN = Fixture("doc_id long, md string", ((1, "# Image Index: p\nSource: /x/p.pdf\n| 9 | 9 | before |\n## Substantive Images Only\n| Page | Images | Context |\n|---|---|---|\n| 3 | 2 | a plot |\n| — | — | none |\n| x | 1 | bad |\n| 4 | 1 | map |\n---\n| 5 | 1 | after |"), (2, "nothing")))


@query(_rows("doc_id long, page long, image_count long, context string, source_path string", (1, 3, 2, "a plot", "/x/p.pdf"), (1, 4, 1, "map", "/x/p.pdf")))
def image_index_read_back(spark, sf_dir):
    return P.parsed_index(T.lines(WRITTEN.spark(spark)))


SUMMARIES = Fixture("doc_id long, format string, summary string", ((1, "pdf", '{"title": "t", "sections": [], "total_images": 0, "document_domain": "d"}'), (2, "pdf", '{"title": "t", "total_images": 1}'), (3, "pdf", "{bad"), (4, "pdf", None), (5, "DOCX", None)))


@query(_rows("doc_id long, issue string", (1, "PASS: context-summary.json valid"), (2, "WARN: context-summary.json missing fields: sections, document_domain"), (3, "WARN: Cannot read context-summary.json"), (4, "WARN: context-summary.json not found"), (5, "INFO: context-summary.json not applicable for this format")))
def context_summary_checked(spark, sf_dir):
    return P.context_summary_check(SUMMARIES.spark(spark))


FOLDERS = Fixture("doc_id long, folder string, stem string, md string", ((1, "/a", "p", "[x](images/q/x.png)"), (2, "/a", "p", "[x](images/gone/x.png)"), (3, "/b", "r", ""), (4, "/c", "s", ""), (5, "/d", "t", "")))
PRESENT = Fixture("path string", (("/a/images/q/image-manifest.json",), ("/a/images/p/image-manifest.json",), ("/b/r_manifest.json",), ("/b/a_manifest.json",), ("/c/z_manifest.json",), ("/c/y_manifest.json",)))


@query(_rows("doc_id long, manifest string, found boolean", (1, "/a/images/q/image-manifest.json", True), (2, "/a/images/p/image-manifest.json", True), (3, "/b/r_manifest.json", True), (4, "/c/y_manifest.json", True), (5, "/d/images/t/image-manifest.json", False)))
def manifest_found(spark, sf_dir):
    return P.manifest_path(FOLDERS.spark(spark), PRESENT.spark(spark))


# ---- runs, verdicts and plans -----------------------------------------------------------------------

ATTEMPTS = Fixture("doc_id long, pos long, extractor string, exit_code long", ((1, 0, "marker", 1), (1, 1, "docling", 0), (1, 2, "mineru", 1), (2, 0, "tesseract", 2), (2, 1, "mineru", 1), (3, 0, "docling", 0)))


@query(_rows("doc_id long, extractor string, fallback_chain string", (1, "docling", "marker"), (2, None, "tesseract,mineru"), (3, "docling", "")))
def fallback_runs(spark, sf_dir):
    return P.fallback_outcome(ATTEMPTS.spark(spark))


PICTURED = Fixture("doc_id long, page long, file_path string, is_substantive boolean, reason string", ((1, 1, "x/a.png", True, "large"), (1, 2, "y/a.png", False, "logo"), (1, 2, "b.png", None, None), (1, 3, "", True, "none"), (2, 1, "c.png", False, "blank")))


@query(_rows("doc_id long, classes string", (1, '{"a.png":{"classification":"DEC","reason":"logo"},"b.png":{"classification":"SUB","reason":"unknown"}}'), (2, '{"c.png":{"classification":"DEC","reason":"blank"}}')))
def image_classes_by_name(spark, sf_dir):
    return P.class_map(PICTURED.spark(spark)).select("doc_id", F.to_json("per_image_classification").alias("classes"))


VERDICTS = Fixture("doc_id long, page long, substantive boolean", ((1, 1, True), (1, 2, False), (1, 3, False), (2, 1, True)))
ON_DISK = Fixture("doc_id long, page long, decorative boolean", ((1, 1, True), (1, 1, True), (1, 2, True), (1, 2, False)))


@query(_rows("doc_id long, page long, substantive boolean, n_files long", (1, 1, False, 2), (1, 2, True, 2), (1, 3, False, 0), (2, 1, True, 0)))
def page_verdicts_recomputed(spark, sf_dir):
    return P.recomputed_pages(VERDICTS.spark(spark), ON_DISK.spark(spark))


COUNTED = Fixture("doc_id long, total_extracted long, total_images long, image_count long, duplicates_skipped long, flags string", ((1, 9, 8, 7, 2, "1"), (2, None, 8, None, None, "1,0,1"), (3, None, None, None, None, "")))


@query(_rows("doc_id long, total long, unique_images long, duplicates long", (1, 9, 7, 2), (2, 8, 3, 2), (3, 0, 0, 0)))
def manifest_image_counts(spark, sf_dir):
    flags = F.transform(F.filter(F.split("flags", ","), lambda x: x != ""), lambda x: x == "1")
    return P.image_counts(COUNTED.spark(spark).withColumn("images", flags))


SHOWN = Fixture("doc_id long, page long, id long, x0 double, y0 double, x1 double, y1 double", ((1, 1, 1, 100.0, 100.0, 200.0, 200.0), (1, 2, 2, 0.0, 0.0, 10.0, 10.0)))
SAID = Fixture("doc_id long, page long, no long, x0 double, y0 double, x1 double, y1 double, text string", ((1, 1, 1, 100.0, 20.0, 200.0, 30.0, "Text  above"), (1, 1, 2, 100.0, 210.0, 200.0, 220.0, "Figure 3: Survival of all"), (1, 1, 3, 100.0, 400.0, 200.0, 410.0, "far Table 9"), (1, 1, 4, 400.0, 210.0, 500.0, 220.0, "Table 7 aside"), (1, 1, 5, 150.0, 290.0, 200.0, 295.0, "long " * 50)))


@query(_rows("doc_id long, page long, id long, caption string, nearby string", (1, 1, 1, "Figure 3: Survival of all", ("Text above Figure 3: Survival of all " + "long " * 50)[:200] + "..."), (1, 2, 2, None, None)))
def text_near_image(spark, sf_dir):
    return P.text_near_images(SHOWN.spark(spark), SAID.spark(spark))


_BOX = "x0 double, y0 double, x1 double, y1 double"
DETECTED = Fixture(
    f"doc_id long, page long, pos long, {_BOX}",
    ((1, 1, 0, 0.0, 0.0, 100.0, 100.0), (1, 1, 1, 10.0, 10.0, 100.0, 100.0), (1, 1, 2, 300.0, 300.0, 400.0, 400.0), (1, 1, 3, None, None, None, None), (1, 1, 4, 0.0, 0.0, 5.0, 5.0), (1, 2, 5, 0.0, 0.0, 5.0, 5.0), (1, None, 6, None, None, None, None)),
)
EXTRACTED = Fixture(
    f"doc_id long, page long, idx long, filename string, {_BOX}",
    ((1, 1, 0, "far.png", 5000.0, 5000.0, 5100.0, 5100.0), (1, 1, 1, "near.png", 310.0, 410.0, 390.0, 490.0), (1, 1, 2, "best.png", 0.0, 0.0, 100.0, 100.0), (1, 1, 3, "next.png", 0.0, 0.0, 60.0, 60.0)),
)


@query(_rows("doc_id long, pos long, filename string, method string", (1, 0, "best.png", "iou"), (1, 1, "next.png", "iou"), (1, 2, "near.png", "distance"), (1, 3, "far.png", "order"), (1, 4, None, "unmapped"), (1, 5, None, "unmapped"), (1, 6, None, "unmapped")))
def images_matched_one_to_one(spark, sf_dir):
    return P.matched_images(DETECTED.spark(spark), EXTRACTED.spark(spark))


HOLDERS = Fixture("doc_id long, md string", ((1, "a\n<!-- image -->\n  <!-- image -->\nb"), (2, "<!-- image -->\n<!-- image -->\n<!-- image -->")))
NAMED = Fixture("doc_id long, pos long, filename string", ((1, 0, "x.png"), (1, 1, None), (2, 0, "y.png")))


@query(_rows("doc_id long, line_no long, line string", (1, 1, "a"), (1, 2, "<!-- IMAGE: x.png -->"), (1, 3, "<!-- IMAGE: unmapped -->"), (1, 4, "b"), (2, 1, "<!-- IMAGE: y.png -->"), (2, 2, "<!-- image -->"), (2, 3, "<!-- image -->")))
def placeholders_named(spark, sf_dir):
    return P.named_placeholders(T.lines(HOLDERS.spark(spark)), NAMED.spark(spark))


PLANNED = Fixture("doc_id long, context_title string, front_title string, context_domain string, front_domain string", ((1, "A study", "Other", "general", "oncology"), (2, " Unknown ", "From front", "cardiology", None), (3, None, None, None, None)))
IMAGES = Fixture(
    "doc_id long, no long, is_duplicate boolean, blank boolean, decorative boolean, classification string, personas string, width long, height long",
    ((1, 1, False, None, None, "SUB", "b,a", 100, 2001), (1, 2, True, True, False, None, "a", 9000, 10), (1, 3, False, True, True, None, "a", 10, 10), (1, 4, None, None, True, None, "a", 10, 10), (1, 5, None, None, None, "DEC", "a", 10, 10), (1, 6, None, None, None, None, "a,c", 50, None), (1, 7, None, None, None, None, "b", 2000, 2000), (2, 1, None, None, None, None, "", 5, 6)),
)


@query(
    _rows(
        "doc_id long, document_title string, document_domain string, total_images long, images_for_analysis long, skipped_duplicates long, skipped_blanks long, skipped_decoratives long, total_persona_analyses long, images_over_2000px long, max_dimension long, avg_personas_per_image double, most_common_persona string",
        (1, "A study", "oncology", 7, 3, 1, 1, 2, 5, 1, 2001, 1.7, "b (2/3 images)"),
        (2, "From front", "cardiology", 1, 1, 0, 0, 0, 0, 0, 6, 0.0, None),
        (3, "Unknown", "general", 0, 0, 0, 0, 0, 0, 0, None, 0.0, None),
    )
)
def analysis_summaries(spark, sf_dir):
    images = IMAGES.spark(spark).withColumn("personas", F.filter(F.split("personas", ","), lambda x: x != ""))
    return P.analysis_summary(PLANNED.spark(spark), images)


# ---- tables ---------------------------------------------------------------------------------------------

TABLED = Fixture(
    "doc_id long, md string",
    (
        (1, "# T\n| a | b |\n|---|---|\n| 1 2 3 | x |\n| 4 5 6 | **7** 8 9 |\ntext\n| only |\n| p |\n| q |\n| r 1 |"),
        (2, "| a | b |\n|---|---|\n| x |  |\n\n| a | b |\n| long text | more text |\n\n| 2026-01-02 10-20 3x4 | 1 |\n| 2026-01-02 10-20 3x4 | 2 |\n| 0.61–0.82 5 | 2 |"),
        (3, "## Image Index\n| a | b |\n| 1 2 3 | x |\n## Next\n| page | file |\n| 1 2 3 | x |\n\n| a | b |\n| 1 2 3 a.png | x |\n| 1 2 3 b.PNG | x |"),
        (4, "no table |\n|\nend"),
        (5, "<!-- WARNING: Table may have collapsed columns. Seen. -->\n\n| a | b |\n| 1 2 3 | 4 |"),
        (6, ""),
    ),
)


@query(
    _rows(
        "doc_id long, table_no long, start long, stop long, n_rows long, n_cols long, n_values long, is_index boolean, reason string",
        (1, 1, 2, 5, 3, 2, 6, False, "crowded_cells"),
        (1, 2, 7, 10, 4, 1, 1, False, "single_column"),
        (2, 1, 1, 3, 2, 2, 0, False, "sparse"),
        (2, 2, 5, 6, 2, 2, 0, False, None),
        (2, 3, 8, 10, 3, 2, 4, False, None),
        (3, 1, 2, 3, 2, 2, 3, True, None),
        (3, 2, 5, 6, 2, 2, 3, True, None),
        (3, 3, 8, 10, 3, 2, 3, True, None),
        (4, 1, 2, 2, 1, 1, 0, False, None),
        (5, 1, 3, 4, 2, 2, 4, False, "crowded_cells"),
    )
)
def tables_judged(spark, sf_dir):
    t = Q.judged_tables(T.lines(TABLED.spark(spark))).withColumnRenamed("end", "stop")
    return t.select("doc_id", "table_no", "start", "stop", "n_rows", "n_cols", "n_values", "is_index", "reason")


@query(
    _rows(
        "doc_id long, message string",
        (1, "Table 1 may have collapsed columns. Detected cells with multiple numeric values (2 multi-value cell(s) in worst row) across 2 column(s). 2/2 data rows affected. Manual verification recommended."),
        (1, "Table 2 may have collapsed columns. Single-column table with 3 data row(s) detected. Multi-column tables frequently collapse to 1 column during DOCX-to-markdown conversion. Manual verification recommended."),
        (2, "Table 1 may have collapsed columns. Table has 2 row(s) with zero numeric values across all data cells — expected data appears missing. Manual verification recommended."),
        (5, "Table 1 may have collapsed columns. Detected cells with multiple numeric values (1 multi-value cell(s) in worst row) across 2 column(s). 1/1 data rows affected. Manual verification recommended."),
    )
)
def collapse_warnings(spark, sf_dir):
    return Q.collapse_issues(Q.judged_tables(T.lines(TABLED.spark(spark)))).select("doc_id", "message")


_NOTE = "<!-- WARNING: Table may have collapsed columns. Original had %d values but only %d columns detected. Manual verification recommended. -->"


@query(
    _rows(
        "doc_id long, md string",
        (1, f"| a | b |\n| 1 2 3 | 4 |\n{_NOTE % (4, 2)}\nend"),
        (2, f"| a | b |\n| 1 2 3 | 4 |\n{_NOTE % (4, 2)}\nend"),
        (3, "<!-- WARNING: Table may have collapsed columns. Seen. -->\n\n| a | b |\n| 1 2 3 | 4 |"),
        (4, ""),
    )
)
def collapsed_tables_found_and_annotated(spark, sf_dir):
    """The second document was annotated before."""
    done = f"| a | b |\n| 1 2 3 | 4 |\n{_NOTE % (4, 2)}\nend"
    docs = Fixture("doc_id long, md string", ((1, "| a | b |\n| 1 2 3 | 4 |\nend"), (2, done), (3, TABLED.rows[4][1]), (4, ""))).spark(spark)
    return I.annotated_documents(docs)


GRIDS = Fixture(
    "doc_id long, md string",
    (
        (1, "| a | b |\n|---|---|\n| 1 |\n\n+---+---+\n| a | b |\n+===+===+\n| 1 | 2 |\n+---+---+"),
        (2, "+---+\n| x |\ntext\n+---+--+\n| x | y |\n+------+"),
        (3, "nothing"),
    ),
)


@query(
    _rows(
        "doc_id long, severity string, message string",
        (1, "FAIL", "Pipe table 1 has inconsistent column counts: [1, 2]. Rows: 3"),
        (1, "INFO", "Found 4 table(s) (3 pipe, 1 grid)"),
        (2, "FAIL", "Grid table 1 has inconsistent column counts: [1, 2]. Rows: 3"),
        (2, "INFO", "Found 3 table(s) (2 pipe, 1 grid)"),
        (3, "INFO", "No markdown tables found"),
    )
)
def table_structure_checked(spark, sf_dir):
    return Q.table_structure_issues(T.lines(GRIDS.spark(spark))).select("doc_id", "severity", "message")


# ---- written indexes ----------------------------------------------------------------------------------

_HEAD = "# Image Index: %s\n\nSource: /x/%s.pdf\nConverted: /x/%s.md\nGenerated: 2026-01-02 03:04\nPipeline version: v1\n\nTotal pages: %d\nPages with images: %d\nTotal images detected: %d\nEstimated substantive images: %d %s\nSubstantive image files: %d\nDecorative image files: %d\n\n---\n\n"
_PAGES = "## Page-by-Page Index\n\n| Page | Images | Substantive | Context (first 150 chars) |\n|------|--------|-------------|---------------------------|\n"
_DETAIL = "## Per-Image Classification Detail\n\n| Page | Image | Dims | File Size | Class | Reason |\n|------|-------|------|-----------|-------|--------|\n"
_ONLY = "## Substantive Images Only\n\n| Page | Images | Context |\n|------|--------|---------|\n"
_CRITERIA = "- Filtering criteria applied: dimensions (<50x50px), repeated xref (>50% pages), title/cover page, last-page decorations, figure keywords, journal branding (<100px/<5KB/extreme aspect), blank image detection (3-tier: size<2KB/near-black/<16colors/std<5), M1 color-block (<32 unique colors), low-density badge (<0.15 B/px AND <50 colors), low word count render (<20 words)"
INDEXES = Fixture("doc_id long, stem string, source_path string, output_path string, generated string, version string, n_overrides long, n_files long", ((1, "p", "/x/p.pdf", "/x/p.md", "2026-01-02 03:04", "1", 1, 5), (2, "q", "/x/q.pdf", "/x/q.md", "2026-01-02 03:04", "1", 0, 0)))
INDEX_PAGES = Fixture("doc_id long, page long, image_count long, is_substantive boolean, context string, drawings long, area double, rendered boolean", ((1, 10, 2, True, "a | b", 60, 1.0, None), (1, 2, 1, False, None, 60, 1.0, True), (1, 3, 0, False, "none", 60, 1.0, None), (2, 1, 0, False, "x", None, None, None)))
INDEX_IMAGES = Fixture("doc_id long, page long, pos long, file_path string, xref long, width long, height long, size_bytes long, is_substantive boolean, reason string", ((1, 10, 2, "", 7, 5, 6, None, None, None), (1, 10, 1, "i/a.png", None, 100, 200, 12345, True, "large"), (1, 2, 1, "b.png", None, None, None, None, False, "logo")))
_WRITTEN = (
    _HEAD % ("p", "p", "p", 3, 2, 3, 1, "(after filtering + 1 override(s))", 2, 1)
    + _PAGES + "| 2 | 1 | No | [no text on page] |\n| 10 | 2 | Yes | a \\| b |\n\n---\n\n"
    + _DETAIL + "| 2 | b.png | 0x0 | ? | DEC | logo |\n| 10 | a.png | 100x200 | 12,345B | SUB | large |\n| 10 | xref-7 | 5x6 |  | SUB | unknown |\n\n---\n\n"
    + _ONLY + "| 10 | 1 | a \\| b |\n\n---\n\n"
    + "## Vector Content Notes\n\n- Page 2: 60 vector drawings detected (page rendered as PNG)\n- Page 10: 60 vector drawings detected (figure may contain additional vector elements)\n\n---\n\n"
    + "## Filtering Summary\n\n- Pages scanned: 3\n- Pages with images: 2\n- Total image files on disk: 5\n- Images classified SUB: 2\n- Images classified DEC: 1\n- Pages classified as decorative: 1\n- Pages classified as substantive: 1\n"
    + _CRITERIA + ", vector rendering (1 pages)\n- Manual overrides applied: 1 page(s) (via image-index-overrides.json)\n"
)
_EMPTY = (
    _HEAD % ("q", "q", "q", 1, 0, 0, 0, "(after filtering)", 0, 0)
    + _PAGES + "| — | — | — | No images found in document |\n\n---\n\n" + _DETAIL + "\n---\n\n" + _ONLY + "| — | — | No substantive images found |\n\n---\n\n"
    + "## Filtering Summary\n\n- Pages scanned: 1\n- Pages with images: 0\n- Images classified SUB: 0\n- Images classified DEC: 0\n- Pages classified as decorative: 0\n- Pages classified as substantive: 0\n" + _CRITERIA + "\n"
)


@query(_rows("doc_id long, md string", (1, _WRITTEN), (2, _EMPTY)))
def image_indexes_written(spark, sf_dir):
    return W.written_index(INDEXES.spark(spark), INDEX_PAGES.spark(spark), INDEX_IMAGES.spark(spark))


_OFFICE = "Estimated substantive images: %s\n| Page | Images | Substantive | Context | Notes |\n|---|---|---|---|---|\n| 1 | 2 | %s | t1 | n1 |\n| 2 | 1 | No (duplicate) | t2 | n2 |\n| 3 | 1 | %s | t3 |  |\n## Substantive Images Only\n| Page | Images | Context | Notes |\n|---|---|---|---|\n%s\n---\n- Pages classified as decorative: %d\n- Pages classified as substantive: %d\n- Filtering criteria applied: c%s"
OFFICE = Fixture(
    "doc_id long, file string, md string",
    (
        (1, "deck.pptx", _OFFICE % ("1 (after filtering)", "Yes", "No", "| 1 | 2 | t1 | n1 |", 2, 1, "")),
        (2, "other.pptx", _OFFICE % ("1 (after filtering)", "Yes", "No", "| 1 | 2 | t1 | n1 |", 2, 1, "")),
        (3, "deck.docx", None),
        (4, "sole.docx", _OFFICE % ("1 (after filtering)", "Yes", "No", "| 1 | 2 | t1 | n1 |", 2, 1, "")),
    ),
)
RULES = Fixture("ord long, regex string, page long, classification string", ((1, "^deck", 1, "substantive"), (2, "^deck", 3, "SUBSTANTIVE"), (3, "^deck", 2, "maybe"), (4, "^deck", 9, "DECORATIVE"), (5, "^sole", 1, "SUBSTANTIVE"), (6, "^sole", 1, "DECORATIVE")))


@query(
    _rows(
        "doc_id long, md string, n_changed long",
        (1, _OFFICE % ("2 (after filtering + 1 override(s))", "Yes", "Yes", "| 1 | 2 | t1 | n1 |\n| 3 | 1 | t3 |  |", 1, 2, "\n- Manual overrides applied: 1 page(s) (via image-index-overrides.json)"), 1),
        (2, _OFFICE % ("1 (after filtering)", "Yes", "No", "| 1 | 2 | t1 | n1 |", 2, 1, ""), 0),
        (3, None, 0),
        (4, _OFFICE % ("0 (after filtering + 1 override(s))", "No", "No", "| — | — | No substantive images found |  |", 3, 0, "\n- Manual overrides applied: 1 page(s) (via image-index-overrides.json)"), 1),
    )
)
def image_indexes_overridden(spark, sf_dir):
    return W.overridden_indexes(OFFICE.spark(spark), RULES.spark(spark))


OFFICE_DOCS = Fixture("doc_id long, stem string, source_path string, output_path string, generated string, version string, manifest string, total_pages long, total_images long", ((1, "d", "/x/d.pptx", "/x/d.md", "2026-01-02 03:04", "1", "m.json", 4, 9), (2, "e", "/x/e.docx", "/x/e.md", "2026-01-02 03:04", "1", None, 1, 2), (3, "f", "/x/f.pptx", "/x/f.md", "2026-01-02 03:04", "1", "m.json", 2, 0)))
OFFICE_PAGES = Fixture("doc_id long, page long, images long, label string, is_substantive boolean, lost boolean, n_decorative long, context string, told string", ((1, 2, 3, "Yes", True, True, 1, "a|b", "blank|x"), (1, 10, 0, "No (duplicate)", False, True, 2, "", ""), (2, 1, 2, "Yes", True, True, 5, "c" * 151, "n")))
_OFFICE_HEAD = "# Image Index: %s\n\nSource: /x/%s\nConverted: /x/%s.md\nGenerated: 2026-01-02 03:04\nPipeline version: v1\n"
_NOTED_PAGES = "## Page-by-Page Index\n\n| Page | Images | Substantive | Context (first 150 chars) | Notes |\n|------|--------|-------------|---------------------------|-------|\n"
_NOTED_ONLY = "## Substantive Images Only\n\n| Page | Images | Context | Notes |\n|------|--------|---------|-------|\n"
_LISTED = "- Data source: manifest JSON (includes renders, blank/duplicate flags)\n- Filtering criteria applied: manifest blank flag, manifest duplicate flag, manifest decorative flag, dimensions (<50x50px), title/cover page, last-page decorations, figure keywords\n"


@query(
    _rows(
        "doc_id long, md string",
        (
            1,
            _OFFICE_HEAD % ("d", "d.pptx", "d") + "Data source: manifest (m.json)\n\nTotal pages: 4\nPages with images: 2\nTotal images detected: 9\nUnique non-decorative images: 3 (excludes duplicates and manifest-decorative)\nEstimated substantive images: 3 (after filtering)\nManifest-decorative images: 3 (small icons/badges flagged during extraction)\nPages with content lost (WMF failure): 1\n\n---\n\n"
            + _NOTED_PAGES + "| 2 | 3 | Yes | a\\|b |  \\| blank\\|x |\n| 10 | 0 | No (duplicate) | [no text context] |  |\n\n---\n\n" + _NOTED_ONLY + "| 2 | 3 | a\\|b |  \\| blank\\|x |\n\n---\n\n"
            + "## Filtering Summary\n\n- Pages scanned: 4\n- Pages with images: 2\n- Pages classified as decorative: 1\n- Pages classified as substantive: 1\n- Individual images flagged decorative (manifest): 3\n- Pages with content lost (WMF render failure): 1\n" + _LISTED,
        ),
        (
            2,
            _OFFICE_HEAD % ("e", "e.docx", "e") + "\nTotal pages: 1\nPages with images: 1\nTotal images detected: 2\nEstimated substantive images: 2 (after filtering)\n\n---\n\n" + _PAGES + "| 1 | 2 | Yes | " + "c" * 150 + "... |\n\n---\n\n" + _ONLY + "| 1 | 2 | " + "c" * 150 + "... |\n\n---\n\n"
            + "## Filtering Summary\n\n- Pages scanned: 1\n- Pages with images: 1\n- Pages classified as decorative: 0\n- Pages classified as substantive: 1\n- Filtering criteria applied: dimensions (<50x50px), repeated image (>50% pages), title/cover page, last-page decorations, figure keywords\n",
        ),
        (
            3,
            _OFFICE_HEAD % ("f", "f.pptx", "f") + "Data source: manifest (m.json)\n\nTotal pages: 2\nPages with images: 0\nTotal images detected: 0\nEstimated substantive images: 0 (after filtering)\n\n---\n\n" + _NOTED_PAGES + "| — | — | — | No images found in document | |\n\n---\n\n" + _NOTED_ONLY + "| — | — | No substantive images found | |\n\n---\n\n"
            + "## Filtering Summary\n\n- Pages scanned: 2\n- Pages with images: 0\n- Pages classified as decorative: 0\n- Pages classified as substantive: 0\n" + _LISTED,
        ),
    )
)
def office_indexes_written(spark, sf_dir):
    pages = OFFICE_PAGES.spark(spark).withColumn("notes", F.filter(F.split("told", ";"), lambda x: x != ""))
    return W.written_office_index(OFFICE_DOCS.spark(spark), pages)


# ---- encodings, titles, headers, pages ----------------------------------------------------------------

CODED = Fixture(_TEXT, ((1, "arm þ arm, a þ b"), (2, "f3 ð x and y2 Þ, z"), (3, "a ¼ b, 1¼ c\n- 0[4] Ref /C15"), (4, "| ¼ | x¼ |"), (5, "САТ а Re´sume´ nin´o x´y"), (6, ""), (7, None)))


@query(
    _rows(
        "doc_id long, glyphs string, encoding string",
        (1, "arm + arm, a þ b", "arm + arm, a + b"),
        (2, "f3(x and y2), z", "f3 ð x and y2 +, z"),
        (3, "a = b, 1¼ c\n- [4] Ref •", "a = b, 1¼ c\n- 0[4] Ref /C15"),
        (4, "| = | x¼ |", "| = | x¼ |"),
        (5, "САТ а Re´sume´ nin´o x´y", "CAT а Résume´ niño x´y"),
        (6, "", ""),
        (7, None, None),
    )
)
def encodings_repaired(spark, sf_dir):
    t = F.col("text")
    return CODED.spark(spark).select("doc_id", X.repaired_glyphs(t).alias("glyphs"), X.repaired_encoding(t).alias("encoding"))


@query(_rows(_TEXT, (1, "a\n\n## Methods\nb"), (2, "x\n- item"), (3, None)))
def page_artifacts_removed(spark, sf_dir):
    docs = Fixture(_TEXT, ((1, "a\n## 1 3\n\n 12 \nMETHODS \nb\x02"), (2, "x\n `o`  item"), (3, None)))
    return docs.spark(spark).select("doc_id", X.repaired_extraction(F.col("text")).alias("text"))


TITLED = Fixture("doc_id long, md string", ((1, "# Journal of Things\n## **Second** level {#id}\n# `A real title`"), (2, "# Contents\n## Systematic review\n## A *sub* title\n## Other one"), (3, "# Slide 4 of it\n### No title"), (4, "# Systematic review of X\n"), (5, "x\n" * 30 + "# Too late a title")))


@query(_rows("doc_id long, title string, institutional boolean", (1, "A real title", False), (2, "A sub title", False), (4, "Systematic review of X", True)))
def titles_or_subtitles(spark, sf_dir):
    t = S.title_or_subtitle(T.lines(TITLED.spark(spark)))
    return t.select("doc_id", "title", S.is_institutional(F.col("title")).alias("institutional"))


_FULL = "source_file: a\nconversion_date: b\nconversion_tool: c\nfidelity_standard: d\ndocument_type: e"
CHECKED = Fixture(
    "doc_id long, md string",
    (
        (1, f"---\n{_FULL}\nsource_format: PDF\n---\n**a** *b* \\* c"),
        (2, f"---\n{_FULL}\nsource_format: pptx\nslides: 3\n---\n* item\n* item *x"),
        (3, "---\nsource_file: a\ndocument_type\n---\n[a](b\n[c](d) **"),
        (4, "text [x]( )"),
        (5, None),
    ),
)


@query(
    _rows(
        "doc_id long, message string",
        (1, "missing pages"),
        (2, "odd italic marks: 1"),
        (3, "missing conversion_date"),
        (3, "missing conversion_tool"),
        (3, "missing fidelity_standard"),
        (3, "missing document_type"),
        (3, "odd bold marks: 1"),
        (3, "links left open: 1"),
        (4, "no header block"),
        (4, "links without target: 1"),
    )
)
def headers_and_syntax_checked(spark, sf_dir):
    docs = CHECKED.spark(spark)
    return Q.header_issues(docs).unionByName(Q.syntax_issues(docs)).select("doc_id", "message")


DRAWN = Fixture("doc_id long, page long, drawings long, area double", ((1, 1, 60, 1.0), (1, 2, 60, 0.5), (1, 3, 60, 1.0), (1, 4, None, None), (1, 5, 0, 0.0)))
PLACED = Fixture("doc_id long, page long, image_id long, is_blank boolean, is_substantive boolean, reason string", ((1, 1, 1, True, False, "tiny"), (1, 2, 2, True, True, "large"), (1, 2, 3, None, True, "large"), (1, 4, 4, False, False, "tiny")))


@query(_rows("doc_id long, page long, page_substantive boolean, image_id long, is_substantive boolean, reason string", (1, 1, True, 1, True, "vector_page"), (1, 2, True, 2, False, "blank"), (1, 2, True, 3, True, "large"), (1, 3, True, None, None, None), (1, 4, False, 4, False, "tiny"), (1, 5, False, None, None, None)))
def pages_classed_by_drawings(spark, sf_dir):
    return A.page_classes(DRAWN.spark(spark), PLACED.spark(spark))


FLAGS = Fixture("doc_id long, pages long, flagged long", ((1, 10, 9), (2, 10, 10), (3, 9, 9), (4, 20, 8), (5, 20, 7)))
SLIDES = Fixture("doc_id long, is_slides boolean, n_garbled long", ((1, True, 5), (2, True, 6), (4, True, 0)))


@query(
    _rows(
        "doc_id long, n_pages long, rate double, is_slides boolean, wanted boolean, note string",
        (1, 10, 0.9, True, True, "high rate expected for slides"),
        (2, 10, 1.0, True, True, "slides with garbled output"),
        (3, 9, 1.0, False, False, None),
        (4, 20, 0.4, None, True, None),
        (5, 20, 0.35, None, False, None),
    )
)
def flag_rates_noted(spark, sf_dir):
    flags = FLAGS.spark(spark).select("doc_id", F.explode(F.expr("transform(sequence(1, pages), i -> i <= flagged)")).alias("flagged"))
    return V.flag_rate_notes(flags, SLIDES.spark(spark))


GROUPED = Fixture("id long, context string, file string", ((1, "alpha beta", "x/deck.one.pptx"), (2, "none", "beta.pdf"), (3, "none", ""), (4, "none", None)))


@query(_rows("id long, stem string, topic string", (1, "deck.one", "B"), (2, "beta", "B"), (3, "Unknown Document", "Uncategorised"), (4, "Unknown Document", "Uncategorised")))
def topics_or_documents(spark, sf_dir):
    c, f = F.col("context"), F.col("file")
    return GROUPED.spark(spark).select("id", C.topic_or_document(c, f, None).alias("stem"), C.topic_or_document(c, f, {"A": ["gamma"], "B": ["beta"]}).alias("topic"))
