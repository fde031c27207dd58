"""Front matter, authors, abstracts and the summary of a document, each within its row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkstrata.operators import classify, structure
from inkstrata.sources.tables import lines

_QUOTES = "\"'"


def _front(md: Column) -> Column:
    """The text between a first line of --- and the next, else ''."""
    return F.regexp_extract(md, r"(?s)^---(.*?)\n---", 1)


def front_title(md: Column) -> Column:
    """The front matter's title with its continuation lines, unquoted; null if there is none."""
    entry = F.regexp_extract(_front(md), r"(?m)^[ \t]*title:[ \t]*(\"?[^\"\n]*\"?[ \t]*(?:\n(?![a-zA-Z_])[^\n]*)*)", 1)
    parts = F.transform(F.split(entry, "\n"), lambda x: F.btrim(F.btrim(F.trim(x), F.lit('"')), F.lit("'")))
    out = F.trim(F.regexp_replace(F.array_join(parts, " "), r"\s+", " "))
    return F.when(out != "", out)


def front_domain(md: Column) -> Column:
    """The front matter's document_domain; `general` counts as none."""
    found = F.regexp_extract_all(_front(md), F.lit(r"(?m)^[ \t]*document_domain:[ \t]*(\S+)"), 1)
    plain = F.transform(found, lambda x: F.btrim(x, F.lit(_QUOTES)))
    return F.get(F.filter(plain, lambda x: (x != "") & (F.lower(x) != "general")), 0)


def with_domain(md: Column, domain: Column) -> Column:
    """md with `document_domain: ...` in its front matter, after document_type or last, unless there is one."""
    front = F.regexp_extract(md, r"(?s)^---\n(.*?)\n---", 1)
    head = F.regexp_extract(front, r"(?s)\A(.*?document_type:[^\n]*)", 1)
    entry = F.concat(F.lit("\ndocument_domain: "), domain)
    block = F.when(head != "", F.concat(head, entry, F.substring(front, F.length(head) + 1, F.length(front)))).otherwise(F.concat(front, entry))
    fit = md.rlike(r"(?s)^---\n.*?\n---") & ~front.contains("document_domain:")
    return F.when(fit, F.concat(F.lit("---\n"), block, F.substring(md, F.length(front) + 5, F.length(md)))).otherwise(md)


def authors(md: Column, first: int = 80) -> Column:
    """Names on the first of the first lines that speaks of authors; an empty array if none does."""
    near = F.filter(F.slice(F.split(md, "\n"), 1, first), lambda x: x.rlike(r"(?i)\bauthor") & x.rlike(r"(?i)authors?:?\s*.+"))
    named = F.regexp_extract(F.coalesce(F.get(near, 0), F.lit("")), r"(?i)authors?:?\s*(.+)", 1)
    parts = F.transform(F.split(named, r"[,;]\s*|\sand\s"), F.trim)
    good = lambda a: (F.length(a) > 2) & ~a.rlike(r"(?i)^(for|the|and|or|of)\b") & ~F.lower(a).contains("correspondence") & ~a.contains("@") & ~a.startswith("http")
    return F.filter(parts, good)


def abstract(md: Column, most: int = 500) -> Column:
    """The text under an Abstract heading (levels 1 to 3) up to the next heading, white space collapsed, at most `most` characters (the reference's limit); null if there is none."""
    is_abstract = lambda x: x.rlike(r"(?i)^#{1,3}\s*abstract")
    all_lines = F.split(md, "\n")
    at = F.array_position(F.transform(all_lines, is_abstract), True)
    rest = F.when(at > 0, F.slice(all_lines, at.cast("int") + 1, F.size(all_lines)))
    end = F.array_position(F.transform(rest, lambda x: x.rlike(r"^#{1,3}\s") & ~is_abstract(x)), True)
    body = F.filter(F.when(end > 0, F.slice(rest, 1, (end - 1).cast("int"))).otherwise(rest), lambda x: ~is_abstract(x))
    out = F.left(F.trim(F.regexp_replace(F.array_join(body, " "), r"\s+", " ")), F.lit(most))
    return F.when(out != "", out)


def context_summary(docs: DataFrame, rejected_titles: list[str], words: list[str]) -> DataFrame:
    """docs (doc_id, md, n_images): one record per document; authors and the five most frequent of words joined by `; `.
    A null text has no sections, the title `Unknown Title` and the domain general."""
    ln = lines(docs)
    s = structure.sections(ln).groupBy("doc_id").agg(F.count(F.lit(1)).alias("total_sections"), F.sum("word_count").alias("total_words"))
    terms = classify.key_terms(docs.select("doc_id", F.col("md").alias("text")), words)
    terms = terms.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("rank", "term"))).alias("t")).select("doc_id", F.array_join("t.term", "; ").alias("key_terms"))
    own = docs.select(
        "doc_id",
        F.coalesce(F.array_join(authors(F.col("md")), "; "), F.lit("")).alias("authors"),
        abstract(F.col("md")).alias("abstract"),
        F.coalesce(F.col("n_images"), F.lit(0)).cast("long").alias("total_images"),
        F.coalesce(classify.domain(F.col("md")), F.lit("general")).alias("document_domain"),
    )
    out = own.join(structure.title(ln, rejected_titles), "doc_id", "left").join(s, "doc_id", "left").join(terms, "doc_id", "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    return out.select("doc_id", F.coalesce("title", F.lit("Unknown Title")).alias("title"), "authors", "abstract", zero("total_sections"), zero("total_words"), "total_images", "document_domain", F.coalesce("key_terms", F.lit("")).alias("key_terms"))
