"""The ordered repair of extracted documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkstrata.functions import lines as L
from inkstrata.functions import rejoin as R
from inkstrata.functions import segment as G
from inkstrata.functions import text as X
from inkstrata.operators import noise as N


def repaired_documents(docs: DataFrame, counts: dict[str, int]) -> DataFrame:
    """docs (doc_id, text) with all repairs, each after those that it builds on: characters composed, hyphens at line ends, glyph codes, runs of blanks;
    outside code, comments and addresses ligatures, split words, compounds and words that ran together; references, blanks at apostrophes and punctuation, and
    lines of noise. counts: lower-case words and their counts. doc_id names a row: noise is judged by neighbouring lines, which is the only shuffle. A null
    text stays null, an empty one empty; an empty table gives an empty result; other columns are ignored."""
    text = L.joined_hyphen_breaks(R.composed(F.col("text")))
    text = G.repaired_words(L.single_spaced(X.repaired_glyphs(text)), counts)
    rows = docs.select("doc_id", L.closed_spacing(text).alias("text"))
    return N.without_noise(rows.filter("text is not null")).unionByName(docs.filter("text is null").select("doc_id", "text"))


def legacy_repaired_documents(docs: DataFrame, words: list[str]) -> DataFrame:
    """docs (doc_id, text) by the older rule: ligatures, words split around them, blanks at apostrophes, and lines of noise. As repaired_documents otherwise."""
    rows = docs.select("doc_id", L.closed_spacing(R.rejoined(X.expanded_ligatures(F.col("text")), words, older=True)).alias("text"))
    return N.without_noise(rows.filter("text is not null")).unionByName(docs.filter("text is null").select("doc_id", "text"))
