"""Text-repair expressions, Column to Column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Section words that converters leave in capitals
CAPITAL_HEADINGS = ["METHODS", "RESULTS", "DISCUSSION", "CONCLUSIONS", "CONCLUSION", "INTRODUCTION", "ABSTRACT", "REFERENCES", "BACKGROUND", "OBJECTIVES", "ACKNOWLEDGEMENTS", "ACKNOWLEDGMENTS", "APPENDIX", "LIMITATIONS"]
# Compounds that lose their hyphen in extraction
COMPOUNDS = ["cost-effectiveness", "cost-effective", "cost-utility", "cost-benefit", "self-report", "self-reported", "meta-analysis", "meta-analyses", "health-related", "preference-based", "condition-specific", "decision-making", "decision-analytic", "age-adjusted", "quality-adjusted", "willingness-to-pay"]
# Compounds of health economics and medicine whose hyphens are restored in whole words; they hold all of COMPOUNDS
DOMAIN_COMPOUNDS = ["cost-effectiveness", "cost-effective", "cost-utility", "cost-benefit", "cost-minimization", "cost-consequence", "quality-adjusted", "disability-adjusted", "age-adjusted", "risk-adjusted", "health-related", "disease-related", "treatment-related", "dose-related", "preference-based", "evidence-based", "population-based", "community-based", "hospital-based", "model-based", "utility-based", "value-based", "condition-specific", "disease-specific", "age-specific", "country-specific", "patient-specific", "decision-making", "decision-analytic", "decision-analysis", "meta-analysis", "meta-analyses", "meta-regression", "self-report", "self-reported", "self-reporting", "self-management", "self-administered", "willingness-to-pay", "pay-for-performance", "head-to-head", "state-of-the-art", "end-of-life", "quality-of-life", "year-of-life", "years-of-life", "out-of-pocket", "long-term", "short-term", "medium-term", "real-world", "all-cause", "first-line", "second-line", "third-line", "open-label", "double-blind", "single-arm", "two-arm", "multi-arm", "multi-payer", "multi-country", "progression-free", "event-free", "disease-free", "relapse-free", "recurrence-free", "treatment-free", "symptom-free", "intention-to-treat", "per-protocol", "dose-response", "time-varying", "time-dependent", "half-life", "well-being", "pre-specified", "pre-treatment", "post-treatment", "post-hoc", "one-way", "two-way", "multi-way"]
# Glyph codes of symbol fonts
FONT_CODES = {"/C15": "•", "/C0": "‘", "/C1": "’", "/C2": "“", "/C3": "”", "/C4": "–", "/C5": "—", "/C6": "†", "/C7": "‡", "/C8": "§", "/C9": "¶", "/C10": "©", "/C11": "®", "/C12": "™", "/C13": "°", "/C14": "±", "/C16": "‣", "/C19": "Ł"}
# Latin ligatures U+FB00 to U+FB06
LIGATURES = {"ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl", "ﬅ": "st", "ﬆ": "st"}
# Caption words and the image type that each implies, first match wins
CAPTION_TYPES = {"forest plot": "forest-plot", "kaplan": "kaplan-meier", "survival": "kaplan-meier", "tornado": "tornado-diagram", "decision tree": "decision-tree", "flow chart": "flow-chart", "flowchart": "flow-chart", "scatter": "scatter", "cost-effectiveness plane": "scatter", "box plot": "box-plot", "histogram": "histogram", "heatmap": "heatmap", "bar chart": "bar-chart", "line chart": "line-chart", "pie chart": "pie-chart", "funnel": "funnel-plot", "network": "network-diagram", "table": "table-image", "figure": "other", "fig.": "other"}

# Patterns of extraction faults and what replaces them, in order: number-only headings and page numbers; exponents, bullets, quoted comparisons
CONTROLS = [(r"[\x00-\x08\x0b\x0c\x0e-\x1f]", "")]
ORPHANS = [(r"(?m)^## \d+ \d+\s*$", ""), (r"(?m)^\s*\d{1,3}\s*$", "")]
EXPONENTS = [(r"R\s*\[2\]", "R^2"), (r"(?m)^\s*`o`\s+", "- "), (r"(?m)^>(\d)", r"\\>$1")]
# Signs that a font's encoding reads wrongly, by what stands beside them, and `- 0[n]` in reference lists
GLYPH_CONTEXTS = [(r"(?U)(\w{2,})\s*þ\s*(\w{2,})", "$1 + $2"), (r"(?U)(?<=\d)\s*ð\s*(?=\w)", "("), (r"(?U)(?<=\w)\s*Þ\s*(?=\s|[,;.\d])", ")"), (r"(?<=\s)¼(?=\s)", "="), (r"- 0\[(\d)\]", "- [$1]")]
# A spaced quarter, also alone in a table cell; Cyrillic capitals and the Latin ones that they look like; letters and what they are with an acute
QUARTERS = [(r"(?<=\s)¼(?=\s)", "="), (r"(?<=\|)\s*¼\s*(?=\|)", " = ")]
CONFUSABLES = ("АВСЕНКМОРТУХ", "ABCEHKMOPTYX")
ACUTES = {"a": "á", "e": "é", "i": "í", "o": "ó", "u": "ú", "n": "ñ", "A": "Á", "E": "É", "I": "Í", "O": "Ó", "U": "Ú", "N": "Ñ"}
# A misread euro sign, captions without their word, needless escapes, an ideographic stop between digits
EUROS = [(r"\bAC\s?(\d)", "€$1"), (r"(?m)^(\d{1,3}): ([A-Z])", "Table $1: $2")]
ESCAPES = [(r"\\([~*])", "$1")]
# Empty spans with an id, `- 0[` in reference lists, an open bracket in a word
ANCHORS = [(r'<span\s+id="[^"]*"\s*>\s*</span>\s*', ""), (r"(?m)^- 0\[", "- [")]
BRACKETS = [(r"([A-Za-z])\[([a-z]{1,8})(?=[\s,;:.!?\-/]|$)", "$1$2")]
# Ideographs alone, then two to four, in Latin text, and a misread logo
STRAYS = [(r"(?<=[a-zA-Z\s])[\x{4e00}-\x{9fff}](?=[a-zA-Z\s])", ""), (r"(?<=[a-zA-Z\s])[\x{4e00}-\x{9fff}]{2,4}(?=[a-zA-Z\s])", ""), ("(?i)E[rz]a[fm]y", "")]


def _replaced(text: Column, rules: list[tuple[str, str]]) -> Column:
    for pattern, put in rules:
        text = F.regexp_replace(text, pattern, put)
    return text


def clean_whitespace(text: Column) -> Column:
    """Line ends trimmed of blanks, three or more line ends as two, no blanks at either end."""
    x = F.regexp_replace(text, r"[ \t]+(\n|$)", "$1")
    return F.regexp_replace(F.regexp_replace(x, r"\n{3,}", "\n\n"), r"^\s+|\s+$", "")


def sanitized_comment(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def repaired_extraction(text: Column) -> Column:
    """Control characters, orphan page numbers and number-only headings dropped, capital section words as headings, bullets, exponents, quoted comparisons and compounds repaired."""
    x = _replaced(text, CONTROLS + ORPHANS)
    for h in CAPITAL_HEADINGS:
        x = F.regexp_replace(x, rf"(?m)^{h}\s*$", f"## {h.title()}")
    x = _replaced(x, EXPONENTS)
    for c in COMPOUNDS:
        merged = c.replace("-", "")
        x = F.replace(F.replace(x, F.lit(merged), F.lit(c)), F.lit(merged.title()), F.lit(c.title()))
    return F.regexp_replace(x, r"\n{4,}", "\n\n\n")


def decoded_fonts(text: Column) -> Column:
    """Glyph codes by the table, longest first; unknown ones are bullets, GLYPH(...) goes."""
    x = F.regexp_replace(text, r"GLYPH\([^)]*\)", "")
    for code, glyph in sorted(FONT_CODES.items(), key=lambda kv: (-len(kv[0]), kv[0])):
        x = F.replace(x, F.lit(code), F.lit(glyph))
    return F.regexp_replace(x, r"/C[0-9]{1,3}", "•")


def expanded_ligatures(text: Column) -> Column:
    for lig, plain in LIGATURES.items():
        text = F.replace(text, F.lit(lig), F.lit(plain))
    return text


def hyphenated(text: Column, compounds: list[str] | None = None) -> Column:
    """Whole merged words get their hyphens back: lower case, capitalised or all capitals."""
    for c in compounds or DOMAIN_COMPOUNDS:
        for form in (c, c[0].upper() + c[1:], c.upper()):
            text = F.regexp_replace(text, rf"\b{form.replace('-', '')}\b", form)
    return text


def caption_type(caption: Column) -> Column:
    low, out = F.lower(caption), None
    for word, kind in CAPTION_TYPES.items():
        out = F.when(low.contains(word), kind) if out is None else out.when(low.contains(word), kind)
    return out


def repaired_glyphs(text: Column) -> Column:
    """Glyph codes decoded; then thorns and eths as plus signs and brackets, spaced quarters as equals, where their neighbours say so, and `- 0[n]` as `- [n]`."""
    return _replaced(decoded_fonts(text), GLYPH_CONTEXTS)


def repaired_encoding(text: Column) -> Column:
    """Thorns as plus signs, a quarter between blanks or alone in a cell as equals, Cyrillic capitals as the Latin ones that they look like, a letter and an acute within a word as one."""
    x = F.translate(_replaced(F.translate(text, "þÞ", "++"), QUARTERS), *CONFUSABLES)
    for plain, acute in ACUTES.items():
        x = F.regexp_replace(x, rf"(?U){plain}´(?=\w)", acute)
    return x


def closed_ligature_brackets(text: Column) -> Column:
    """`f[i` in a word whose bracket stays open becomes `fi`."""
    return _replaced(text, BRACKETS)


def without_anchors(text: Column) -> Column:
    """No empty spans with an id, and `- 0[` of reference lists as `- [`."""
    return _replaced(text, ANCHORS)


def without_stray_cjk(text: Column) -> Column:
    """No ideograph alone, then none of two to four, between Latin letters or blanks; and no misread logo word."""
    return _replaced(text, STRAYS)


GARBLED = "[OCR garbled — refer to source document]\n"  # fixed value: the warning before a garbled paragraph


def warned_paragraphs(text: Column) -> Column:
    """A warning before each paragraph of five words or more of which over 30 % look garbled: digits within letters, or over eight characters and no vowel."""
    garbled = lambda w: w.rlike(r"[a-zA-Z]{2,}\d+[a-zA-Z]") | ((F.length(w) > 8) & ~w.rlike("[aeiouAEIOU]"))

    def one(p: Column) -> Column:
        n = F.size(words(p))
        return F.when((n >= 5) & (F.size(F.filter(words(p), garbled)) > 0.3 * n), F.concat(F.lit(GARBLED), p)).otherwise(p)

    return F.array_join(F.transform(F.split(text, "\n\n"), one), "\n\n")


# LaTeX accents and what they stand for
ACCENTS = {"\\'e": "é", "\\'a": "á", "\\'i": "í", "\\'o": "ó", "\\'u": "ú", "\\'E": "É", "\\`e": "è", "\\`a": "à", '\\"o': "ö", '\\"u': "ü", '\\"a': "ä", "\\~n": "ñ"}


def accented(text: Column) -> Column:
    """LaTeX accents as letters, and `'ee` and `'e` at a word's end as é."""
    for tex, letter in ACCENTS.items():
        text = F.replace(text, F.lit(tex), F.lit(letter))
    return F.regexp_replace(F.regexp_replace(text, r"(?U)(\w)'ee\b", "$1ée"), r"(?U)(\w)'e\b", "$1é")


def post_processed(md: Column) -> Column:
    """All repairs of extracted Markdown, in their order."""
    x = warned_paragraphs(without_stray_cjk(plain_headings(md)))
    x = _replaced(accented(_replaced(x, EUROS)), ESCAPES)
    return F.regexp_replace(x, r"(?<=[0-9])。(?=\s*[0-9])", ".")


def plain_headings(text: Column) -> Column:
    """No bold marks in heading lines."""
    return F.array_join(F.transform(F.split(text, "\n"), lambda l: F.when(l.rlike(r"^#{1,6}\s"), F.replace(l, F.lit("**"), F.lit(""))).otherwise(l)), "\n")


def repaired_markdown(text: Column) -> Column:
    """`AC 9` as euro, `NN: X` as a table caption, needless escapes and an ideographic stop between digits."""
    return F.regexp_replace(_replaced(text, EUROS + ESCAPES), "([0-9])。([0-9])", "$1.$2")


def case_split(token: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(token, "([a-z])([A-Z])", "$1 $2"), "([0-9])([A-Za-z])", "$1 $2")


def words(text: Column) -> Column:
    """Runs of characters other than white space."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"\s+"), lambda w: w != "")


def size_label(n: Column) -> Column:
    one = lambda v: F.format_string("%.1f", v)
    return F.when(n < 1024, F.concat(n.cast("string"), F.lit(" bytes"))).when(n < 1048576, F.concat(one(n / 1024), F.lit(" KB"))).otherwise(F.concat(one(n / 1048576), F.lit(" MB")))


def slug(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(F.left(text, F.lit(50))), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def content_key(content: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(content, 256))
