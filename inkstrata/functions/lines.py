"""Repairs that look at escapes and neighbouring lines: each works within its row, so no text is shuffled."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from inkstrata.functions.text import expanded_ligatures, words

#: A heading of level 2 to 6 and its text.
HEADING = r"^(#{2,6})\s+(.+)$"
# Words that begin a sentence
SENTENCE_STARTS = ["Provide", "Please", "The ", "A ", "An ", "This ", "These ", "Those ", "If ", "When ", "Where ", "For ", "In ", "On ", "At ", "To ", "From "]
# Signs that an extractor reads wrongly: pattern and replacement, in order
SIGNS = [
    (r"(CrI[\s:])2(\d+\.\d+)", "$1-$2"),
    (r"(CI[\s:])2(\d+\.\d+)", "$1-$2"),
    (r"(to\s)2(\d+\.\d+)", "$1-$2"),
    (r",\s*2(0\.\d+)", ", -$1"),
    (r"([Pp])\s*\\\s*(0\.\d+)", "$1 < $2"),
    (r"(\s)\.(\d+)\s+(y(?:ear|r)s?|months?|days?|weeks?)", "$1>$2 $3"),
    (r"(\d)\s+1\s+(exp|log|sqrt)\s*\(", "$1 + $2("),
    (r"\bn\s*-\s*(\d{2,})\b", "n = $1"),
    (r"([Pp])\s*-\s*(0\.\d+)", "$1 = $2"),
]
# Headings that aren't: captions, bare numbers, statistics
NO_HEADING = [r"(?i)^(figure|table|fig\.|tab\.)\s*\d", r"^[\d\s.,\-+%()]+$", r"^p\s*[<>=]", r"^N\s*=\s*\d+", r"^\(\d+"]
CAPTION = r"^\s*(?:\*\*)?(?:Figure|Fig\.)\s+\d+"


def _edited(text: Column, edit) -> Column:
    """text with each line replaced by edit(lines, line, index)."""
    lines = F.split(text, "\n")
    return F.array_join(F.transform(lines, lambda line, i: edit(lines, line, i)), "\n")


def repaired_signs(text: Column) -> Column:
    """Minus read as 2, less-than read as a backslash and the like, in statistical contexts."""
    for pattern, put in SIGNS:
        text = F.regexp_replace(text, pattern, put)
    return text


def decoded_escapes(text: Column) -> Column:
    """`/uniXXXX` as its character, ligatures spelled out; surrogates stay as they are and replacement characters go."""

    def decoded(piece: Column) -> Column:
        code = F.upper(F.substring(piece, 5, 4))
        known = piece.rlike("^/uni[0-9A-Fa-f]{4}") & ~code.rlike("^D[89A-F]")
        char = F.decode(F.unhex(F.when(known, code).otherwise("0020")), "UTF-16BE")
        return F.when(known, F.concat(char, F.substring(piece, F.lit(9), F.length(piece)))).otherwise(piece)

    pieces = F.transform(F.split(F.replace(text, F.lit("�"), F.lit("")), "(?=/uni[0-9A-Fa-f]{4})"), decoded)
    return F.replace(expanded_ligatures(F.array_join(pieces, "")), F.lit("�"), F.lit(""))


def single_spaced(text: Column) -> Column:
    """Runs of blanks as one, but for indents, a hard break's two blanks, table rows, comments and fenced code."""

    def one(line: Column) -> Column:
        indent = F.regexp_extract(line, r"^\s*", 0)
        rest = F.substring(line, F.length(indent) + 1, F.length(line))
        hard = rest.endswith("  ")
        body = F.regexp_replace(F.when(hard, F.left(rest, F.length(rest) - 2)).otherwise(rest), r"[ \t]{2,}", " ")
        return F.when(line.rlike(r"^\s*(```|\||<!--)"), line).otherwise(F.concat(indent, body, F.when(hard, "  ").otherwise("")))

    # a line before the text, so that segment 0 is never a fence: odd segments are code
    segments = F.split(F.concat(F.lit("x\n"), text), r"(?=\n[ \t]*```)")
    done = F.transform(segments, lambda s, i: F.when(i % 2 == 1, s).otherwise(F.array_join(F.transform(F.split(s, "\n"), one), "\n")))
    return F.substring(F.array_join(done, ""), F.lit(3), F.length(text))


def demoted_headings(text: Column) -> Column:
    """Headings of level 2 to 6 become plain lines if they are too short or long, sentences, captions, numbers or cells, end with
    a period in a document with more than eight headings per 50 filled lines, or closely follow a longer heading."""
    lines = F.split(text, "\n")
    title = lambda line: F.trim(F.regexp_extract(line, HEADING, 2))
    n = F.size(F.filter(lines, lambda x: x.rlike(HEADING)))
    filled = F.size(F.filter(lines, lambda x: F.trim(x) != ""))
    crowded = n > 8 * F.greatest(filled / 50, F.lit(1.0))

    def edit(_, line: Column, i: Column) -> Column:
        t, before, earlier = title(line), F.get(lines, i - 1), F.get(lines, i - 2)
        n_words = F.size(words(t))
        out = (F.length(t) < 3) | (F.length(t) > 200) | (n_words > 12) | t.contains("|") | t.contains("\t") | (crowded & t.endswith("."))
        for pattern in NO_HEADING:
            out = out | t.rlike(pattern)
        out = out | ((n_words >= 5) & t.rlike(f"^({'|'.join(SENTENCE_STARTS)})"))
        near = F.when(before.rlike(HEADING), title(before)).when(earlier.rlike(HEADING), title(earlier))
        out = out | F.coalesce(F.length(t) < F.length(near), F.lit(False))
        return F.when(line.rlike(HEADING) & out, F.regexp_extract(line, HEADING, 2)).otherwise(line)

    return _edited(text, edit)


def lifted_images(text: Column) -> Column:
    """An <img> in a heading goes on a line above it; a heading that was only the image goes."""
    form = r"^(#{1,6}\s+)(.*?)(<img\s[^>]*>)(.*)$"

    def edit(_, line: Column, i: Column) -> Column:
        part = lambda k: F.regexp_extract(line, form, k)
        left = F.trim(F.concat_ws(" ", F.trim(part(2)), F.trim(part(4))))
        return F.when(~line.rlike(form), line).when(left == "", part(3)).otherwise(F.concat(part(3), F.lit("\n\n"), part(1), left))

    return _edited(text, edit)


def captioned_images(text: Column) -> Column:
    """A line `Figure n` becomes a <figcaption> if an image is above it with at most two blank lines between."""
    image = lambda x: x.contains("<img") | x.rlike(r"^\s*!\[")
    blank = lambda x: F.trim(x) == ""

    def edit(lines: Column, line: Column, i: Column) -> Column:
        a, b, c = F.get(lines, i - 1), F.get(lines, i - 2), F.get(lines, i - 3)
        near = F.coalesce(image(a) | (blank(a) & (image(b) | (blank(b) & image(c)))), F.lit(False))
        return F.when(line.rlike(CAPTION) & ~line.contains("<figcaption>") & near, F.concat(F.lit("<figcaption>"), F.trim(line), F.lit("</figcaption>"))).otherwise(line)

    return _edited(text, edit)


def pipe_table(rows: Column) -> Column:
    """rows, an array of arrays of cells, as a pipe table: short rows padded, pipes escaped, line ends as blanks; no rows give ''."""
    n = F.array_max(F.transform(rows, F.size))
    cell = lambda c: F.replace(F.regexp_replace(F.trim(F.coalesce(c, F.lit(""))), "\n", " "), F.lit("|"), F.lit("\\|"))
    row = lambda r: F.concat(F.lit("| "), F.array_join(F.concat(F.transform(r, cell), F.array_repeat(F.lit(""), n - F.size(r))), " | "), F.lit(" |"))
    rule = F.concat(F.lit("| "), F.array_join(F.array_repeat(F.lit("---"), n), " | "), F.lit(" |"))
    drawn = F.transform(rows, row)
    body = F.concat(F.slice(drawn, 1, 1), F.array(rule), F.slice(drawn, 2, F.greatest(F.size(rows) - 1, F.lit(0))))
    return F.when(F.size(rows) == 0, "").otherwise(F.array_join(body, "\n"))


def is_empty_table(rows: Column) -> Column:
    return ~F.exists(rows, lambda r: F.exists(r, lambda c: F.trim(F.coalesce(c, F.lit(""))) != ""))


def relinked_images(text: Column, names: Column, folder: Column) -> Column:
    """Image sources, as <img src="..."> or ![...](...), that names (map of `media/<file>` to a file) holds, moved to folder."""
    pieces = F.split(text, r"(?=<img\b)|(?=!\[)")

    def edit(piece: Column) -> Column:
        out = piece
        for form in (r'(?s)^(<img\b[^>]*\bsrc=")([^"]+)("[^>]*>.*)$', r"(?s)^(!\[[^\]]*\]\()([^)]+)(\).*)$"):
            source = F.regexp_extract(piece, form, 2)
            plain = F.regexp_replace(F.regexp_replace(source, r"^(\.\./)+", ""), r"^(\./)+", "")
            key = F.when(plain.startswith("media/"), plain).otherwise(F.concat(F.lit("media/"), F.regexp_extract(plain, r"[^/]*$", 0)))
            new = F.element_at(names, key)
            out = F.when(piece.rlike(form) & new.isNotNull(), F.concat(F.regexp_extract(piece, form, 1), folder, F.lit("/"), new, F.regexp_extract(piece, form, 3))).otherwise(out)
        return out

    return F.array_join(F.transform(pieces, edit), "")


# What repairs leave alone: fenced code, comments, addresses with and without a scheme
CODE_ZONE, COMMENT_ZONE, URL_ZONE = r"(?s:```.*?```)", r"(?s:<!--.*?-->)", r"https?://\S+"
HOST_ZONES = [r"\b(?!Table\b|Fig\b|Eq\b|Ref\b)\w+\.\w{2,4}/\S+", r"\b\w+\.(?:com|org|net|edu|gov|io|uk|de|no|eu|se|dk|nl|fr|ch|at|es|it)\b"]
ZONES = "|".join([CODE_ZONE, COMMENT_ZONE, URL_ZONE, *HOST_ZONES])


def outside_zones(text: Column, edit) -> Column:
    """text with edit (Column to Column) applied to each stretch between protected zones, which stay as they are; of
    zones that overlap the first protects. Null stays null."""
    kept = F.regexp_extract_all(text, F.lit(ZONES), F.lit(0))
    between = F.transform(F.split(text, ZONES, -1), edit)
    return F.array_join(F.transform(between, lambda s, i: F.concat(s, F.coalesce(F.get(kept, i), F.lit("")))), "")


# Blanks that an extractor puts into contractions, compounds, punctuation and percentages: pattern and replacement, in order
SPACINGS = [
    (r"([\p{L}\p{N}_])\s+['’‘ʼ]\s+(t|s|re|ve|ll|d|m|T|S|RE|VE|LL|D|M)\b", "$1'$2"),
    (r"([a-z]+)\s+-\s+([a-z]+)", "$1-$2"),
    (r"\s+([.,;:!?)])", "$1"),
    (r"([(\[])\s+", "$1"),
    (r"(\d+)\s+%", "$1%"),
]


def closed_spacing(text: Column) -> Column:
    """Blanks inside contractions, lower-case compounds, before closing and after opening punctuation and before % go."""
    for pattern, put in SPACINGS:
        text = F.regexp_replace(text, pattern, put)
    return text


def joined_hyphen_breaks(text: Column) -> Column:
    """A line end after a hyphen inside a word goes; the hyphen stays."""
    return F.regexp_replace(text, r"(?<=[\p{L}\p{N}_])-\s*\n\s*(?=[\p{L}\p{N}_])", "-")
