"""Words that extraction ran together, split again, and words that it split, joined again, by a dictionary with counts; and the repair of a whole text.

As in `rejoin`, these scan from left to right and consume tokens: they are Arrow-batched UDFs."""

from __future__ import annotations

import math
import re
from collections.abc import Callable
from functools import lru_cache

import pandas as pd
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from inkstrata.functions import lines as L
from inkstrata.functions import text as X
from inkstrata.functions.rejoin import rejoined_text

MOST_WORDS = 2_000_000  # of a dictionary: it travels with each task
LONGEST = 24  # characters of a word that segmentation tries

# First and last parts of compounds that keep their hyphen
PREFIXES = ["pre", "post", "non", "sub", "semi", "anti", "auto", "bi", "co", "counter", "cross", "de", "dis", "ex", "extra", "hyper", "hypo", "in", "inter", "intra", "macro", "micro", "mid", "mini", "mis", "mono", "multi", "neo", "out", "over", "para", "poly", "pseudo", "quasi", "re", "self", "super", "trans", "tri", "ultra", "un", "under", "uni", "well", "cardio", "chemo", "electro", "gastro", "histo", "immuno", "neuro", "onco", "patho", "pharma", "physio", "psycho", "radio", "thermo"]
SUFFIXES = ["based", "related", "adjusted", "specific", "free", "like", "dependent", "independent", "weighted", "matched", "paired", "derived", "induced", "mediated", "resistant"]
# Digits and letters that belong together
DIGIT_NAMES = ["2D", "3D", "4D", "5HT", "3TC", "2nd", "3rd", "4th", "5th", "6th", "7th", "8th", "9th", "5FU", "6MP"]
# Words known to be split, joined whatever the dictionary says
SPLIT_WORDS = ["weibull", "gompertz", "sculpher", "fenwick", "tuffaha", "scuffham", "winfree", "taipale", "sideris", "dearden", "goldstraw", "barsouk", "blandin", "hammerman", "chansky", "hoomans", "ginnelly", "bindels", "longworth", "hakkaart", "eggington", "chaboyer", "garside", "kirkham", "trowman", "sharples", "kantoff", "conaway", "tannock", "hussain", "posnett", "sashegyi", "andreas", "modeling", "modelling", "biostatistics", "abstract"]
# Words that are no pieces of a name when all of a window's are among them
COMMON_WORDS = ["a", "an", "and", "are", "as", "at", "be", "but", "by", "can", "did", "do", "for", "from", "get", "got", "had", "has", "have", "he", "her", "him", "his", "how", "i", "if", "in", "into", "is", "it", "its", "let", "may", "me", "my", "no", "nor", "not", "of", "on", "or", "our", "out", "own", "per", "put", "ran", "run", "say", "set", "she", "so", "the", "to", "too", "up", "us", "use", "via", "was", "way", "we", "who", "why", "yet", "you"]
# Particles and titles that stand before names
PARTICLES = ["de", "del", "della", "van", "von", "el", "al", "la", "le", "di", "da", "du", "das", "dos", "den", "der", "het", "des", "st", "dr", "mr", "ms", "jr", "sr", "mc"]
# What ends and begins a word; a spaced heading in capitals; an operator or digits within a word; punctuation before a capital
CLOSING, OPENING = ".,;:!?)]'\"", "([\"'"
SPACED_HEADING = r"(?m)^(#{1,6}\s+)?([A-Z](?:\s+[A-Z]){3,}(?:\s+[A-Z]+)*)\s*$"
OPERATOR, DIGITS, BEFORE_CAPITAL = r"([A-Za-z]+)([+&=])([A-Za-z]{2,})", r"(\d+(?:\.\d+)?)([a-zA-Z]{3,})", r"(?<=[a-zA-Z])([.,;:])(?=[A-Z])"
# The heading of references, headings after them, and how an entry begins
REFERENCES = r"(?i)(?:^|\n)(?:#{1,6}\s+)?(?:References?|Bibliography)\s*\n"
AFTER_REFERENCES = r"(?im)^#{1,6}\s+(?:Appendix|Supplementary|Supporting\s+Information|Acknowledgements?|Acknowledgments?|Author\s+Contributions?|Conflicts?\s+of\s+Interest|Funding|Declarations?)\b"
ENTRY = r"\[\d+\]|\d{1,3}\.(?=\s)|[A-Z][a-z]+,\s+[A-Z]\."

_TOKEN = regex.compile(r"[\p{L}\p{M}\p{N}_]+(?:['’.:][\p{L}\p{M}\p{N}_]+)*")
_NUMBER = re.compile(r"[\d.:]+")
_HUMP = regex.compile(r"(?<=\p{Ll})(?=\p{Lu})")
_AFTER_CAPITALS = regex.compile(r"(?<=\p{Lu})(\p{Lu})(\p{Ll}+)")


class Lexicon:
    """Words, lower case, with their counts."""

    def __init__(self, counts: dict[str, int]):
        if len(counts) > MOST_WORDS:
            raise ValueError(f"a dictionary of {len(counts)} words; {MOST_WORDS} at most travel with each task")
        self.counts, self.total = counts, max(1, sum(counts.values()))

    def valid(self, word: str) -> bool:
        """Whether all words within are known; punctuation around them and numbers don't matter."""
        low = word.lower()
        if low in self.counts:
            return True
        inner = _TOKEN.findall(low)
        return bool(inner) and all(x in self.counts or _NUMBER.fullmatch(x) for x in inner)

    def one(self, word: str) -> bool:
        """Whether it is one known word, but for punctuation around it."""
        return word.strip(OPENING + CLOSING).lower() in self.counts

    def segments(self, text: str) -> list[str]:
        """The likeliest words of lower-case text, by counts; an unknown word is ten times less likely for each character."""
        text = "".join(c for c in text if c.isalnum())
        best: list[tuple[float, int]] = [(0.0, 0)]
        for end in range(1, len(text) + 1):
            tries = []
            for start in range(max(0, end - LONGEST), end):
                n = self.counts.get(text[start:end], 0)
                tries.append((best[start][0] + math.log10(n / self.total if n else 10 / self.total / 10 ** (end - start)), start))
            best.append(max(tries, key=lambda t: (t[0], -t[1])))
        out, end = [], len(text)
        while end:
            out.append(text[best[end][1] : end])
            end = best[end][1]
        return out[::-1]

    def words_in(self, token: str) -> list[str]:
        """The words of a token of five characters or more, with its capitals, if all are known and none but a and i is one letter; else the token."""
        found = self.segments(token.lower()) if len(token) >= 5 else []
        if len(found) < 2 or not all(self.valid(w) and (len(w) > 1 or w in "ai") for w in found):
            return [token]
        at, out = 0, []
        for w in found:
            own = token[at : at + len(w)]
            out.append(own if own.lower() == w else w)
            at += len(w)
        return out


# ---- words that ran together --------------------------------------------------------------------------


def case_parts(token: str, words: Lexicon) -> list[str]:
    """A token cut before a capital that follows a small letter, and where capitals end: before the last of them, or behind it where it belongs
    to an acronym (a short rest, a doubled letter, or small letters that are a word only by themselves)."""
    if len(token) < 3:
        return [token]
    out = []
    for hump in _HUMP.sub("\n", token).split("\n"):
        start = 0
        for m in _AFTER_CAPITALS.finditer(hump):
            last, low = m.groups()
            acronym = m.start() - start < 3 or low[0] == last.lower() or (len(low) >= 3 and words.valid(low) and not words.valid(last + low))
            cut = m.start() + acronym
            out.append(hump[start:cut])
            start = cut
        out.append(hump[start:])
    return out


def token_parts(token: str, words: Lexicon) -> list[str]:
    """The words that a token without outer punctuation holds; the token alone if none are found."""
    if len(token) < 4 or words.valid(token):
        return [token]

    def known(p: str) -> bool:
        return words.valid(p) or (p.isupper() and len(p) <= 6)

    by_case = case_parts(token, words)
    if len(by_case) > 1:
        one_case = lambda p: p.islower() or (p[0].isupper() and p[1:].islower())
        full = [w for p in by_case for w in (words.words_in(p) if not known(p) and one_case(p) else [p])]
        if len(full) > len(by_case) or all(map(known, by_case)):
            return full
    if re.search("[,;]", token):
        full = _each(re.findall("[^,;]*[,;]|[^,;]+", token), ",;", words, 4)
        if len(full) > 1:
            return full
    return words.words_in(token)


def _each(pieces: list[str], marks: str, words: Lexicon, least: int) -> list[str]:
    """The parts of each piece, marks at its end kept on the last."""
    out = []
    for piece in pieces:
        bare = piece.rstrip(marks)
        parts = token_parts(bare, words) if len(bare) >= least else [bare]
        out += parts[:-1] + [parts[-1] + piece[len(bare) :]]
    return out


def _behind_operator(right: str, words: Lexicon) -> str:
    if len(right) < 4 or words.valid(right):
        return right
    cuts = [f"{right[:i]} {right[i:]}" for i in range(2, len(right) - 1) if right[0].isupper() and words.valid(right[:i]) and words.valid(right[i:])]
    found = words.segments(right.lower())
    return cuts[0] if cuts else " ".join(found) if len(found) > 1 and all(map(words.valid, found)) else right


def split_word(word: str, words: Lexicon) -> str | None:
    """What stands for a word between blanks; None to leave it."""
    if words.valid(word) or "\x00" in word:
        return None
    linked = [p for p in word.split("-") if p]
    if len(linked) > 1:
        first, last = words.valid(linked[0]), words.valid(linked[-1])
        if (linked[0].lower() in PREFIXES and last) or (linked[-1].lower() in SUFFIXES and first) or all(map(words.valid, linked)):
            return None
    end = word[-1] if word[-1] in CLOSING else ""
    if m := re.fullmatch(OPERATOR, word.removesuffix(end) if end else word):
        return m[1] + m[2] + _behind_operator(m[3], words) + end
    if (m := re.fullmatch(DIGITS, word)) and word not in DIGIT_NAMES and words.valid(m[2]):
        return f"{m[1]}{' ' if '.' in m[1] else '-'}{m[2]}"
    bare = word.rstrip(CLOSING)
    trail = word[len(bare) :]
    lead = bare[: len(bare) - len(bare.lstrip(OPENING))]
    bare = bare[len(lead) :]
    if len(bare) < 4 or words.valid(bare):
        return None
    pieces = re.sub(BEFORE_CAPITAL, r"\1\n", bare).split("\n")
    parts = _each(pieces, CLOSING, words, 1) if len(pieces) > 1 else token_parts(bare, words)
    return lead + " ".join(parts) + trail if len(parts) > 1 else None


def _by_line(text: str, edit: Callable[[list[str]], list[str] | None]) -> str:
    """Each line with its tokens edited, one blank between them; lines without an edit keep their blanks."""
    out = []
    for line in text.splitlines(True):
        new = edit(line.split())
        out.append(line if new is None else line[: len(line) - len(line.lstrip())] + " ".join(new) + ("\n" if line.endswith("\n") else ""))
    return "".join(out)


def split_text(text: str, split: Callable[[str], str | None]) -> str:
    def edit(tokens: list[str]) -> list[str] | None:
        new = [split(t) for t in tokens]
        return None if all(n is None for n in new) else [t if n is None else n for t, n in zip(tokens, new)]

    return _by_line(text, edit)


# ---- words that were split -----------------------------------------------------------------------------


def _whole(run: list[str], words: Lexicon) -> str | None:
    """The word that a window of tokens makes: one known to be split; a name, begun by a capital, with a piece that is no word or has two
    letters at most; a word of the dictionary, of which a piece is none or has three letters at most."""
    if not all(any(c.isalnum() for c in t) and "\x00" not in t for t in run):
        return None
    end = run[-1][-1] if run[-1][-1] in CLOSING else ""
    pieces = [*run[:-1], run[-1].removesuffix(end) if end else run[-1]]
    made, low = "".join(pieces), [p.lower() for p in pieces]
    if len(made) < 5:
        return None
    shortest, broken = min(map(len, pieces)), not all(map(words.valid, pieces))
    name = pieces[0][0].isupper() and (broken or shortest <= 2) and not all(p in COMMON_WORDS for p in low) and not any(p in PARTICLES for p in low)
    if made.lower() in SPLIT_WORDS or name or ((broken or shortest <= 3) and words.one(made)):
        return made + end
    return None


def merged_text(text: str, words: Lexicon) -> str:
    def heading(m: re.Match) -> str:
        made = m[2].replace(" ", "")
        return m[0] if len(made) < 5 and all(len(p) == 1 for p in m[2].split()) else (m[1] or "") + made

    def edit(tokens: list[str]) -> list[str] | None:
        out, at = [], 0
        while at < len(tokens):
            sizes = (size for size in (3, 2) if at + size <= len(tokens))
            size, made = next(((s, w) for s in sizes if (w := _whole(tokens[at : at + s], words))), (1, tokens[at]))
            out.append(made)
            at += size
        return out if len(out) < len(tokens) else None

    return _by_line(re.sub(SPACED_HEADING, heading, text), edit)


# ---- whole texts --------------------------------------------------------------------------------------


def hyphenated_text(text: str) -> str:
    """Domain compounds that lost their hyphen, in capitals, with a capital or else lower case."""
    whole = _compounds()

    def put(m: re.Match) -> str:
        full = whole[1][m[0].lower()]
        return full.upper() if m[0].isupper() else full[0].upper() + full[1:] if m[0][0].isupper() else full

    return whole[0].sub(put, text)


@lru_cache(1)
def _compounds() -> tuple[re.Pattern, dict[str, str]]:
    plain = {c.replace("-", ""): c for c in X.DOMAIN_COMPOUNDS}
    return re.compile(rf"(?i)\b({'|'.join(sorted(plain, key=len, reverse=True))})\b"), plain


def tidied_references(text: str) -> str:
    """After the first heading of references, up to a heading that follows them: no heading marks, and lines joined to the entry that they continue; an empty line ends an entry."""
    head = re.search(REFERENCES, text)
    if not head:
        return text
    after = re.compile(AFTER_REFERENCES).search(text[head.end() :])
    end = head.end() + after.start() if after else len(text)
    out, in_entry = [], False
    for line in text[head.end() : end].split("\n"):
        line = re.sub(r"^#{2,6}\s+(?=.)", "", line.strip())
        new = bool(re.match(ENTRY, line))
        if line and in_entry and not new:
            out[-1] += " " + line
        else:
            out.append(line)
            in_entry = new
    return text[: head.end()] + "\n".join(out) + text[end:]


def repaired_words_text(text: str, words: Lexicon, split: Callable[[str], str | None]) -> str:
    """The word repairs in order, outside code, comments and addresses: ligatures, split words, compounds, words that ran together; then references."""
    zones: list[str] = []

    def hidden(m: re.Match) -> str:
        zones.append(m[0])
        return f"\x00{len(zones) - 1}\x00"

    text = re.sub(rf"{L.ZONES}|\x00+", hidden, text)  # a NUL of the text's own is a zone, too
    for ligature, plain in X.LIGATURES.items():
        text = text.replace(ligature, plain)
    text = hyphenated_text(merged_text(rejoined_text(text, words.one), words))
    text = split_text(text, split)
    return tidied_references(re.sub("\x00(\\d+)\x00", lambda m: zones[int(m[1])], text))


def _udf(text: Column, counts: dict[str, int], repair: Callable[[str, Lexicon, Callable], str]) -> Column:
    words = Lexicon(counts)

    @F.pandas_udf(StringType())
    def run(x: pd.Series) -> pd.Series:
        split = lru_cache(65_536)(lambda w: split_word(w, words))
        return pd.Series([None if t is None else repair(t, words, split) for t in x], dtype=object)

    return run(text)


def split_run_togethers(text: Column, counts: dict[str, int]) -> Column:
    """text with words that ran together split: at operators, between digits and letters, at punctuation before capitals, at changes of case, and by the
    dictionary. Compounds with hyphens whose parts are words stay. A token that the dictionary splits keeps letters and digits only. counts: lower-case words
    and their counts, MOST_WORDS at most. Null stays null."""
    return _udf(text, counts, lambda t, words, split: split_text(t, split))


def merge_space_splits(text: Column, counts: dict[str, int]) -> Column:
    """text with windows of three or two tokens joined that make one word or a name, and headings in spaced capitals closed. Tokens
    without a letter or digit are never joined. Null stays null."""
    return _udf(text, counts, lambda t, words, split: merged_text(t, words))


def repaired_references(text: Column) -> Column:
    """text with the entries of its references on a line each. Null stays null."""
    return _udf(text, {}, lambda t, words, split: tidied_references(t))


def repaired_words(text: Column, counts: dict[str, int]) -> Column:
    """All word repairs, in order; see repaired_words_text. Null stays null."""
    return _udf(text, counts, repaired_words_text)
