"""Licence scans: winnowed fingerprints of templates, then banded alignment."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from inkstrata.llm.license_texts import TEMPLATES
from inkstrata.llm.vector import ngram_hashes, slices, word_hashes, word_spans

GRAM = 3  # words of a hashed k-gram
SPAN = 2  # k-grams of a window: any GRAM + SPAN - 1 = 4 equal words in a row share a fingerprint
BAND = 8  # words that an occurrence may have more or less than its template, at any point
COVERAGE = 0.8

_BREAKS = np.ones(256, bool)
_BREAKS[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False


def _hashes(text: str) -> np.ndarray:
    data = np.frombuffer(text.encode(), np.uint8)
    starts, ends, _ = word_spans(data, np.array([0, len(data)]), _BREAKS)
    return word_hashes(data, starts, ends)


def winnow(grams: np.ndarray) -> np.ndarray:
    """Places of the least hash of each SPAN consecutive k-grams (of equal ones the first)."""
    if len(grams) <= SPAN:
        return np.arange(len(grams))
    windows = np.lib.stride_tricks.sliding_window_view(grams, SPAN)
    return np.unique(windows.argmin(axis=1) + np.arange(len(windows)))


@lru_cache(4)
def _index(templates: tuple[tuple[str, str], ...]) -> tuple:
    """The inverted index: sorted fingerprints, and each one's template and place in it. Templates index all k-grams,
    so that the fingerprints that a document selects are found whatever stands around an occurrence."""
    words = [_hashes(t) for _, t in templates]
    rows = [(g, k, p) for k, w in enumerate(words) for p, g in enumerate(ngram_hashes(w, GRAM).tolist())]
    rows.sort()
    return words, np.array([r[0] for r in rows], np.uint64), np.array([r[1] for r in rows]), np.array([r[2] for r in rows])


def align(template: np.ndarray, text: np.ndarray, band: int = BAND) -> tuple[int, int, int]:
    """(matched words, first, end) of the best alignment of the whole template within text, where the template's place i meets
    text places i .. i + 2 * band only. Most matches win, then the shortest span, then the first."""
    m, width = len(template), 2 * band + 1
    # cell [d]: best (matches, -first place, ...) with template[:i] used and text place i + d next
    none = (-1, 0)
    row = [(0, -d) for d in range(width)]  # leading text is free
    for i in range(m):
        new = [none] * width
        for d in range(width):
            at = i + d
            best = none
            n, first = row[d]
            if at < len(text) and n >= 0:
                best = (n + 1, first) if text[at] == template[i] else (n, first)
            if d + 1 < width and row[d + 1] > best:  # the template's word is missing in the text
                best = row[d + 1]
            if d and new[d - 1] > best:  # a word of the text is extra
                best = new[d - 1]
            new[d] = best
        row = new
    n, first = max(row)
    d = row.index((n, first))
    return n, -first, min(len(text), m + d)


def _needed(m: int) -> int:
    """The least count of matched words that is enough coverage of m."""
    return next(n for n in range(m + 1) if n >= COVERAGE * m)


def _counted(words: np.ndarray, template: np.ndarray) -> np.ndarray:
    """Places of the template's words from which enough of its words stand within its length and BAND: where an occurrence
    may start, however its matched words are scattered."""
    there = np.isin(words, template)
    total = np.r_[0, np.cumsum(there)]
    at = np.flatnonzero(there)
    return at[total[np.minimum(at + len(template) + BAND, len(words))] - total[at] >= _needed(len(template))]


def _occurrences(words: np.ndarray, template: np.ndarray, places: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """(matched, first, end) of occurrences of a template in one text that don't overlap. places: (begin, place), where the
    template would start and a place of the text that proposes it. The best alignments are taken first; places outside of them
    are aligned anew with the text that is left, as two occurrences may lie within one band."""
    m, spans, known = len(template), [], {}
    for b in sorted({b for b, _ in places}):
        if 0 <= b <= len(words) - m and np.array_equal(words[b : b + m], template) and all(b >= y for _, _, y in spans):
            spans.append((m, b, b + m))
    while True:
        places = [p for p in places if not any(x <= p[1] < y for _, x, y in spans)]
        found = set()
        for b, at in places:
            left = max([0, b - BAND, *(y for _, _, y in spans if y <= at)])
            right = min([len(words), b + m + BAND, *(x for _, x, _ in spans if x > at)])
            key = (b, left, right)
            if key not in known:
                known[key] = None
                region, before = words[left:right], left - (b - BAND)
                if np.isin(template, region).sum() >= COVERAGE * m:
                    n, x, y = align(template, np.r_[np.zeros(before, np.uint64), region])  # no word's hash is 0
                    if n >= COVERAGE * m:
                        known[key] = (n, left + max(x - before, 0), left + y - before)
            if known[key]:
                found.add(known[key])
        if not found:
            return sorted(spans, key=lambda r: r[1])
        for row in sorted(found, key=lambda r: (-r[0], r[2] - r[1], r[1])):
            if all(row[2] <= x or row[1] >= y for _, x, y in spans):  # overlapping alignments of one occurrence
                spans.append(row)


def scan_words(words: np.ndarray, first: np.ndarray, templates: tuple) -> list[tuple[int, int, int, int, int]]:
    """(text, template, matched, first word, end word) of occurrences with enough coverage; words of several texts, first as in word_spans()."""
    own, fps, of, places = _index(templates)
    grams = ngram_hashes(words, GRAM)
    proposed: dict[tuple[int, int], set] = {}
    if len(grams):
        at = winnow(grams)
        text = np.searchsorted(first, at, "right") - 1
        at = at[at + GRAM <= first[text + 1]]
        lo, hi = np.searchsorted(fps, grams[at], "left"), np.searchsorted(fps, grams[at], "right")
        hit = np.flatnonzero(hi > lo)
        for p, a, b in zip(at[hit].tolist(), lo[hit].tolist(), hi[hit].tolist()):
            t = int(np.searchsorted(first, p, "right")) - 1
            for k in range(a, b):
                proposed.setdefault((t, int(of[k])), set()).add((p - int(places[k]) - int(first[t]), p - int(first[t])))
    for which, template in enumerate(own):
        if len(template) - _needed(len(template)) <= BAND:  # shorter runs than the fingerprints' may be all that matches
            at = _counted(words, template)
            for p, t in zip(at.tolist(), (np.searchsorted(first, at, "right") - 1).tolist()):
                proposed.setdefault((t, which), set()).add((p - int(first[t]), p - int(first[t])))
    return [(t, which, *row) for (t, which), at in sorted(proposed.items()) for row in _occurrences(words[first[t] : first[t + 1]], own[which], sorted(at))]


_SCHEMA = pa.schema([("doc_id", pa.int64()), ("license", pa.string()), ("matched", pa.int64()), ("template_words", pa.int64()), ("coverage", pa.float64()), ("first_word", pa.int64()), ("end_word", pa.int64()), ("first_byte", pa.int64()), ("end_byte", pa.int64())])
_DDL = "doc_id long, license string, matched long, template_words long, coverage double, first_word long, end_word long, first_byte long, end_byte long"


def scan_licenses(docs: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """A row for each occurrence of a template in docs (doc_id, text): doc_id, license, matched, template_words,
    coverage, first_word, end_word, first_byte, end_byte (ends exclusive, bytes of the UTF-8 text).

    Words are runs of digits, letters (A-Z lower-cased) and non-ASCII characters. Documents select winnowed k-grams; those
    that the inverted index of the templates has propose places, and for templates that coverage allows to lack BAND words at most
    so does every place from which enough of their words stand close together; there the template is aligned with the text within
    BAND words, and occurrences that match at least COVERAGE of its words are reported, the best one of
    overlapping alignments of one template. Different templates may overlap. Templates have GRAM + SPAN - 1 words or more.

    Texts without words and null texts have no rows; repeated rows report each; rows with a null doc_id report null. Documents are scanned
    where they are read, without a shuffle. An empty table gives an empty result; further columns are ignored."""
    chosen = tuple(sorted((templates or TEMPLATES).items()))
    sizes = [len(_hashes(t)) for _, t in chosen]
    if min(sizes) < GRAM + SPAN - 1:
        raise ValueError(f"a template needs {GRAM + SPAN - 1} words")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, _, data, offsets in slices(batch.column("text")):
                starts, ends, first = word_spans(data, offsets, _BREAKS)
                words = word_hashes(data, starts, ends)
                rows = []
                for t, k, n, x, y in scan_words(words, first, chosen):
                    a, b = starts[first[t] + x] - offsets[t], ends[first[t] + y - 1] - offsets[t]
                    rows.append((batch.column("doc_id")[i + t].as_py(), chosen[k][0], n, sizes[k], n / sizes[k], x, y, int(a), int(b)))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _SCHEMA)], schema=_SCHEMA)

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(run, _DDL)
