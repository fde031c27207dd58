"""Language identification by cross-parsing entropy."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from inkstrata.llm import workers
from inkstrata.llm.vector import slices

SAMPLE_ROWS = 30  # labelled rows for each language that the model is fitted on
PASSAGE = 1_000  # characters of each, from a place drawn by the row's hash; shorter texts whole
LANGUAGES = 400  # labels that are learned at most, those with most rows
BLOCK = 1024  # bytes of a text that are parsed side by side with others
UNDETERMINED = "und"


@lru_cache(1)
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """For each code point: its lower-case form if that is one code point, and whether it is a letter."""
    low = np.arange(0x110000, dtype=np.uint32)
    letter = np.zeros(0x110000, bool)
    for c in (*range(0xD800), *range(0xE000, 0x110000)):
        x = chr(c)
        if x.isalpha():
            letter[c] = True
            y = x.lower()
            if len(y) == 1:
                low[c] = ord(y)
    return low, letter


def _letters(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """UTF-8 of the lower-cased letters of all texts, with runs of other characters as one space; each text's bytes and letters."""
    low, letter = _tables()
    lens = np.fromiter(map(len, texts), np.int64, len(texts))
    x = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    there = letter[x]
    x = np.where(there, low[x], 0x20)
    keep = there.copy()
    keep[1:] |= there[:-1]  # of a run of others, the one after a letter
    ends = np.cumsum(lens)

    def per_text(n: np.ndarray) -> np.ndarray:
        sums = np.r_[0, np.cumsum(n)]
        return sums[ends] - sums[ends - lens]

    size = np.where(keep, 1 + (x >= 0x80) + (x >= 0x800) + (x >= 0x10000), 0)
    data = x[keep].astype("<u4").tobytes().decode("utf-32-le").encode()
    return np.frombuffer(data, np.uint8), per_text(size), per_text(there)


def _automaton(s: bytes) -> list[dict[int, int]]:
    """The transitions of a suffix automaton of s; state 0 is the root."""
    link, length, nxt = [-1], [0], [{}]
    last = 0
    for c in s:
        cur = len(nxt)
        link.append(0)
        length.append(length[last] + 1)
        nxt.append({})
        p = last
        while p >= 0 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p >= 0:
            q = nxt[p][c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                clone = len(nxt)
                link.append(link[q])
                length.append(length[p] + 1)
                nxt.append(dict(nxt[q]))
                while p >= 0 and nxt[p].get(c) == q:
                    nxt[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    return nxt


def _placed(nxt: list[dict[int, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """base, owner and target: state p goes by byte c to target[base[p] + c] if owner[base[p] + c] is p; else nowhere.
    Rows of transitions lie in each other's gaps, so the size follows the transitions and not states times bytes."""
    n = sum(map(len, nxt))
    free = np.ones(2 * n + 2048, bool)
    base = np.zeros(len(nxt), np.int32)
    owner, target = np.full(len(free), -1, np.int32), np.zeros(len(free), np.int32)
    begin, misses = 0, 0  # where rows of several transitions are tried first

    def put(p: int, at: int) -> None:
        base[p] = at
        for c, q in nxt[p].items():
            owner[at + c], target[at + c], free[at + c] = p, q, False

    single = []
    for p in sorted(range(len(nxt)), key=lambda p: (-len(nxt[p]), p)):
        row = sorted(nxt[p])
        if len(row) < 2:
            single.append(p)
            continue
        at = begin
        while True:
            fits = free[at + row[0] : at + row[0] + 512]
            for c in row[1:]:
                fits = fits & free[at + c : at + c + 512]
            found = int(fits.argmax()) if len(fits) else 0
            if len(fits) and fits[found]:
                put(p, at + found)
                break
            at += 512
            if at + 1024 > len(free):
                more = len(free) // 2
                free = np.r_[free, np.ones(more, bool)]
                owner, target = np.r_[owner, np.full(more, -1, np.int32)], np.r_[target, np.zeros(more, np.int32)]
        misses += at > begin
        if misses > 64:  # what lies here is mostly full: single transitions fill the rest
            begin, misses = begin + 512, 0
    gaps = iter(np.flatnonzero(free[256:]) + 256)
    for p in single:
        for c in nxt[p]:
            put(p, int(next(gaps)) - c)
    used = int(np.flatnonzero(owner >= 0)[-1]) + 257 if n else 257
    return base, np.r_[owner, np.full(256, -1, np.int32)][:used], np.r_[target, np.zeros(256, np.int32)][:used]


class Model:
    """Languages and the training text of each; the parsers are built where they are used."""

    def __init__(self, samples: dict[str, list[str]]):
        texts = {k: _letters([" ".join(v)])[0].tobytes() for k, v in samples.items()}
        self.texts = {k: texts[k] for k in sorted(texts) if texts[k]}

    def key(self) -> tuple:
        return tuple(self.texts), tuple(self.texts.values())


class Parser:
    """The greedy cross-parsing of texts by each language's sample: longest phrases that occur in it, one after the other; a byte that the
    sample lacks is a phrase of its own. Linear in the text, and exact: a text's blocks are parsed side by side as if a phrase began with each;
    then each is parsed anew from the phrase that runs into it, up to where both agree."""

    def __init__(self, key: tuple):
        self.langs, texts = key
        bases, owners, targets, roots, states, slots = [], [], [], [], 0, 0
        n = len(texts)
        self.first, self.cost = np.zeros((n, 256), np.int32), np.full((n, 256), 2, np.int32)
        for i, x in enumerate(texts):
            nxt = _automaton(x)
            base, owner, target = _placed(nxt)
            roots.append(states)
            self.first[i] = states
            for c, q in nxt[0].items():
                self.first[i, c], self.cost[i, c] = states + q, 1
            bases.append(base + slots)
            owners.append(np.where(owner >= 0, owner + states, -1))
            targets.append(target + states)
            states, slots = states + len(base), slots + len(owner)
        self.base, self.owner, self.target = (np.concatenate(x).astype(np.int32) for x in (bases, owners, targets))
        self.roots = np.array(roots, np.int32)
        self.logs = np.array([math.log2(len(x) + 2) for x in texts])

    def step(self, lang: np.ndarray, state: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The states after a byte, and how many phrases end."""
        at = self.base[state] + c
        on = self.owner[at] == state
        return np.where(on, self.target[at], self.first[lang, c]), np.where(on, 0, self.cost[lang, c] - (state == self.roots[lang]))

    def phrases(self, data: np.ndarray, lens: np.ndarray) -> np.ndarray:
        """(languages, texts) phrases."""
        n_lang = len(self.roots)
        blocks = np.maximum(1, -(-lens // BLOCK))
        owner = np.repeat(np.arange(len(lens)), blocks)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        starts = np.repeat(np.cumsum(lens) - lens, blocks) + nth * BLOCK
        size = np.minimum(BLOCK, np.repeat(lens, blocks) - nth * BLOCK)
        order = np.argsort(-size, kind="stable")
        lang = np.arange(n_lang)[:, None]
        state = np.repeat(self.roots[:, None], len(owner), axis=1)
        count = np.zeros(state.shape, np.int64)
        active = len(size) - np.searchsorted(np.sort(size), np.arange(size.max() if len(size) else 0), "right")
        begin = starts[order]
        for t, k in enumerate(active.tolist()):
            state[:, :k], ended = self.step(lang, state[:, :k], data[begin[:k] + t][None])
            count[:, :k] += ended
        state[:, order], count[:, order] = state.copy(), count.copy()
        self._joined(data, starts, size, nth, state, count)
        out = np.zeros((n_lang, len(lens)), np.int64)
        last = np.r_[nth[1:] == 0, True] if len(nth) else np.zeros(0, bool)
        count += (state != self.roots[:, None]) & last  # the phrase that runs to the text's end
        for i in range(n_lang):
            out[i] = np.bincount(owner, count[i], len(lens))
        return out

    def _joined(self, data: np.ndarray, starts: np.ndarray, size: np.ndarray, nth: np.ndarray, state: np.ndarray, count: np.ndarray) -> None:
        """Corrects state and count of blocks that begin within a phrase."""
        alone, alone_state = count.copy(), state.copy()
        lang, block = np.nonzero(np.broadcast_to(nth > 0, state.shape))
        while len(block):
            a, b = self.roots[lang], state[lang, block - 1]
            gain, at = np.zeros(len(block), np.int64), 0
            found = []  # (languages, blocks, state at the end, phrases gained)
            while len(block):
                met = a == b
                over = at >= size[block]
                found.append((lang[met], block[met], alone_state[lang[met], block[met]], gain[met]))
                found.append((lang[over & ~met], block[over & ~met], b[over & ~met], gain[over & ~met]))
                go = ~(met | over)
                lang, block, a, b, gain = lang[go], block[go], a[go], b[go], gain[go]
                if len(block):
                    c = data[starts[block] + at]
                    a, x = self.step(lang, a, c)
                    b, y = self.step(lang, b, c)
                    gain, at = gain + y - x, at + 1
            lang, block, end, gain = map(np.concatenate, zip(*found))
            count[lang, block] = alone[lang, block] + gain
            moved = (state[lang, block] != end) & (np.r_[nth, 0][block + 1] > 0)  # what follows begins in another state
            state[lang, block] = end
            lang, block = lang[moved], block[moved] + 1


def predict(texts: list[str | None], model: Model, key: tuple | None = None) -> list[tuple[str, float, float]]:
    """(language, score, bits a byte) of each text: fewest phrases times log2 of the training length wins, by name on ties."""
    key = key or model.key()
    if not key[0]:
        return [(UNDETERMINED, 0.0, 0.0)] * len(texts)
    parser = workers.model(("parser", key), lambda: Parser(key))
    data, lens, letters = _letters([x or "" for x in texts])
    bits = parser.phrases(data, lens) * parser.logs[:, None] / np.maximum(1, lens)
    low = np.sort(bits, axis=0)
    best = bits.argmin(axis=0)
    score = np.ones(len(texts)) if len(low) == 1 else np.maximum(0, 1 - low[0] / np.where(low[1] > 0, low[1], 1))
    return [(key[0][b], float(s), float(x)) if n else (UNDETERMINED, 0.0, 0.0) for n, b, s, x in zip(letters.tolist(), best, score, low[0])]


def _bucket(doc_id):
    return F.pmod(F.crc32(doc_id.cast("string")), F.lit(4))


def fit(docs: DataFrame, *, sample_rows: int = SAMPLE_ROWS, passage: int = PASSAGE, languages: int = LANGUAGES) -> Model:
    """A model from passages of at most `passage` characters of at most sample_rows labelled rows for each of at most `languages` labels, those with most rows.

    Only rows with text, lang and doc_id whose crc32 mod 4 isn't 2 are learned from. Rows are drawn by a hash, those of 200 characters
    or more before others, and so is the place of the passage in a longer text: a language whose texts are all long is learned like any other."""
    rows = docs.filter(F.col("lang").isNotNull() & (F.length("text") > 0) & (_bucket(F.col("doc_id")) != 2)).select("lang", "text", F.xxhash64("doc_id", "text").alias("luck"))
    counts = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(languages)
    some = rows.join(F.broadcast(counts), "lang").filter(F.pmod("luck", F.col("n")) < 8 * sample_rows)  # rows of a label that the window sorts
    start = F.pmod(F.xxhash64("luck"), F.greatest(F.lit(1), F.length("text") - passage + 1)).cast("int") + 1
    some = some.select("lang", "luck", (F.length("text") < 200).alias("short"), F.substring("text", start, F.lit(passage)).alias("said"))
    first = Window.partitionBy("lang").orderBy("short", "luck", "said")
    chosen = some.withColumn("n", F.row_number().over(first)).filter(F.col("n") <= sample_rows).select("lang", "n", "said").collect()  # sample_rows * languages passages
    samples: dict[str, list[str]] = {}
    for r in sorted(chosen, key=lambda r: (r["lang"], r["n"])):
        samples.setdefault(r["lang"], []).append(r["said"])
    return Model(samples)


def identify(docs: DataFrame, model: Model | None = None, **fit_options) -> DataFrame:
    """Adds lang_pred, score (0 to 1) and bits to docs, in the place of columns of these names; needs a column text, and lang and doc_id where model is None.

    Every whole text is read: letters lower-cased, in UTF-8, runs of other characters as one space. A text is cut greedily into the longest phrases
    that occur in a language's sample, a byte outside it alone; the language with the fewest phrases, times the log of
    its sample's length, wins (ties: the first by name). Any alphabet is one of bytes. score is 1 minus its bits over those of the runner-up.
    Null texts and texts without letters get `und`, score 0. Without any labelled row all texts do. An empty table gives an empty result.
    Nothing but text enters a prediction; repeated rows and null or shared doc_ids are rows like others."""
    model = model or fit(docs, **fit_options)
    key = model.key()
    names = [c for c in docs.columns if c not in ("lang_pred", "score", "bits")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[tuple[str, float, float]] = []
            column = batch.column("text")
            for i, j, _, _ in slices(column):
                found += predict(column.slice(i, j - i).to_pylist(), model, key)
            kept = [batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays([*kept, *(pa.array([x[k] for x in found], t) for k, t in enumerate((pa.string(), pa.float64(), pa.float64())))], names=[*names, "lang_pred", "score", "bits"])

    ddl = docs.select(names).schema.add("lang_pred", "string").add("score", "double").add("bits", "double")
    return docs.select(names).mapInArrow(workers.tidy("language", run), ddl)


def held_out(doc_id):
    return F.coalesce(_bucket(doc_id) == 2, F.lit(False))
