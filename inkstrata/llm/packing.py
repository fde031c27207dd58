"""Cost-balanced packing of token sequences."""

from __future__ import annotations

import heapq
import re
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from inkstrata.llm import workers
from inkstrata.llm.vector import LOWER, SPACES, slices, word_spans

LENGTH = 2048
END_ID = 1
BLOCK_TOKENS = 4_000_000  # tokens that a task packs together
SLICE = 4_000_000  # bytes of text that are encoded together
MEMO = 500_000  # pieces of text whose ids a worker remembers
LINEAR, QUADRATIC = 1.0, 1.0 / 512  # cost of a piece of n tokens: LINEAR * n + QUADRATIC * n * n


class Encoder:
    """Ids of whole texts by the tokenizer in `path`.

    Its normaliser makes white space one blank and its splitter drops blanks, so a text's ids are those of its
    white-space separated pieces in a row. Those of plain ASCII are cut
    at the splitter's own borders. Pieces are numbered by Arrow, a slice of texts at a time; each distinct one is
    encoded once and the ids are gathered by number. Ids of short pieces are remembered."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[str, bytes] = {}
        self.model = self.tokenizer.model
        self.four = [i.to_bytes(4, "little") for i in range(self.tokenizer.get_vocab_size())]
        visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]  # byte-level: others follow from U+0100 on
        rest = iter(range(0x100, 0x200))
        self.shown = [chr(b) if b in visible else chr(next(rest)) for b in range(256)]

    def _slow(self, texts: list[str]) -> list[bytes]:
        return [np.array(x.ids, "<u4").tobytes() for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _merged(self, x: str) -> bytes:
        """Ids of one split of normalised text, straight from the merges."""
        shown = x if x.isascii() and x.isprintable() else "".join([self.shown[b] for b in x.encode("utf-8", "replace")])
        return b"".join([self.four[t.id] for t in self.model.tokenize(shown)])

    def _core(self, x: str) -> bytes:
        return self.known.get(x) or self._merged(x)

    def _piece(self, x: str) -> bytes | None:
        """Ids of a piece without white space; None if its normal form or its splits are not plain."""
        if x.isascii():
            if x.islower() and x.isalpha():
                return self._merged(x)
            return None if "<|" in x else b"".join(map(self._core, _SPLITS(x.lower())))
        low = x.lower()
        if "\u03a3" in x or not unicodedata.is_normalized("NFC", x):
            return None
        if low[-1] in _MARKS and low[:-1].isalpha():
            return self._core(low[:-1]) + self._core(low[-1])
        return self._merged(low) if low.isalpha() else None

    def _of(self, pieces: list[str]) -> list[bytes]:
        if len(self.known) > MEMO:
            self.known.clear()
        got = list(map(self.known.get, pieces))
        if None in got:
            at = [i for i, x in enumerate(got) if x is None]
            for i in at:
                got[i] = self._piece(pieces[i])
            hard = [i for i in at if got[i] is None]
            for i, ids in zip(hard, self._slow([pieces[i] for i in hard]) if hard else ()):
                got[i] = ids
            self.known.update((pieces[i], got[i]) for i in at if len(pieces[i]) <= 48)
        return got

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of texts, each with END_ID after it, in one array, and the offsets of the texts in it. data, offsets: as from slices()."""
        starts, ends, first = word_spans(data, offsets, SPACES)
        inside = ~SPACES[data]
        letters = data[inside]
        n = len(starts)
        sizes = np.r_[0, np.cumsum(ends - starts)]
        raw = data.tobytes()
        if n and not any(c in raw for c in (b"<|", b"\x1c", b"\x1d", b"\x1e", b"\x1f")):  # a special token's sign, or odd for str.isspace()
            kind = _KIND[letters]  # words of plain ASCII are split and lower-cased here
            odd = np.r_[0, np.cumsum(kind == 3, dtype=np.int32)]
            plain = np.repeat(odd[sizes[1:]] == odd[sizes[:-1]], ends - starts)
            letters = np.where(plain, LOWER[letters], letters)
            begin = plain.copy()
            begin[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == 1)
            begin[sizes[:-1]] = True
            begin = np.flatnonzero(begin)
            first = np.searchsorted(begin, sizes[first])
            sizes = np.r_[begin, len(letters)]
        words = pa.LargeStringArray.from_buffers(len(sizes) - 1, pa.py_buffer(sizes.astype(np.int64)), pa.py_buffer(letters)).dictionary_encode()
        ids = [*self._of(words.dictionary.to_pylist()), _END]
        counts = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        at = np.r_[0, np.cumsum(counts)[:-1]]
        codes = np.insert(words.indices.to_numpy(zero_copy_only=False), first[1:], len(ids) - 1)
        n = counts[codes]
        begins = np.cumsum(n) - n
        flat = np.frombuffer(b"".join(ids), "<u4")[np.repeat(at[codes] - begins, n) + np.arange(n.sum())]
        closed = first[1:] + np.arange(len(offsets) - 1)  # the place of each text's END_ID among codes
        return flat, np.r_[0, begins[closed] + 1]


def _encoder(path: str) -> Encoder:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Encoder(path)


def cost(n: int) -> float:
    return LINEAR * n + QUADRATIC * n * n


def pack(lengths: list[int], length: int = LENGTH) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) of documents with these lengths.

    Each document gives its full sequences; its rest is placed, longest rests first, in the sequence of lowest
    cost that has room for it; where none has, it fills the sequence with most room and what is left of it waits
    for its turn among the shorter rests. As many sequences are opened as all rests fill, so one at most is not full.

    Rests come in descending order, so a sequence without room for the present one is put down under its room and taken up again
    when the rests are that short: no sequence is looked at twice for one rest."""
    out, rests, sequence = [], [], 0
    for d, n in enumerate(lengths):
        for start in range(0, n - n % length, length):
            out.append((d, start, length, sequence, 0))
            sequence += 1
        if n % length:
            rests.append((-(n % length), d, n - n % length))
    total = -sum(r[0] for r in rests)
    n_open = -(-total // length)
    used = [0] * n_open
    room = [length] * n_open
    if total % length:
        room[-1] = total % length
    spent = [0.0] * n_open
    down: list[list[int]] = [[] for _ in range(length + 1)]  # sequences by their room, below level
    for k, r in enumerate(room):
        down[r].append(k)
    level, ready = length + 1, []  # ready: a heap of (cost, sequence) with room of level or more
    heapq.heapify(rests)
    while rests:
        n, d, start = heapq.heappop(rests)
        n = -n
        while level > n:
            level -= 1
            for k in down[level]:
                heapq.heappush(ready, (spent[k], k))
            down[level] = []
        if ready:
            k, m = heapq.heappop(ready)[1], n
        else:
            m = next(r for r in range(level - 1, 0, -1) if down[r])
            k = down[m].pop()
            heapq.heappush(rests, (m - n, d, start + m))
        out.append((d, start, m, sequence + k, used[k]))
        used[k] += m
        room[k] -= m
        spent[k] += cost(m)
        if room[k] >= level:
            heapq.heappush(ready, (spent[k], k))
        elif room[k]:
            down[room[k]].append(k)
    return out


_SCHEMA = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])
_DDL = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
_MARKS = frozenset(".,;:!?")
#: The tokenizer's splits, for ASCII text without white space.
_KIND = np.full(256, 2, np.uint8)  # 0 letters, 1 digits, 2 others, 3 what may make splits less plain
_KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = 0
_KIND[0x30:0x3A] = 1
_KIND[[0x27, *range(0x80, 0x100)]] = 3
_SPLITS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+").findall
_END = np.array([END_ID], "<u4").tobytes()


def pack_documents(docs: DataFrame, tokenizer_path: str, *, length: int = LENGTH, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Pieces of the documents (doc_id, text) in sequences of at most `length` tokens: doc_id, start, length, ids_crc32,
    doc_tokens, sequence_id, offset.

    A document is its text's ids and then END_ID, so a null or empty text is one token. Each task packs the documents of its partition in
    blocks of about block_tokens, without a shuffle; see pack(). Of a block one sequence at most
    isn't full. sequence_id is unique: the partition's number and a count. Rows with null or
    repeated doc_id are packed as documents of their own; an empty table gives no pieces; other columns are ignored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = workers.model(("encoder", tokenizer_path), lambda: _encoder(tokenizer_path))
        base, sequence = TaskContext.get().partitionId() << 40, 0
        ids: list[int | None] = []
        tokens: list[np.ndarray] = []

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal sequence
            pieces = pack([len(t) for t in tokens], length)
            rows = [(ids[d], s, n, zlib.crc32(tokens[d][s : s + n]), len(tokens[d]), base + sequence + q, o) for d, s, n, q, o in pieces]
            sequence += 1 + max((p[3] for p in pieces), default=-1)
            ids.clear()
            tokens.clear()
            for at in range(0, len(rows), 10_000):
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows[at : at + 10_000])], schema=_SCHEMA)

        held = 0
        for batch in batches:
            for i, j, data, offsets in slices(batch.column("text"), SLICE):
                flat, cuts = encoder.encode(data, offsets)
                ids += batch.column("doc_id").slice(i, j - i).to_pylist()
                tokens += np.split(flat, cuts[1:-1])
                held += len(flat)
                if held >= block_tokens:
                    yield from flush()
                    held = 0
        if tokens:
            yield from flush()

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(workers.tidy("packing", run), _DDL)
