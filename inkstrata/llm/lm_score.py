"""Stupid-backoff language-model scores from count tables partitioned by hash."""

from __future__ import annotations

import gc
import time
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkstrata.llm import workers
from inkstrata.llm.store import written
from inkstrata.llm.vector import SPACES, ngram_hashes, slices, word_hashes, word_spans

ORDER = 3
BACKOFF = 0.4
RUN_BYTES = 6_000_000  # of text whose n-grams travel together
HASHED = 1_000_000  # of it that is hashed at once, or one whole longer text
BUCKET_BYTES = 8_000_000  # of text for each partition of the count tables
FAN = 256  # partitions that a run's n-grams are split over at once


def _grams(data: np.ndarray, offsets: np.ndarray, order: int) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """For each n up to order: places of the last words of the n-grams and their keys; and the first word of each text."""
    words, first, i = [], [np.zeros(1, np.int64)], 0
    while i < len(offsets) - 1:  # some texts at a time: hashing takes 30 bytes a byte
        j = min(len(offsets) - 1, max(i + 1, int(np.searchsorted(offsets, offsets[i] + HASHED, "right")) - 1))
        part = data[offsets[i] : offsets[j]]
        starts, ends, own = word_spans(part, offsets[i : j + 1] - offsets[i], SPACES)
        words.append(word_hashes(part, starts, ends))
        first.append(own[1:] + first[-1][-1])
        i = j
    words, first = np.concatenate([np.zeros(0, np.uint64), *words]), np.concatenate(first)
    at_text = np.arange(len(words)) - np.repeat(first[:-1], np.diff(first))
    out = []
    for n in range(1, order + 1):
        keys = ngram_hashes(words, n) ^ np.uint64(n * 0x9E37)
        last = np.arange(n - 1, len(words))[: len(keys)]
        inside = at_text[last] >= n - 1
        out.append((last[inside], keys[inside]))
    return out, first


def _packed(keys: np.ndarray) -> bytes:
    """Sorted keys as compressed differences, bytes of one weight together."""
    gaps = np.diff(keys, prepend=np.uint64(0))
    return zstandard.compress(gaps.view(np.uint8).reshape(-1, 8).T.tobytes(), 1)


def _unpacked(blob: bytes) -> np.ndarray:
    flat = np.frombuffer(zstandard.decompress(blob), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(flat.T).view(np.uint64).ravel(), dtype=np.uint64)


def _ints(x: np.ndarray) -> bytes:
    return zstandard.compress(x.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes(), 6)


def _from_ints(blob: bytes) -> np.ndarray:
    flat = np.frombuffer(zstandard.decompress(blob), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(flat.T).view("<u8").ravel().astype(np.int64)


def _bucket_of(keys: np.ndarray, n: int) -> np.ndarray:
    """Ranges of the key's upper half, so a sorted run's buckets are neighbours; those of n * k buckets lie within those of n."""
    return ((keys >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)


def _summed(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct keys and the sum of counts (1 each by default) of each."""
    if counts is None:
        keys = np.sort(keys)
        at = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]][: len(keys)])
        return keys[at], np.diff(np.r_[at, len(keys)])
    order = np.argsort(keys)
    keys = keys[order]
    at = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]][: len(keys)])
    return keys[at], np.add.reduceat(counts[order], at) if len(at) else counts


def _split(keys: np.ndarray, counts: np.ndarray, n: int) -> Iterator[tuple[int, bytes, bytes]]:
    of = _bucket_of(keys, n)
    cut = np.flatnonzero(np.r_[True, of[1:] != of[:-1], True]) if len(of) else []
    for i, j in zip(cut[:-1], cut[1:]):
        yield int(of[i]), _packed(keys[i:j]), _ints(counts[i:j])


_RUN_DDL = "run long, n_words long, data binary, offsets binary, ids array<long>"


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of texts, each under a number that the written table fixes."""
    n = 0
    for batch in batches:
        for i, j, data, offsets in slices(batch.column("text"), RUN_BYTES):
            n_words = len(word_spans(data, offsets, SPACES)[0])
            ids = batch.column("doc_id").slice(i, j - i)
            row = [(TaskContext.get().partitionId() << 32) + n, n_words, zstandard.compress(data.tobytes(), 9), offsets.astype("<i8").tobytes(), ids.to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int64())))], names=["run", "n_words", "data", "offsets", "ids"])
            n += 1


def _text_of(data: bytes, offsets: bytes) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(zstandard.decompress(data) if data else b"", np.uint8), np.frombuffer(offsets, "<i8")


_PART = pa.schema([("bucket", pa.int64()), ("unit", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())])
_PART_DDL = "bucket long, unit long, keys binary, counts binary"
_TOTAL_DDL = "bucket long, unit long, totals binary"


def _explode(order: int, n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for unit, data, offsets in zip(*(batch.column(c).to_pylist() for c in ("run", "data", "offsets"))):
                grams, _ = _grams(*_text_of(data, offsets), order)
                rows = [(b, unit, k, c) for b, k, c in _split(*_summed(np.concatenate([k for _, k in grams])), n)]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _PART)], schema=_PART)

    return run


def _merge(n: int):
    """Units of one bucket as a unit, split over the buckets below (n of them in all)."""

    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        table, counts = _summed(np.concatenate([_unpacked(x) for x in group["keys"]]), np.concatenate([_from_ints(x) for x in group["counts"]]))
        return pd.DataFrame([(b, int(key[1]), k, c) for b, k, c in _split(table, counts, n)], columns=["bucket", "unit", "keys", "counts"])

    return run


def _shared_out(group: pd.DataFrame, table: np.ndarray, totals: np.ndarray) -> pd.DataFrame:
    """The totals of each unit's own keys."""
    out = [_ints(totals[np.searchsorted(table, _unpacked(x))]) for x in group["keys"]]
    return pd.DataFrame({"bucket": group["bucket"], "unit": group["unit"], "totals": out})


def _count(group: pd.DataFrame) -> pd.DataFrame:
    """One partition of the count tables, joined back to the units of n-grams that asked for it."""
    table, totals = _summed(np.concatenate([_unpacked(x) for x in group["keys"]]), np.concatenate([_from_ints(x) for x in group["counts"]]))
    return _shared_out(group, table, totals)


def _back(units: pd.DataFrame, below: pd.DataFrame) -> pd.DataFrame:
    """Totals that came back for a merged unit's parts, for the units that it was merged from."""
    table, _ = _summed(np.concatenate([_unpacked(x) for x in units["keys"]]))
    totals = np.concatenate([_from_ints(x) for x in below.sort_values("below")["totals"]])
    return _shared_out(units, table, totals)


def _freed(df: DataFrame) -> None:
    """Lets go of shuffle files that nothing refers to any more: they are as large as all n-grams. What the first round
    finds unused still holds others, which the second lets go."""
    for _ in range(2):
        gc.collect()
        df.sparkSession._jvm.System.gc()
        time.sleep(0.7)


def count_tables(runs: DataFrame, order: int, buckets: int, fan: int = FAN) -> DataFrame:
    """(bucket, unit, totals): for each run (unit) its sorted distinct n-grams' counts in all runs, by ranges of their hashes.

    A run is split over `fan` ranges at most, so parts stay large: with more buckets than that, the parts of about `fan` units for
    one range are merged to one unit and split again, level by level, and totals come back the same way. The rows of a level
    are in proportion to the runs, however many buckets there are."""
    levels = 1
    while fan**levels < buckets:
        levels += 1
    each = n = buckets if levels == 1 else fan
    units, kept = runs.count(), []
    part = runs.select("run", "data", "offsets").mapInArrow(workers.tidy("lm_score", _explode(order, n)), _PART_DDL)
    for _ in range(levels - 1):
        units, n = -(-units // fan), n * each
        part = written(part.withColumn("into", F.pmod(F.xxhash64("unit"), F.lit(units))), "units")
        kept.append(part)
        part = part.groupBy("bucket", "into").applyInPandas(_merge(n), _PART_DDL)
    totals = written(part.repartition(min(4 * n, 8192), "bucket").groupBy("bucket").applyInPandas(_count, _TOTAL_DDL), "totals")
    for part in reversed(kept):
        below = totals.select(F.expr(f"bucket div {each}").alias("bucket"), F.col("unit").alias("into"), F.col("bucket").alias("below"), "totals")
        totals = written(part.groupBy("bucket", "into").cogroup(below.groupBy("bucket", "into")).applyInPandas(_back, _TOTAL_DDL), "totals")
    _freed(runs)
    return totals


def _score(order: int, backoff: float, n_tokens: int):
    def run(texts: pd.DataFrame, counted: pd.DataFrame) -> pd.DataFrame:
        own = texts.iloc[0]
        data, offsets = _text_of(own.data, own.offsets)
        grams, first = _grams(data, offsets, order)
        size = np.diff(first)
        n_words = int(size.sum())
        doc = np.repeat(np.arange(len(size)), size)
        place = np.arange(n_words) - np.repeat(first[:-1], size)
        flat = np.concatenate([k for _, k in grams])
        of_doc = np.concatenate([doc[last] for last, _ in grams])
        by = np.argsort(flat, kind="stable")  # within a key the texts are in order
        keys, docs = flat[by], of_doc[by]
        new_key = np.r_[True, keys[1:] != keys[:-1]][: len(keys)]
        new_own = new_key | np.r_[True, docs[1:] != docs[:-1]][: len(keys)]
        totals = np.concatenate([_from_ints(x) for x in counted.sort_values("bucket")["totals"]]) if len(counted) else np.zeros(0, np.int64)
        if len(totals) != new_key.sum():
            raise RuntimeError("a run's n-grams and their totals differ in number")
        at_own = np.flatnonzero(new_own)
        elsewhere = np.empty(len(keys), np.int64)
        if len(keys):
            elsewhere[by] = totals[np.cumsum(new_key) - 1] - np.diff(np.r_[at_own, len(keys)])[np.cumsum(new_own) - 1]
        counts = np.zeros((order + 1, n_words), np.int64)  # of the n words that end here, in other texts; row 0: all words of those
        counts[0] = np.maximum(1, n_tokens - np.repeat(size, size))
        at = 0
        for n, (last, k) in enumerate(grams, 1):
            counts[n, last] = elsewhere[at : at + len(k)]
            at += len(k)
        top = np.minimum(order, place + 1)
        score, used = np.full(n_words, np.nan), np.zeros(n_words, np.int64)
        for n in range(order, 0, -1):
            seen = np.flatnonzero(np.isnan(score) & (top >= n) & (counts[n] > 0))
            context = counts[n - 1, seen - 1] if n > 1 else counts[0, seen]
            score[seen] = np.log(counts[n, seen] / context) + (top[seen] - n) * np.log(backoff)
            used[seen] = n
        none = np.flatnonzero(np.isnan(score))
        score[none] = top[none] * np.log(backoff) - np.log(counts[0, none])
        back = np.r_[0, np.cumsum(used < top)]
        total = np.array([score[i:j].sum() for i, j in zip(first[:-1], first[1:])])
        return pd.DataFrame({"doc_id": pd.array([None if x is None or x != x else int(x) for x in own.ids], "Int64"), "n_words": size, "n_backoff": back[first[1:]] - back[first[:-1]], "log_score": total})

    return run


def score_documents(docs: DataFrame, *, order: int = ORDER, backoff: float = BACKOFF, bucket_bytes: int = BUCKET_BYTES, fan: int = FAN) -> DataFrame:
    """Per row of docs (doc_id, text): doc_id, n_words, n_backoff, log_score, mean_log_score.

    Words are runs of bytes other than white space, A-Z lower-cased. The model counts all n-grams, up to `order` words, of all
    documents; each row is scored by the counts of all other rows, as with its own every n-gram would be known. A word's score is the
    count of the longest known n-gram that ends there, over that of its context, times `backoff` for each
    step down from the longest possible; at last its own count over all words of other rows, and for a word that no other row has one step
    more, over a count of 1. n_backoff counts the words that stepped down. log_score sums the natural logs; mean_log_score
    divides by n_words. Null or empty texts have no words, log_score 0 and a null mean. Rows with null or repeated doc_id are rows of their own;
    an empty table gives an empty result; other columns are ignored.

    Texts are written once as numbered runs. Tasks count the n-grams of a run before anything moves; its sorted distinct n-grams go to
    the partitions of the count tables by hash, as packed columns; a partition sums them and joins the totals back to
    each run's n-grams, in the same order; runs then meet their totals and sum scores per document. The number of partitions follows the
    bytes of the input, and a frequent n-gram is one entry for each run. Counts are 64-bit. An n-gram is a 64-bit hash: among 2**45 different ones
    (100 TB) one in 2**19 shares its hash with another, and their counts are added."""
    text = docs.selectExpr("cast(doc_id as long) doc_id", "text")
    n_bytes = text.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    runs = written(text.mapInArrow(workers.tidy("lm_score", _runs), _RUN_DDL), "runs")
    n_tokens = runs.agg(F.sum("n_words")).first()[0] or 0
    totals = count_tables(runs, order, max(6, -(-n_bytes // bucket_bytes)), fan)
    counted = totals.select(F.col("unit").alias("run"), "bucket", "totals")
    scored = runs.groupBy("run").cogroup(counted.groupBy("run")).applyInPandas(_score(order, backoff, n_tokens), "doc_id long, n_words long, n_backoff long, log_score double")
    return scored.withColumn("mean_log_score", F.when(F.col("n_words") > 0, F.col("log_score") / F.col("n_words")))
