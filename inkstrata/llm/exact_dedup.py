"""Exact deduplication through an extendible-hash index, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkstrata.llm.skew import join_by_key
from inkstrata.llm.store import small, written

BUCKET_KEYS = 20_000  # entries that a bucket holds before its directory entry splits
STEP = 4  # bits by which overfull prefixes are counted anew


def normalised(text: Column) -> Column:
    """Each run of space, tab, LF, VT, FF or CR as one space; null as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def _top(h: str, bits: int) -> Column:
    return F.shiftrightunsigned(h, 64 - bits).cast("int") if bits else F.lit(0)


def _leaves(cells: dict[int, int], roots: list[tuple[int, int]], depth: int, most: int) -> tuple[list[tuple[int, int]], list[int]]:
    """Splits roots (depth, prefix) bit by bit until each holds `most` at most; and the prefixes of `depth`, where cells were counted, that hold more."""
    levels = {depth: cells}
    for d in range(depth, min(r[0] for r in roots), -1):
        levels[d - 1] = {}
        for c, n in levels[d].items():
            levels[d - 1][c >> 1] = levels[d - 1].get(c >> 1, 0) + n
    done, over, todo = [], [], list(roots)
    while todo:
        d, prefix = todo.pop()
        if levels[d].get(prefix, 0) <= most:
            done.append((d, prefix))
        elif d == depth:
            over.append(prefix)
        else:
            todo += [(d + 1, prefix << 1), (d + 1, prefix << 1 | 1)]
    return done, over


def directory(index: DataFrame, bucket_keys: int = BUCKET_KEYS) -> list[int]:
    """The directory of an extendible hash over index.h: a list of 2**depth bucket numbers, by the
    top bits of h. A bucket with more than bucket_keys entries splits by its next bit, and the directory doubles where that is
    deeper than it; buckets that aren't overfull keep sharing entries, as their local depth is less. Only entries
    of one and the same h stay together however many they are. The driver holds some numbers for each bucket."""

    def counted(within: DataFrame, depth: int) -> tuple[dict[int, int], set[int]]:
        rows = within.groupBy(_top("h", depth).alias("cell")).agg(F.count(F.lit(1)).alias("n"), (F.min("h") == F.max("h")).alias("one")).collect()
        return {r["cell"]: r["n"] for r in rows}, {r["cell"] for r in rows if r["one"]}

    depth = (index.count() // bucket_keys).bit_length() + 2
    cells, one = counted(index, depth)
    done, over = _leaves(cells, [(0, 0)], depth, bucket_keys)
    while more := [p for p in over if p not in one]:
        done += [(depth, p) for p in over if p in one]
        cells, one = counted(index.filter(_top("h", depth).isin(more)), depth + STEP)
        found, over = _leaves(cells, [(depth, p) for p in more], depth + STEP, bucket_keys)
        done, depth = done + found, depth + STEP
    done += [(depth, p) for p in over]
    depth = max(d for d, _ in done)
    out = [0] * (1 << depth)
    for number, (d, prefix) in enumerate(sorted(done, key=lambda x: x[1] << (depth - x[0]))):
        for k in range(prefix << (depth - d), (prefix + 1) << (depth - d)):
            out[k] = number
    return out


def _with_bucket(rows: DataFrame, slots: list[int], broadcast_rows: int) -> DataFrame:
    """rows with the bucket that the directory names for h. The directory is a table, broadcast while it is small."""
    depth = len(slots).bit_length() - 1
    found = rows.sparkSession.createDataFrame(list(enumerate(slots)), "cell int, bucket int")
    return rows.withColumn("cell", _top("h", depth)).join(F.broadcast(found) if len(slots) <= broadcast_rows else found, "cell").drop("cell")


def build_index(keys: DataFrame, bucket_keys: int = BUCKET_KEYS, broadcast_rows: int = 1_000_000) -> tuple[DataFrame, list[int]]:
    """The index files and the directory. An entry stands for one (h, digest, n_bytes): its first row (the least doc_id, null last, and
    its row_id) and the number of rows, under its bucket. Owner tasks hold ranges of (bucket, h), sorted, so a lookup
    reads few row groups. Copies are summed before the shuffle."""
    first = F.min(F.struct(F.isnull("doc_id").alias("none"), "doc_id", "row_id")).alias("first")
    entries = written(keys.groupBy("h", "digest", "n_bytes").agg(first, F.count(F.lit(1)).alias("n_rows")), "entries")
    slots = directory(entries, bucket_keys)
    owned = _with_bucket(entries, slots, broadcast_rows).select("bucket", "h", "digest", "n_bytes", "n_rows", F.col("first.doc_id").alias("keep_id"), F.col("first.row_id").alias("keep_row"))
    return written(owned.repartitionByRange("bucket", "h").sortWithinPartitions("bucket", "h"), "index"), slots


def exact_dedup(docs: DataFrame, *, bucket_keys: int = BUCKET_KEYS, broadcast_rows: int = 1_000_000, row_key: str | None = None) -> DataFrame:
    """Per row of docs (doc_id, text): doc_id, keep_id, group_size, kept, text_sha256; and row_key, if docs has such a column of distinct longs.

    Texts are equal when their normalised() forms are, byte by byte; null counts as empty. Of equal
    texts the row with the smallest doc_id is kept; if that row is repeated, one of them. A null doc_id
    is kept only where its group has no other. An empty table gives an empty result; further
    columns are ignored.

    Each row finds its bucket in the directory and its entry (64-bit hash, SHA-256, length) in that bucket of the index; the
    entry names the row that stays. The texts of entries that stand for several rows are read a second time and
    compared by their bytes within their bucket's chain, copies summed in the tasks that read them: an entry with two different texts is
    an error. Texts that occur once are never shuffled unless the list of shared hashes exceeds broadcast_rows."""
    text = normalised(F.col("text"))
    row_id = F.col(row_key) if row_key else F.monotonically_increasing_id()
    keys = written(
        docs.select("doc_id", text.alias("t"), row_id.alias("row_id")).select("doc_id", F.xxhash64("t").alias("h"), F.unhex(F.sha2("t", 256)).alias("digest"), F.octet_length("t").cast("long").alias("n_bytes"), "row_id"),
        "keys",
    )
    index, slots = build_index(keys, bucket_keys, broadcast_rows)
    shared = written(index.filter("n_rows > 1"), "shared")
    chains = small(written(shared.groupBy("h").agg(F.sum("n_rows").alias("n")).select("h"), "chains"), broadcast_rows)
    texts = _with_bucket(docs.select(text.alias("t")).withColumn("h", F.xxhash64("t")).join(chains, "h", "left_semi"), slots, broadcast_rows)
    texts = texts.groupBy("bucket", "h", "t").agg(F.count(F.lit(1)).alias("n")).select("bucket", "h", F.unhex(F.sha2("t", 256)).alias("digest"), F.octet_length("t").cast("long").alias("n_bytes"))
    compared = texts.groupBy("bucket", "h", "digest", "n_bytes").agg(F.count(F.lit(1)).alias("texts"))
    equal = F.when(F.col("texts") == 1, F.col("n_rows")).otherwise(F.raise_error(F.lit("texts with equal hashes differ, or changed between scans")))
    groups = shared.join(compared, ["bucket", "h", "digest", "n_bytes"], "left").select("bucket", "h", "digest", "keep_id", "keep_row", equal.alias("group_size"), F.col("n_rows").alias("n"))
    groups = written(groups, "groups")
    rows = join_by_key(_with_bucket(keys, slots, broadcast_rows), groups, ["bucket", "h", "digest"], "n", F.col("row_id"), how="left", broadcast_rows=broadcast_rows)
    single = F.col("group_size").isNull()
    return rows.select(
        "doc_id",
        F.when(single, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (single | (F.col("row_id") == F.col("keep_row"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
        *([F.col("row_id").alias(row_key)] if row_key else []),
    )
