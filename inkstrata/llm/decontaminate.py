"""Benchmark decontamination by winnowing, in DataFrame operations only."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from inkstrata.llm.store import small, written

WINDOW = 13  # words of a contaminating span
GRAM = 4  # words of a hashed k-gram
SPAN = WINDOW - GRAM + 1  # k-grams of a window; a window's fingerprint is their least hash
SHARE = 20  # contaminated: SHARE * hit words >= words

_BREAKS = "".join(chr(c) for c in (*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)))
_FROM, _TO = string.ascii_uppercase + _BREAKS, string.ascii_lowercase + " " * len(_BREAKS)


def _width(own: str) -> Column:
    """Bytes of a row with a list of items, beside its fixed columns."""
    return F.expr(f"{own} + octet_length(array_join(items, ',')) + 16 * size(items)")


def words(text: Column) -> Column:
    """Runs of digits, ASCII letters (lower-cased) and non-ASCII characters; null has none."""
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), _FROM, _TO), " ", -1), "")


def _grams(w: str) -> str:
    ahead = ", ".join(f"get({w}, i + {k})" for k in range(1, GRAM))
    return f"slice(transform({w}, (x, i) -> xxhash64(x, {ahead})), 1, greatest(size({w}) - {GRAM - 1}, 0))"


def _least_of_span(df: DataFrame, source: str, out: str) -> DataFrame:
    """out[i] = least of source[i .. i+SPAN-1], by doubling the covered length."""
    name, covered = source, 1
    while covered < SPAN:
        step = min(covered, SPAN - covered)
        df = df.withColumn(
            f"{out}_{covered}",
            F.expr(f"zip_with(slice({name}, 1, greatest(size({name}) - {step}, 0)), slice({name}, {step + 1}, size({name})), (x, y) -> least(x, y))"),
        )
        name, covered = f"{out}_{covered}", covered + step
    return df.withColumn(out, F.col(name))


class _Bits:
    """Membership bits of the fingerprints: a plan literal of fixed size, whatever the number of items."""

    def __init__(self, fps: DataFrame):
        n = fps.count()
        self.words = 1 << min(17, max(10, (n * 64).bit_length() - 6))  # at most 1 MB
        rows = (
            fps.select(F.expr(f"cast(fp & {self.words - 1} as int)").alias("at"), F.expr("cast(shiftright(fp, 32) & 63 as int)").alias("b"))
            .groupBy("at")
            .agg(F.expr("bit_or(shiftleft(1L, b))").alias("bits"))
            .collect()
        )
        filled = dict((r["at"], r["bits"]) for r in rows)
        self.literal = "array(" + ",".join(f"{filled.get(i, 0)}L" if filled.get(i, 0) > -(2**63) else "(-9223372036854775807L - 1L)" for i in range(self.words)) + ")"

    def column(self) -> Column:
        return F.expr(self.literal)

    def test(self, x: str) -> str:
        return f"getbit(get(bits, cast({x} & {self.words - 1} as int)), cast(shiftright({x}, 32) & 63 as int)) = 1"


def item_windows(benchmark: DataFrame) -> DataFrame:
    """Distinct windows of the items: len, window (words joined by a space), fp, items (sorted item_ids as strings)."""
    w = benchmark.select(F.col("item_id").cast("string").alias("item"), words(F.col("text")).alias("w")).filter("size(w) > 0")
    w = w.withColumn("len", F.expr(f"least(size(w), {WINDOW})"))
    w = w.select("item", "len", F.explode(F.expr("transform(sequence(1, size(w) - len + 1), i -> slice(w, i, len))")).alias("v"))
    fp = F.expr(f"if(len = {WINDOW}, array_min({_grams('v')}), xxhash64(array_join(v, ' '), len))")
    return (
        w.select("item", "len", F.array_join("v", " ").alias("window"), fp.alias("fp"))
        .groupBy("len", "window", "fp")
        .agg(F.array_sort(F.collect_set("item")).alias("items"))
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, broadcast_rows: int = 200_000, row_key: str | None = None) -> DataFrame:
    """Per row of docs (doc_id, text): n_words, n_hit, n_items, items_sha256, contaminated; and row_key, if docs has such a column of distinct longs.

    A window is WINDOW consecutive words of an item (or the whole of a shorter, not empty one); a
    document's word inside any occurrence of a window is hit. Each window's fingerprint is the
    least hash of its k-grams (winnowing), so every shared span of WINDOW words shares one. A
    document's windows whose fingerprint the items have are merged into runs; of equal runs one is
    verified word by word against the items' windows, which extends hits to whole spans, and the
    verdict goes back to each row that has the run. A passage that a third of all rows share is
    so verified once.

    Null or empty texts have no words and are not contaminated. Rows with a null or repeated doc_id
    are judged each by its own text. Items with null text are no windows; a null item_id hits words but
    is no item. An empty benchmark hits nothing. Further columns of either table are ignored.
    Documents' words are hashed in place; only runs are shuffled.
    """
    windows = written(item_windows(benchmark), "windows")
    lengths = sorted(r["len"] for r in windows.select("len").distinct().collect())  # 13 at most
    bits = _Bits(windows.select("fp"))
    rows = docs.select(F.col("doc_id"), words(F.col("text")).alias("w"), bits.column().alias("bits"), (F.col(row_key) if row_key else F.monotonically_increasing_id()).alias("row_id"))
    rows = rows.withColumn("h", F.expr(_grams("w")))
    hit = F.expr(f"exists(h, x -> {bits.test('x')})") if WINDOW in lengths else F.lit(False)
    rows = rows.withColumn("h", F.when(hit, F.col("h")).otherwise(F.expr("cast(array() as array<bigint>)")))
    rows = _least_of_span(rows, "h", "m")
    rows = rows.withColumn("f", F.expr(f"transform(m, x -> {bits.test('x')})"))
    rows = rows.withColumn("s", F.expr("filter(sequence(0, size(f)), i -> coalesce(get(f, i), false) and not coalesce(get(f, i - 1), false))"))
    rows = rows.withColumn("e", F.expr("filter(sequence(0, size(f)), i -> coalesce(get(f, i), false) and not coalesce(get(f, i + 1), false))"))
    found = [f"transform(s, (i, k) -> struct(i as start, {WINDOW} as len, array_join(slice(w, i + 1, get(e, k) - i + {WINDOW}), ' ') as run))"]
    for n in (x for x in lengths if x < WINDOW):
        test = bits.test(f"xxhash64(array_join(slice(w, i + 1, {n}), ' '), {n})")
        found.append(f"transform(filter(sequence(0, size(w) - 1), i -> i + {n} <= size(w) and {test}), i -> struct(i as start, {n} as len, array_join(slice(w, i + 1, {n}), ' ') as run))")
    empty = "cast(array() as array<struct<start: int, len: int, run: string>>)"
    rows = rows.select("doc_id", "row_id", F.size("w").cast("long").alias("n_words"), F.expr(f"if(size(w) = 0, {empty}, concat({', '.join(found)}))").alias("runs"))
    base = written(rows, "runs")

    runs = base.select("row_id", F.explode("runs").alias("r")).select("row_id", "r.start", "r.len", "r.run")
    of_run = Window.partitionBy("len", "run").orderBy("at")
    hits = (
        runs.groupBy("len", "run")
        .agg(F.lit(1).alias("one"))
        .select("len", "run", F.split("run", " ").alias("v"))
        .select("len", "run", "v", F.explode(F.expr("sequence(1, size(v) - len + 1)")).alias("at"))
        .select("len", "run", "at", F.expr("array_join(slice(v, at, len), ' ')").alias("window"))
        .join(small(windows.select("len", "window", "items"), broadcast_rows, _width("octet_length(window)")), ["len", "window"])
    )
    islands = (
        hits.withColumn("new", (F.col("at") > F.lag("at").over(of_run) + F.col("len")).cast("int"))
        .withColumn("island", F.sum(F.coalesce("new", F.lit(0))).over(of_run.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy("len", "run", "island")
        .agg(F.min("at").alias("from"), (F.max("at") + F.first("len")).alias("to"), F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"))
        .groupBy("len", "run")
        .agg(F.collect_list(F.struct("from", "to")).alias("spans"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"))
    )
    verified = written(islands, "verified")
    spans = runs.join(small(verified, broadcast_rows, _width("octet_length(run) + 16 * size(spans)")), ["len", "run"]).select("row_id", "items", F.explode("spans").alias("s"), "start")
    spans = spans.select("row_id", "items", (F.col("start") + F.col("s.from")).alias("a"), (F.col("start") + F.col("s.to")).alias("b"))
    before = Window.partitionBy("row_id").orderBy("a", "b").rowsBetween(Window.unboundedPreceding, -1)
    per_row = (
        spans.withColumn("done", F.coalesce(F.max("b").over(before), F.lit(0)))
        .groupBy("row_id")
        .agg(F.sum(F.greatest(F.lit(0), F.col("b") - F.greatest("a", "done"))).alias("hit"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    )
    n_hit, items = F.coalesce("hit", F.lit(0)).cast("long"), F.coalesce("items", F.expr("cast(array() as array<string>)"))
    return base.select("doc_id", "row_id", "n_words").join(per_row, "row_id", "left").select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        ((n_hit > 0) & (SHARE * n_hit >= F.col("n_words"))).alias("contaminated"),
        *([F.col("row_id").alias(row_key)] if row_key else []),
    )
