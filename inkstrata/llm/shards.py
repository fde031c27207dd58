"""Sharding by sampled splitters."""

from __future__ import annotations

import heapq
from bisect import bisect_right

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from inkstrata.llm.skew import join_by_key
from inkstrata.llm.store import written

SAMPLE = 20_000  # expected size of the weighted sample that the driver sorts
RANGES = 64  # ranges per shard before subdividing
LARGE = 0.002  # of a shard's bytes, from which a group of equal texts is dealt out before other rows
TOP = 1 << 62


def _pick(sample: list[tuple[int, int, float]], step: float) -> list[tuple[int, int]]:
    """Splitters (k, u) wherever another `step` of the sampled weight is passed."""
    cuts, total = [], 0.0
    for k, u, w in sorted(sample):
        if int((total + w) / step) > int(total / step) and total:
            cuts.append((k, u))
        total += w
    return cuts


def _range_of(rows: DataFrame, cuts: list[tuple[int, int]]) -> DataFrame:
    """rows with `part`, the number of splitters at or below (k, u). The splitters are a literal of a bounded number."""
    if not cuts:
        return rows.withColumn("part", F.lit(0))
    n = len(cuts)
    ks, us = ("array(" + ",".join(f"{c[i]}L" for c in cuts) + ")" for i in (0, 1))
    steps = ",".join(str(1 << j) for j in reversed(range(n.bit_length())))  # of a binary search
    at = "lo + step - 1"
    below = f"{at} < {n} and (get(ks, {at}) < k or (get(ks, {at}) = k and get(us, {at}) <= u))"
    part = F.expr(f"aggregate(array({steps}), 0, (lo, step) -> if({below}, lo + step, lo))")
    return rows.withColumn("ks", F.expr(ks)).withColumn("us", F.expr(us)).withColumn("part", part).drop("ks", "us")


def _dealt(groups: list[tuple[int, int]], target: float, n_shards: int) -> tuple[list[tuple[int, float, int]], list[float]]:
    """Large groups (k, size), largest first, each to the shard with most room; one that fits in none is cut over those with most room.
    Gives (k, offset in the group from which on, shard), and the bytes that remain in each shard."""
    room = [(-target, i) for i in range(n_shards)]
    heapq.heapify(room)
    out = []
    for k, size in sorted(groups, key=lambda g: (-g[1], g[0])):
        at = 0.0
        while at < size:
            free, i = heapq.heappop(room)
            piece = min(size - at, -free) if -free > 0.5 and len(room) else size - at
            out.append((k, at, i))
            at += piece
            heapq.heappush(room, (free + piece, i))
    left = [0.0] * n_shards
    for free, i in room:
        left[i] = max(0.0, -free)
    return out, left


def shard(docs: DataFrame, n_shards: int = 16, *, sample: int = SAMPLE, ranges: int = RANGES) -> DataFrame:
    """Per row of docs (doc_id, text): doc_id, size, text_crc32, law, shard, slot, grown_shard.

    Law `bytes`: the shards 0 to n_shards-1 are near equal in size. A row's size is its text's UTF-8 bytes plus 1 (null: 1). Rows are
    in order of the key (hash of the text, hash of doc_id) in ranges of near equal sizes. Splitters are quantiles of a sample drawn
    with chances in proportion to size; the exact size of each range is then summed, and a range that is overfull is subdivided by
    splitters of a denser sample of its own rows until none is.

    Equal texts share a shard. Groups of more than LARGE of a shard are dealt out first, the largest to the shard with most room;
    a group is cut only where no shard has room for it within the equal size, as when it is larger than a shard. All other rows follow in key order
    and fill what room the shards have left; a small group is where its middle falls. So shards differ by about LARGE of their size, or
    by one row if that is larger. slot counts from 0 in each shard in key order.

    Null texts are one group with CRC 0, apart from empty ones. Rows with null or repeated doc_id are rows of their own.
    Fewer rows than shards leave shards empty; an empty table gives an empty result. Other columns are ignored.
    """
    if n_shards < 1:
        raise ValueError("n_shards must be positive")
    rows = written(
        docs.select(
            "doc_id",
            (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
            F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
            F.xxhash64(F.coalesce("text", F.lit("")), F.col("text").isNull()).alias("k"),
            F.monotonically_increasing_id().alias("row_id"),
        ).withColumn("u", F.xxhash64("doc_id", "row_id")),
        "rows",
    )
    total = rows.agg(F.sum("size")).first()[0] or 0
    most = max(1, total // (n_shards * ranges))  # a range with more is overfull, unless it's one row

    def drawn(df: DataFrame, rate: float, rnd: int) -> list[tuple[int, int, float]]:
        chance = F.least(F.lit(1.0), F.col("size") * F.lit(rate))
        luck = (F.xxhash64("u", F.lit(rnd)).bitwiseAND(TOP - 1)) / F.lit(float(TOP))
        got = df.filter(luck < chance).select("k", "u", "size").collect()  # about as many as the sample's size
        return [(r["k"], r["u"], r["size"] / min(1.0, r["size"] * rate)) for r in got]

    cuts, rate, rnd = _pick(drawn(rows, min(1.0, sample / max(1, total)), 0), most), 0.0, 0
    while rate < 1.0:
        rnd += 1
        parts = _range_of(rows, cuts)
        sums = parts.groupBy("part").agg(F.sum("size").alias("b"), F.count(F.lit(1)).alias("n")).filter((F.col("b") > 2 * most) & (F.col("n") > 1)).collect()
        if not sums:
            break
        over = [r["part"] for r in sums]
        rate = min(1.0, sample / sum(r["b"] for r in sums) * 4 ** max(0, rnd - 4))  # at 1 every row is a splitter's candidate
        by_part: dict[int, list[tuple[int, int, float]]] = {}
        for k, u, w in drawn(parts.filter(F.col("part").isin(over)), rate, rnd):
            by_part.setdefault(bisect_right(cuts, (k, u)), []).append((k, u, w))
        cuts = sorted({*cuts, *(c for v in by_part.values() for c in _pick(v, most))})
    parts = _range_of(rows, cuts)
    sums = parts.groupBy("part", "k").agg(F.sum("size").alias("g"), F.count(F.lit(1)).alias("n"))
    groups = written(sums.groupBy("k").agg(F.sum("g").alias("g"), F.sum("n").alias("n")).filter("n > 1"), "groups")
    target = total / n_shards
    large = [(r["k"], r["g"]) for r in groups.filter(F.col("g") > F.lit(LARGE * target)).collect()]  # n_shards / LARGE at most
    pieces, left = _dealt(large, target, n_shards)
    spark = rows.sparkSession
    of_group: dict[int, list[tuple[float, int]]] = {}
    for k, at, i in pieces:
        of_group.setdefault(k, []).append((at, i))
    dealt = spark.createDataFrame([(k, [at for at, _ in v], [i for _, i in v]) for k, v in of_group.items()], "k long, froms array<double>, shards array<int>")
    parts = parts.join(F.broadcast(dealt), "k", "left").withColumn("rest", F.when(F.col("froms").isNull(), F.col("size")).otherwise(0))
    # Bytes before each range, of all rows and of those outside large groups: sums of a bounded number of ranges
    found = {r["part"]: (r["b"], r["c"]) for r in parts.groupBy("part").agg(F.sum("size").alias("b"), F.sum("rest").alias("c")).collect()}
    before, at = [], (0, 0)
    for p in range(len(cuts) + 1):
        before.append(at)
        at = (at[0] + found.get(p, (0, 0))[0], at[1] + found.get(p, (0, 0))[1])

    def start(i: int) -> Column:
        return F.get(F.expr("array(" + ",".join(f"{b[i]}L" for b in before) + ")"), F.col("part"))

    in_part = Window.partitionBy("part").orderBy("k", "u", "row_id").rowsBetween(Window.unboundedPreceding, -1)
    placed = parts.withColumn("pos", start(0) + F.coalesce(F.sum("size").over(in_part), F.lit(0))).withColumn("at", start(1) + F.coalesce(F.sum("rest").over(in_part), F.lit(0)))
    firsts = placed.groupBy("k").agg(F.min("pos").alias("group_pos"), F.min("at").alias("group_at"))
    firsts = written(firsts.join(groups, "k"), "firsts")
    placed = join_by_key(placed, firsts, ["k"], "n", F.col("row_id"), how="left")
    bounds = [sum(left[: i + 1]) for i in range(n_shards - 1)]
    middle = F.coalesce(F.col("group_at") + F.col("g") / 2, F.col("at") + F.col("size") / 2)
    in_rest = F.size(F.filter(F.expr("cast(array(" + ",".join(map(repr, bounds)) + ") as array<double>)"), lambda b: b <= middle))
    piece = F.size(F.filter("froms", lambda x: x <= F.col("pos") - F.col("group_pos"))) - 1
    to = F.when(F.col("froms").isNull(), in_rest).otherwise(F.get("shards", piece)).cast("int")
    placed = written(placed.select("doc_id", "size", "text_crc32", "part", "k", "u", "row_id", to.alias("shard")), "placed")
    counts = sorted((r["shard"], r["part"], r["n"]) for r in placed.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n")).collect())
    base, seen = [], {}
    for s, p, n in counts:
        base.append((s, p, seen.get(s, 0)))
        seen[s] = seen.get(s, 0) + n
    offsets = spark.createDataFrame(base, "shard int, part int, base long")
    number = Window.partitionBy("shard", "part").orderBy("k", "u", "row_id")
    return placed.join(F.broadcast(offsets), ["shard", "part"]).select(  # a row for each range and shard that meet
        "doc_id",
        "size",
        F.col("text_crc32").cast("long").alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("base") + F.row_number().over(number) - 1).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
