"""Near-duplicate detection with b-bit MinHash."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkstrata.llm import workers
from inkstrata.llm.components import components
from inkstrata.llm.skew import join_by_key
from inkstrata.llm.store import small, written
from inkstrata.llm.vector import SPACES, mix, ngram_hashes, slices, word_hashes, word_spans

SHINGLE = 5
BANDS, ROWS = 24, 5  # two sets at a similarity of 0.85 share no band with a chance of 1e-6
BITS = 4  # of each minimum that the packed signature keeps: 16 minima in a long
LONGS = BANDS * ROWS * BITS // 64 + (BANDS * ROWS * BITS % 64 > 0)
SLICE = 1_000_000  # bytes of text that are held as arrays at once
BLOCK = 400_000  # shingles of a block of sets that are compared in one task
_rng = np.random.default_rng(5)
_A = _rng.integers(0, 2**32, BANDS * ROWS, dtype=np.uint32) | np.uint32(1)
_B = _rng.integers(0, 2**32, BANDS * ROWS, dtype=np.uint32)


def shingle_sets(column: pa.Array) -> Iterator[list[np.ndarray]]:
    """The sorted distinct shingle hashes of each text, for some rows at a time."""
    for _, _, data, offsets in slices(column, SLICE):
        starts, ends, first = word_spans(data, offsets, SPACES)
        words = word_hashes(data, starts, ends)
        grams = ngram_hashes(words, SHINGLE)
        out = []
        for i, j in zip(first[:-1].tolist(), first[1:].tolist()):
            if j - i >= SHINGLE:
                x = grams[i : j - SHINGLE + 1].copy()
                x.sort()
                out.append(x[np.r_[True, x[1:] != x[:-1]]])
            elif j > i:  # fewer words: the whole sequence is the one shingle
                out.append(ngram_hashes(words[i:j], j - i) ^ np.uint64(j - i))
            else:
                out.append(np.zeros(0, np.uint64))
        yield out


def _minima(sets: list[np.ndarray]) -> np.ndarray:
    """(sets, BANDS * ROWS) least 32-bit values under each hash function; sets must not be empty."""
    flat = np.concatenate(sets)
    at = np.r_[0, np.cumsum([len(x) for x in sets])[:-1]]
    low = (flat >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(sets), BANDS * ROWS), np.uint32)
    with np.errstate(over="ignore"):
        for k in range(BANDS * ROWS):
            v = low * _A[k]
            v += _B[k]
            v ^= v >> np.uint32(15)
            v *= np.uint32(0x2C1B3C6D)
            out[:, k] = np.minimum.reduceat(v, at)
    return out


def digests(sets: list[np.ndarray]) -> np.ndarray:
    """(sets, 2) sums over each set that stand for it; zeros for an empty one."""
    n = np.array([len(x) for x in sets])
    out = np.zeros((len(sets), 2), np.uint64)
    if n.any():
        flat, at = np.concatenate(sets), np.r_[0, np.cumsum(n[n > 0])[:-1]]
        with np.errstate(over="ignore"):
            out[n > 0, 0] = np.add.reduceat(mix(flat), at)
            out[n > 0, 1] = np.add.reduceat(mix(flat + np.uint64(0x51ED270B)), at)
    return out


_SIGNED = pa.schema([("row_id", pa.int64()), ("doc_id", pa.int64()), ("found_by", pa.int64()), ("n_shingles", pa.int64()), ("d1", pa.int64()), ("d2", pa.int64()), ("sig", pa.list_(pa.int64())), ("bands", pa.list_(pa.int64()))])
_SIGNED_DDL = "row_id long, doc_id long, found_by long, n_shingles long, d1 long, d2 long, sig array<long>, bands array<long>"


def _lists(m: np.ndarray, there: np.ndarray) -> pa.Array:
    """A list column: row i of m where there[i], else empty."""
    n = np.r_[0, np.cumsum(there * m.shape[1])].astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(n), pa.array(m[there].ravel()))


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        row = 0
        for sets in shingle_sets(batch.column("text")):
            n = np.array([len(x) for x in sets])
            there = n > 0
            bands, sig = np.zeros((len(sets), BANDS), np.int64), np.zeros((len(sets), LONGS), np.int64)
            digest = digests(sets)
            if there.any():
                held = [x for x in sets if len(x)]
                low = _minima(held)
                with np.errstate(over="ignore"):
                    keys = np.zeros((len(held), BANDS), np.uint64)
                    for r in range(ROWS):
                        keys = mix(keys ^ mix(low[:, r::ROWS].astype(np.uint64) + np.uint64(r + 1)))
                    bands[there] = mix(keys + np.arange(1, BANDS + 1, dtype=np.uint64)).view(np.int64)
                    packed = np.zeros((len(held), LONGS), np.uint64)
                    for k in range(BANDS * ROWS):
                        packed[:, k * BITS // 64] |= (low[:, k].astype(np.uint64) & np.uint64(15)) << np.uint64(k * BITS % 64)
                    sig[there] = packed.view(np.int64)
            ids = batch.slice(row, len(sets))
            row += len(sets)
            yield pa.RecordBatch.from_arrays([ids.column("row_id"), ids.column("doc_id"), ids.column("found_by"), pa.array(n.astype(np.int64)), pa.array(digest[:, 0].view(np.int64)), pa.array(digest[:, 1].view(np.int64)), _lists(sig, there), _lists(bands, there)], schema=_SIGNED)


_SETS = pa.schema([("d1", pa.int64()), ("d2", pa.int64()), ("n_shingles", pa.int64()), ("hashes", pa.list_(pa.int64()))])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each different set of a task's texts, under its digest."""
    seen: set[tuple[int, int]] = set()
    for batch in batches:
        for sets in shingle_sets(batch.column("text")):
            digest = digests(sets).view(np.int64)
            new = [i for i, d in enumerate(map(tuple, digest.tolist())) if not (d in seen or seen.add(d))]
            sizes = [len(sets[i]) for i in new]
            flat = np.concatenate([sets[i] for i in new]).view(np.int64) if new else np.zeros(0, np.int64)
            hashes = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32)), pa.array(flat))
            yield pa.RecordBatch.from_arrays([pa.array(digest[new, 0]), pa.array(digest[new, 1]), pa.array(sizes, pa.int64()), hashes], schema=_SETS)


def estimate(a: str, b: str) -> str:
    """SQL: the similarity of two packed signatures, corrected for values whose low bits agree by chance."""
    n = BANDS * ROWS
    same = f"aggregate(zip_with({a}, {b}, (x, y) -> x ^ y), 0L, (s, x) -> s + bit_count((x | shiftrightunsigned(x, 1) | shiftrightunsigned(x, 2) | shiftrightunsigned(x, 3)) & 1229782938247303441L))"
    return f"((1 - {same} / {float(n)}) - {2.0**-BITS}) / {1 - 2.0**-BITS}"


def _linker(percent: int, least: float):
    """Compares each set of role S with each of role A in a block; gives the confirmed links of a spanning forest."""

    def unpacked(sigs: list) -> np.ndarray:
        x = np.array([np.asarray(s) for s in sigs], np.int64).view(np.uint64)
        return np.concatenate([(x >> np.uint64(k * BITS)) & np.uint64(15) for k in range(64 // BITS)], axis=1).astype(np.uint8)

    def link(block: pd.DataFrame) -> pd.DataFrame:
        stars, others = block[block.role == "S"], block[block.role == "A"]
        if not len(stars) or not len(others):
            return pd.DataFrame({"a": [], "b": []}, dtype="int64")
        above: dict[int, int] = {}

        def root(x: int) -> int:
            while above.setdefault(x, x) != x:
                above[x] = x = above[above[x]]
            return x

        ids = others.id.to_numpy()
        sets = [np.asarray(x) for x in others.hashes]
        sizes = np.array([len(x) for x in sets])
        flat = np.concatenate(sets)
        known, inverse = np.unique(flat, return_inverse=True)
        at = np.r_[0, np.cumsum(sizes)[:-1]]
        bits = unpacked(list(others.sig))
        comps = others.comp.to_numpy()
        total, extra = BANDS * ROWS, 64 // BITS * LONGS - BANDS * ROWS
        found = []
        for i, comp, own, sig in zip(stars.id, stars.comp, stars.hashes, stars.sig):
            own = np.asarray(own)
            same = (bits == unpacked([sig])[0]).sum(axis=1) - extra
            near = (same / total - 2.0**-BITS) / (1 - 2.0**-BITS) >= least
            near &= (comps != comp) & (100 * np.minimum(sizes, len(own)) >= percent * np.maximum(sizes, len(own)))
            if not near.any():
                continue
            place = np.searchsorted(known, own)
            place[place == len(known)] = 0
            mark = np.zeros(len(known), np.int64)
            mark[place[known[place] == own]] = 1
            for j in np.flatnonzero(near):
                x, y = root(int(comp)), root(int(comps[j]))
                if x == y:
                    continue
                both = int(mark[inverse[at[j] : at[j] + sizes[j]]].sum())
                if 100 * both >= percent * (len(own) + int(sizes[j]) - both):
                    above[x] = y
                    found.append((int(i), int(ids[j])))
        return pd.DataFrame(found, columns=["a", "b"]).astype("int64")

    return link


def _confirmed(members: DataFrame, sets: DataFrame, percent: int, least: float, broadcast_rows: int) -> DataFrame:
    """Links (a, b) among members (block columns key, part_a, part_s; id, comp, role)."""
    held = sets.join(small(members, broadcast_rows), "id")
    return held.groupBy("key", "part_a", "part_s").applyInPandas(_linker(percent, least), "a long, b long")


def near_duplicates(docs: DataFrame, *, percent: int = 85, broadcast_rows: int = 1_000_000, rounds: int = 2, row_key: str | None = None) -> DataFrame:
    """Per row of docs (doc_id, text): doc_id, n_shingles, component_id, kept.

    A document's set: its distinct shingles of SHINGLE words (runs of bytes other than white space,
    A-Z lower-cased); with fewer words its whole sequence; a text without words, or null, has none and is linked
    with nothing. Two documents are linked when 100 * intersection >= percent * union. component_id is the
    smallest doc_id reachable through links; kept marks the row whose doc_id that is (one
    of them if the row is repeated). Rows with a null doc_id and no words form components of their own with a null id;
    with words they join their set's class. Further columns are ignored.

    A row_key names a column of distinct longs in docs, which the result then has too. kept goes by rows then, not by doc_ids:
    one row of each group of linked rows is kept, that of the smallest doc_id (null last), whatever rows elsewhere share it;
    rows without words are linked with nothing and all kept.

    Documents with the same set are one class, so copies never meet in pairs. Classes get BANDS * ROWS minima;
    classes that share a band's minima are candidates; the low BITS bits of the minima, packed, estimate their similarity, and
    candidates of at least the threshold less 5 standard deviations are compared on their full sets.
    First each class is compared with the least one of each of its buckets. Then, for buckets whose members are
    not all in one component, every member outside the bucket's main component is compared with
    all others, in blocks of about BLOCK shingles that give only the links of a spanning forest: no link is
    lost and no group's pairs are listed.

    docs is scanned twice; nothing is carried over by a row's place. The second scan finds the rows that stand for classes by
    a hash of id and text, and puts each set to its class by the set's own digest; a class without a set is an error.
    """
    least = percent / 100 - 5 * math.sqrt(percent / 100 * (1 - percent / 100) / (BANDS * ROWS)) / (1 - 2.0**-BITS)
    found_by = F.xxhash64("doc_id", "text")
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", (F.col(row_key) if row_key else F.monotonically_increasing_id()).alias("row_id"))
    signed = written(text.select("row_id", "doc_id", found_by.alias("found_by"), "text").mapInArrow(workers.tidy("near_dedup", _sign), _SIGNED_DDL), "signed")
    filled = signed.filter("n_shingles > 0")
    first = [F.min(F.struct(F.isnull("doc_id").alias("none"), "doc_id", "row_id")).alias("first")] if row_key else []
    classes = written(
        filled.groupBy("d1", "d2", "n_shingles").agg(F.min("doc_id").alias("least_doc"), F.min(F.struct("row_id", "found_by")).alias("rep"), *first).select("*", F.col("rep.row_id").alias("id"), "rep.found_by").drop("rep"),
        "classes",
    )
    shapes = written(signed.join(classes.select(F.col("id").alias("row_id")), "row_id", "left_semi").select(F.col("row_id").alias("id"), "n_shingles", "sig", "bands"), "shapes")
    rows = shapes.select("id", "n_shingles", F.explode("bands").alias("key"))
    sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("hub"), F.sum("n_shingles").alias("load"), F.sum(F.xxhash64("id").cast("decimal(38,0)")).alias("who")).filter("n > 1")
    sizes = written(sizes.groupBy("n", "who").agg(F.min_by(F.struct("key", "hub", "load"), "key").alias("b")).select("b.*", "n"), "sizes")  # one of the buckets with the same members

    def joined(rows: DataFrame, per_key: DataFrame, key: str) -> DataFrame:
        return join_by_key(rows, per_key, [key], "n", F.col("id"), broadcast_rows=broadcast_rows)

    buckets = written(joined(rows, sizes.withColumn("members", F.col("n")), "key"), "buckets")
    involved = written(classes.join(buckets.select("id").distinct(), "id").join(shapes.select("id", "sig"), "id").select("id", "found_by", "d1", "d2", "n_shingles", "sig"), "involved")
    wanted = docs.select("text", found_by.alias("found_by")).join(small(involved.select("found_by").distinct(), broadcast_rows), "found_by", "left_semi")
    hashes = wanted.select("text").mapInArrow(workers.tidy("near_dedup", _sets), "d1 long, d2 long, n_shingles long, hashes array<long>")
    sets = written(hashes.join(small(involved.drop("found_by"), broadcast_rows // 5), ["d1", "d2", "n_shingles"]).select("id", "hashes", "sig"), "sets")
    if sets.select("id").distinct().count() != involved.count():
        raise RuntimeError("a text of the first scan was not found again: docs must hold the same rows in each scan")

    # Round 1: each class against the hubs of its buckets
    sigs = shapes.select("id", "sig", F.col("n_shingles").alias("m"))
    near = sizes.groupBy("hub").agg(F.sum("n").alias("n"))
    stars = buckets.filter("id <> hub").select("id", "hub").distinct().join(sigs, "id")
    hub_sigs = sigs.join(near.select(F.col("hub").alias("id")), "id", "left_semi").select(F.col("id").alias("hub"), F.col("sig").alias("hub_sig"), F.col("m").alias("hub_m")).join(near, "hub")
    stars = joined(stars, written(hub_sigs, "hubs"), "hub")
    stars = written(stars.filter(F.expr(f"{estimate('sig', 'hub_sig')} >= {least} and 100 * least(m, hub_m) >= {percent} * greatest(m, hub_m)")).select("id", "hub", "m"), "stars")
    chunks = stars.groupBy("hub").agg((F.floor(F.sum("m") / F.lit(BLOCK)) + 1).cast("int").alias("n_a"))
    spokes = stars.join(chunks, "hub").select(F.col("hub").alias("key"), F.expr("cast(pmod(xxhash64(id), n_a) as int)").alias("part_a"), "id", F.lit("A").alias("role"))
    hubs = chunks.select(F.col("hub").alias("key"), F.explode(F.expr("sequence(0, n_a - 1)")).alias("part_a"), F.col("hub").alias("id"), F.lit("S").alias("role"))
    members = spokes.unionByName(hubs).withColumn("part_s", F.lit(0)).withColumn("comp", F.col("id"))
    links = written(_confirmed(members, sets, percent, least, broadcast_rows), "links")

    # Round 2: what shares a bucket and isn't connected yet
    for _ in range(rounds - 1):
        comp = written(components(links), "comp")
        placed = buckets.join(comp.withColumnRenamed("node", "id"), "id", "left").withColumn("comp", F.coalesce("component", "id")).select("key", "members", "id", "n_shingles", "hub", "load", "comp")
        mixed = placed.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.max(F.when(F.col("id") == F.col("hub"), F.col("comp"))).alias("main"), F.first("members").alias("n")).filter("lo <> hi").select("key", "main", "n")
        open_ = written(joined(placed, written(mixed, "mixed"), "key"), "open")
        loads = open_.groupBy("key").agg(F.sum(F.when(F.col("comp") != F.col("main"), F.col("n_shingles")).otherwise(0)).alias("s_load"), F.first("members").alias("n"))
        open_ = joined(open_, written(loads, "loads"), "key").withColumn("n_a", (F.floor(F.col("load") / F.lit(BLOCK)) + 1).cast("int")).withColumn("n_s", (F.floor(F.col("s_load") / F.lit(BLOCK)) + 1).cast("int"))
        as_a = open_.select("key", F.expr("cast(pmod(xxhash64(id), n_a) as int)").alias("part_a"), F.explode(F.expr("sequence(0, n_s - 1)")).alias("part_s"), "id", "comp", F.lit("A").alias("role"))
        as_s = open_.filter("comp <> main").select("key", F.explode(F.expr("sequence(0, n_a - 1)")).alias("part_a"), F.expr("cast(pmod(xxhash64(id, 7), n_s) as int)").alias("part_s"), "id", "comp", F.lit("S").alias("role"))
        links = written(links.unionByName(_confirmed(as_a.unionByName(as_s), sets, percent, least, broadcast_rows)), "links")

    comp = components(links)
    of_class = classes.join(comp.withColumnRenamed("node", "id"), "id", "left").withColumn("component", F.coalesce("component", "id"))
    leasts = of_class.groupBy("component").agg(F.min("least_doc").alias("component_id"), *([F.min("first").getField("row_id").alias("kept_row")] if row_key else []))
    of_class = written(of_class.join(leasts, "component").select("d1", "d2", "n_shingles", *leasts.columns[1:]), "of_class")
    rows = signed.select("row_id", "doc_id", "n_shingles", "d1", "d2").join(of_class, ["d1", "d2", "n_shingles"], "left")
    component = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    if row_key:
        return rows.select("doc_id", "n_shingles", component.alias("component_id"), ((F.col("n_shingles") == 0) | (F.col("row_id") == F.col("kept_row"))).alias("kept"), F.col("row_id").alias(row_key))
    firsts = signed.groupBy(F.col("doc_id").alias("first_doc")).agg(F.min("row_id").alias("first_row"), F.count(F.lit(1)).alias("times")).filter("times > 1").select("first_doc", "first_row")
    rows = rows.join(F.broadcast(firsts) if firsts.count() <= broadcast_rows else firsts, F.col("doc_id").eqNullSafe(F.col("first_doc")), "left")
    return rows.select("doc_id", "n_shingles", component.alias("component_id"), (F.col("doc_id").eqNullSafe(component) & F.coalesce(F.col("row_id") == F.col("first_row"), F.lit(True))).alias("kept"))
