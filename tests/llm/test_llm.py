import collections
import hashlib
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from inkstrata.llm import chat, decontaminate, exact_dedup, language, licenses, lm_score, near_dedup, packing, shards, store, warc
from inkstrata.llm import queries as q
from inkstrata.llm.components import components
from inkstrata.llm.store import written
from tests.compare import DATA, same

DOC = "doc_id long, text string"
EDGE = [(1, None), (1, None), (None, "a"), (2, ""), (3, "a  b\n c"), (4, "a b c"), (4, "a b c"), (5, "wort " * 4000), (6, "12 34 !!"), (7, "é É ñ")]


@pytest.fixture(scope="module")
def edge(spark):
    return spark.createDataFrame([(*r, "x") for r in EDGE], DOC + ", kept string")  # a further column, with a clashing name


@pytest.mark.parametrize("name", [n for n in sorted(q.ORACLE_SQL)])
def test_query_equals_its_sql(spark, name):
    same(spark, q.QUERIES[name], q.ORACLE_SQL[name])


def _words(t, pattern):
    return re.findall(pattern, re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def _contamination(docs, items):
    windows = {}
    for item, text in items:
        w = _words(text, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
        n = min(13, len(w))
        for k in range(len(w) - n + 1 if w else 0):
            windows.setdefault(tuple(w[k : k + n]), set()).add(item)
    out = []
    for doc, text in docs:
        w, hit, found = _words(text, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if own := windows.get(tuple(w[k : k + n])):
                    hit.update(range(k, k + n))
                    found |= {str(i) for i in own if i is not None}
        out.append((doc, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def test_decontaminate_short_items_and_edges(spark):
    long = " ".join(f"w{i}" for i in range(40))
    items = [(1, long), (2, "alpha beta"), (3, "gamma"), (4, None), (5, "..."), (6, long), (None, "delta epsilon")]
    docs = [(1, "x " + long.upper() + " y"), (2, "alpha-beta GAMMA"), (3, None), (4, ""), (4, "gamma gamma"), (None, "delta epsilon"), (5, " ".join(f"w{i}" for i in range(5, 18))), (6, " ".join(f"w{i}" for i in range(5, 17))), (7, "z " * 3000 + long)]
    got = decontaminate.decontaminate(spark.createDataFrame(docs, DOC), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted(map(tuple, got.collect()), key=str) == _contamination(docs, items)
    none = decontaminate.decontaminate(spark.createDataFrame(docs, DOC), spark.createDataFrame([], "item_id long, text string"))
    assert not any(r.contaminated for r in none.collect())


def test_clashing_columns_change_nothing(spark):
    """Every operator beside columns named like its own and its inner ones."""
    docs = spark.createDataFrame([(d, t, 1, "y", 2.0, 3, True, 4, 5, 6) for d, t in EDGE if d != 5], DOC + ", h long, kept string, score double, row_id int, contaminated boolean, k int, n_words int, run int")
    plain = docs.select("doc_id", "text")
    bench = spark.createDataFrame([(1, "a b c", "w", 2)], "item_id long, text string, window string, len int")
    for op in (lambda d: decontaminate.decontaminate(d, bench), exact_dedup.exact_dedup, lambda d: shards.shard(d, 2).drop("slot", "shard"), near_dedup.near_duplicates, lambda d: lm_score.score_documents(d), licenses.scan_licenses):
        assert collections.Counter(op(docs).collect()) == collections.Counter(op(plain).collect())
    model = language.Model({"a": ["a b c wort"]})
    assert sorted(map(str, language.identify(docs, model).select("doc_id", "lang_pred", "score").collect())) == sorted(map(str, language.identify(plain, model).select("doc_id", "lang_pred", "score").collect()))
    assert "lang_pred" in language.identify(docs, model).columns and decontaminate.decontaminate(docs.limit(0), bench).count() == 0


def test_long_texts(spark):
    rng = np.random.default_rng(2)
    words = [f"w{i}" for i in rng.integers(0, 5000, 60_000)]
    docs = [(1, " ".join(words)), (2, " ".join([*words[:-300], *(f"y{i}" for i in range(300))])), (3, " ".join(words[:30_000]))]
    frame = spark.createDataFrame(docs, DOC)
    items = [(1, " ".join(words[59_950:])), (2, "not there at all")]
    assert sorted(map(tuple, decontaminate.decontaminate(frame, spark.createDataFrame(items, "item_id long, text string")).collect()), key=str) == _contamination(docs, items)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in near_dedup.near_duplicates(frame).collect()), key=str) == _near(docs)


def test_exact_dedup_edges(spark, edge):
    rows = exact_dedup.exact_dedup(edge).collect()
    groups = collections.defaultdict(list)
    for d, t in EDGE:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", t or "")].append(d)
    assert len(rows) == len(EDGE) and sum(r.kept for r in rows) == len(groups)
    by_sha = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
    for r in rows:
        ids = by_sha[r.text_sha256]
        assert r.group_size == len(ids) and r.keep_id == min((i for i in ids if i is not None), default=None)
    assert exact_dedup.exact_dedup(edge.limit(0)).count() == 0


def test_directory_doubles(spark):
    keys = spark.range(4000).select(F.xxhash64("id").alias("h"))
    slots = exact_dedup.directory(keys, 200)
    held = collections.Counter(slots[(r.h % 2**64) >> (64 - (len(slots).bit_length() - 1))] for r in keys.collect())
    assert max(held.values()) <= 200 and len(slots) & (len(slots) - 1) == 0


def _check_shards(docs, rows, n, slack):
    want = sorted((str(d), len((t or "").encode()) + 1, zlib.crc32((t or "").encode()), "bytes", None) for d, t in docs)
    assert sorted((str(r.doc_id), r.size, r.text_crc32, r.law, r.grown_shard) for r in rows) == want
    size, slots = collections.Counter({i: 0 for i in range(n)}), collections.defaultdict(list)
    for r in rows:
        assert 0 <= r.shard < n
        size[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert max(size.values()) - min(size.values()) <= slack
    text, shards_of = {str(d): t for d, t in docs}, collections.defaultdict(set)
    for r in rows:
        shards_of[text[str(r.doc_id)]].add(r.shard)
    return size, shards_of


@pytest.mark.parametrize("n", [1, 3, 16])
def test_shards_against_brute_force(spark, n):
    frame = spark.read.parquet(DATA.replace("0.001", "0.01") + "/documents.parquet").select("doc_id", "text")
    docs = [tuple(r) for r in frame.collect()]
    size, shards_of = _check_shards(docs, shards.shard(frame, n, ranges=8).collect(), n, 2.5 * max(len((t or "").encode()) + 1 for _, t in docs))
    assert all(len(v) == 1 for v in shards_of.values())


def test_shards_keep_groups_whole_and_cut_only_what_is_larger(spark):
    docs = [(i, "a" * 99) for i in range(400)]  # a third of all bytes: more than a shard
    docs += [(1000 + 100 * k + i, f"group {k} " + "b" * 91) for k in range(9) for i in range(40)]  # 0.6 of a shard each
    docs += [(5000 + i, f"{i:05d}" * 10) for i in range(900)]
    frame = spark.createDataFrame(docs, DOC).repartition(5)
    size, shards_of = _check_shards(docs, shards.shard(frame, 16, ranges=8).collect(), 16, 400)
    whole = {t: len(v) for t, v in shards_of.items()}
    assert 6 <= whole.pop("a" * 99) <= 8 and set(whole.values()) == {1}


def test_shard_edges(spark, edge):
    assert sorted((r.doc_id is None, r.doc_id, r.size) for r in shards.shard(edge, 2).collect()) == sorted((d is None, d, len((t or "").encode()) + 1) for d, t in EDGE)
    assert shards.shard(edge.limit(0)).count() == 0


def _near(docs, percent=85):
    sets = []
    for _, t in docs:
        w = _words(t, r"[^\x20\x09-\x0D]+")
        sets.append(frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset())
    up = list(range(len(docs)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(docs)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                up[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return sorted(((d, len(sets[i]), least.get(root(i))) for i, (d, _) in enumerate(docs)), key=str)


def test_near_duplicates(spark, edge):
    rng = np.random.default_rng(3)
    base = [f"w{i}" for i in range(200)]
    docs = []
    for i in range(120):  # a group of which few pairs are far above the threshold
        w = list(base)
        for k in rng.choice(200, int(rng.integers(0, 12)), replace=False):
            w[k] = f"x{i}.{k}"
        docs.append((1000 - i, " ".join(w)))
    docs += [(i, f"other text number {i} with a few words") for i in range(20)] + EDGE
    got = near_dedup.near_duplicates(spark.createDataFrame(docs, DOC)).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == _near(docs)
    assert all(n == 1 for n in collections.Counter(r.component_id for r in got if r.kept and r.n_shingles).values())
    assert near_dedup.near_duplicates(edge.limit(0)).count() == 0


def test_near_duplicates_when_splits_change_between_scans(spark, monkeypatch):
    folder = DATA.replace("0.001", "0.01")
    want = sorted(map(tuple, near_dedup.near_duplicates(spark.read.parquet(f"{folder}/documents.parquet")).collect()))
    calls, keys = [], {"spark.sql.files.maxPartitionBytes": "200000", "spark.sql.files.openCostInBytes": "0"}

    def after_first(df, name):
        out = written(df, name)
        if not calls:
            for k, v in keys.items():
                spark.conf.set(k, v)
        calls.append(name)
        return out

    monkeypatch.setattr(near_dedup, "written", after_first)
    try:
        got = sorted(map(tuple, near_dedup.near_duplicates(spark.read.parquet(f"{folder}/documents.parquet")).collect()))
    finally:
        for k in keys:
            spark.conf.unset(k)
    assert got == want


def test_a_cluster_must_name_a_shared_folder(monkeypatch):
    class Session:
        conf = {}
        sparkContext = type("Context", (), {"master": "spark://host:7077"})

    with pytest.raises(ValueError):
        store.shared_dir(Session())


def test_components(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, 101), (103, 101), (7, 7), (101, 100)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(51)}, 100: 100, 101: 100, 103: 100}


def test_chat_masks_hold_the_assistants_words(spark):
    rows = [(1, 0, "ann", "hi <|x"), (1, 1, "bob", "yo"), (1, 70, "ann", None), (1, None, None, "é"), (None, 0, "a|b", "z"), (1, 1, "bob", "yo")]
    got = chat.rotate_perspectives(spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, part int")).collect()
    assert {(r.conv_id, r.perspective) for r in got} == {(1, "ann"), (1, "bob"), (1, "unknown"), (None, "a_b")}
    for r in got:
        said = [r.rendered[int(a) : int(b)] for a, _, b in (m.partition("-") for m in r["mask"].split(",") if m)]
        assert sum(map(len, said)) == r.n_masked
        assert said == re.findall(r"<\|assistant\|>\n(.*)\n", r.rendered)
    assert chat.rotate_perspectives(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def test_language_held_out(spark, edge):
    rows = q.op6_language(spark, DATA.replace("0.001", "0.01")).join(spark.read.parquet(DATA.replace("0.001", "0.01") + "/documents.parquet"), "doc_id").filter("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.97 * len(rows)
    model = language.Model({"a": ["aba caba dab acab a"], "b": ["xyz zyx yxz"]})
    got = language.identify(edge, model).collect()
    assert [r.lang_pred for r in got if r.text in (None, "", "12 34 !!")] == ["und"] * 4 and len(got) == len(EDGE)
    assert language.identify(edge, language.Model({})).first().lang_pred == "und"
    assert language.predict(["Bacab a dab", "yxz"], model)[0][0] == "a"


@pytest.mark.parametrize("block", [1024, 7, 2])  # small blocks begin within phrases all the time
def test_cross_parsing_equals_greedy_search(monkeypatch, block):
    monkeypatch.setattr(language, "BLOCK", block)
    rng = np.random.default_rng(0)
    samples = ["".join(rng.choice(list("abcé"), 60)), "cab" * 9, "中文字" * 3 + "文中"]
    model = language.Model({str(i): [x] for i, x in enumerate(samples)})
    parser = language.Parser(model.key())
    texts = ["".join(rng.choice(list("abcdé中文字"), int(n))) for n in rng.integers(1, 90, 60)] + ["cab" * 40, "", "中文字" * 30]
    data, lens, _ = language._letters(texts)
    for row, known in zip(parser.phrases(data, lens), (x.encode() for x in samples)):
        for t, n in zip((x.encode() for x in texts), row):
            at = count = 0
            while at < len(t):
                k = 1
                while at + k < len(t) and t[at : at + k + 1] in known:
                    k += 1
                at, count = at + k, count + 1
            assert count == n


def test_language_of_long_rows_and_large_alphabets(spark):
    rng = np.random.default_rng(1)
    def said(letters, n):
        words = ["".join(rng.choice(letters, int(k))) for k in rng.integers(2, 5, 40)]
        return [" ".join(rng.choice(words, n)) for _ in range(12)]
    han, kana = [chr(0x4E00 + i) for i in range(400)], [chr(0x3041 + i) for i in range(80)]
    rows = [(lang, t) for lang, texts in (("zh", said(han, 80)), ("ja", said(kana, 80)), ("long", said(list("abcdefg"), 30_000)), ("en", said(list("etaoin"), 80))) for t in texts]
    docs = spark.createDataFrame([(i, t, lang, 1.0) for i, (lang, t) in enumerate(rows)], DOC + ", lang string, bits double")
    got = language.identify(docs).collect()
    assert all(r.lang == r.lang_pred for r in got) and len(got) == len(rows)
    assert language.identify(docs.limit(0)).count() == 0


@pytest.mark.parametrize("fan", [lm_score.FAN, 2])  # with 2, parts are merged and split again on three levels
def test_lm_score_against_brute_force(spark, edge, monkeypatch, fan):
    monkeypatch.setattr(lm_score, "RUN_BYTES", 60)
    docs = [*EDGE, *[(10 + i, "the cat sat on the mat") for i in range(3)], *[(20 + i, f"the dog sat on a mat {i} and the cat sat") for i in range(6)]]
    words = [_words(t, r"[^\x20\x09-\x0D]+") for _, t in docs]
    own = [collections.Counter(tuple(w[i : i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1)) for w in words]
    c = sum(own, collections.Counter())

    def scored(k):
        w, total, back = words[k], 0.0, 0
        n_all = max(1, sum(map(len, words)) - len(w))
        for i in range(len(w)):
            top = min(3, i + 1)
            known = [n for n in range(top, 0, -1) if c[g := tuple(w[i - n + 1 : i + 1])] > own[k][g]]
            back += not known or known[0] < top
            if not known:
                total += top * np.log(0.4) - np.log(n_all)
                continue
            g = tuple(w[i - known[0] + 1 : i + 1])
            context = c[g[:-1]] - own[k][g[:-1]] if len(g) > 1 else n_all
            total += np.log((c[g] - own[k][g]) / context) + (top - known[0]) * np.log(0.4)
        return len(w), back, round(total, 6)

    want = sorted((d is None, d or 0, *scored(k)) for k, (d, _) in enumerate(docs))
    frame = spark.createDataFrame([(*d, 1) for d in docs], DOC + ", n_words int").repartition(3)
    got = lm_score.score_documents(frame, bucket_bytes=64, fan=fan).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_words, r.n_backoff, round(r.log_score, 6)) for r in got) == want
    assert lm_score.score_documents(edge.limit(0)).count() == 0


def test_warc_segments_in_other_files(spark, monkeypatch):
    monkeypatch.setattr(warc, "RECORDS_PER_FILE", 2)
    rows = [(1, None, None), (1, None, None), (None, "u\r\nv", "a" * 150), (2, "u", "a" * 150), (2, "u", "a" * 150), (3, "u", "é\r\n\r\nWARC/1.1\r\n" * 9000), (4, "u", "b" * 99), (5, "u", "b" * 99)]
    got = warc.archive_round_trip(spark.createDataFrame([(*r, 0) for r in rows], "page_id long, url string, html string, total int")).collect()
    want = sorted((str(p), len((h or "").encode()), hashlib.sha256((h or "").encode()).hexdigest()) for p, _, h in rows)
    assert sorted((str(r.page_id), r.payload_bytes, r.payload_digest) for r in got) == want
    assert collections.Counter((r.record_type, r.refers_to) for r in got) == {("response", None): 6, ("revisit", 2): 2}
    with pytest.raises(ValueError):
        warc.reassemble([(1, b"ab", None), (3, b"c", 3)])
    assert warc.dechunk(b"3;x=1\r\nabc\r\n0\r\n\r\n") == b"abc"


def test_warc_revisits_are_looked_up(spark):
    names = "origin string, page_id long, url string, record_type string, refers string, payload_bytes long, payload_digest string"
    response, revisit = ("a", 1, "u", "response", None, 7, "d"), ("b", 2, "u", "revisit", "a", None, "d")
    got = warc.resolved(spark.createDataFrame([response, revisit], names)).collect()
    assert [(r.page_id, r.refers_to, r.payload_bytes) for r in sorted(got)] == [(1, None, 7), (2, 1, 7)]
    for wrong in (("b", 2, "u", "revisit", "gone", None, "d"), ("b", 2, "u", "revisit", "a", None, "other")):
        with pytest.raises(Exception, match="refers to no record"):
            warc.resolved(spark.createDataFrame([response, wrong], names)).collect()


def test_warc_records_are_members(spark, tmp_path):
    warc.write_archives(spark.createDataFrame([(i, "u", "page %d " % i * 20) for i in range(5)], "page_id long, url string, html string").coalesce(1), f"{tmp_path}/w")
    (raw,) = [p.read_bytes() for p in (tmp_path / "w").glob("part-*")]
    alone = [x for x in (m[:-len(warc.NOTHING)] for m in re.split(b"(?<=" + re.escape(warc.NOTHING) + b")", raw)) if x]
    assert [len(list(warc.records(warc.unzipped(x)))) for x in alone] == [1] * 5 and len(list(warc.records(warc.unzipped(raw)))) == 5
    assert warc.archive_round_trip(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_warc_when_splits_change_between_scans(spark, monkeypatch):
    folder = DATA.replace("0.001", "0.01")
    pages = spark.read.parquet(f"{folder}/pages.parquet")
    twice, calls = pages.unionByName(pages), []

    def after_first(df, name):
        out = written(df, name)
        if not calls:
            spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
        calls.append(name)
        return out

    monkeypatch.setattr(warc, "written", after_first)
    try:
        got = warc.archive_round_trip(twice).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    long = [r for r in got if r.payload_bytes >= 100]
    assert len(got) == twice.count() and collections.Counter(r.record_type for r in long)["response"] == len({r.payload_digest for r in long})


def test_licenses_against_brute_force(spark, edge):
    notice = licenses.TEMPLATES["MIT"]
    changed = notice.replace("free of charge", "at no charge whatever").replace("Software", "Work", 1)
    docs = [(1, "x " + notice + " y"), (2, "Ünö " + changed), (3, "released UNDER the mit license"), (4, "the mit licence"), (5, notice + " gap " + notice), (6, "word " * 3000 + "Licensed under CC BY-NC 4.0")]
    got = licenses.scan_licenses(spark.createDataFrame(docs + EDGE, DOC)).collect()
    assert collections.Counter((r.doc_id, r.license) for r in got) == {(1, "MIT"): 1, (2, "MIT"): 1, (3, "MIT/line"): 1, (5, "MIT"): 2, (6, "CC-BY-NC-4.0/line"): 1}
    text = dict(docs)
    for r in got:
        span = text[r.doc_id].encode()[r.first_byte : r.end_byte].decode()
        if r.coverage == 1 and r.doc_id != 2:
            assert re.findall(r"\w+", span.lower()) == re.findall(r"\w+", licenses.TEMPLATES[r.license].lower())
    for r in (r for r in got if r.doc_id == 2):  # the longest common subsequence bounds the matches
        a, b = (re.findall(r"\w+", x.lower()) for x in (notice, changed))
        row = [0] * (len(b) + 1)
        for x in a:
            new = [0]
            for j, y in enumerate(b):
                new.append(row[j] + 1 if x == y else max(new[-1], row[j + 1]))
            row = new
        assert r.matched == row[-1]


def test_licenses_adjacent_and_scattered(spark):
    line, cc = "Released under the MIT License. ", "Licensed under CC BY-NC 4.0. "
    docs = [(1, line * 3), (2, cc * 2), (3, "Licensed under the Apache License, Version 2.0. " * 2), (4, "Released under our MIT License"), (5, line + "Released under our MIT License. " + line), (6, "under the MIT License"), (7, "Released now under what the old MIT style License"), (8, "Released under our own License"), (9, line + "under the MIT License. " + "x " * 30 + line)]
    got = licenses.scan_licenses(spark.createDataFrame(docs, DOC)).collect()
    assert collections.Counter((r.doc_id, r.license, r.matched) for r in got) == {(1, "MIT/line", 5): 3, (2, "CC-BY-NC-4.0/line", 7): 2, (3, "Apache-2.0/line", 8): 2, (4, "MIT/line", 4): 1, (5, "MIT/line", 5): 2, (5, "MIT/line", 4): 1, (6, "MIT/line", 4): 1, (7, "MIT/line", 5): 1, (9, "MIT/line", 5): 2, (9, "MIT/line", 4): 1}


def test_every_license_once_to_five_times(spark):
    """Each template by itself, repeated side by side, is found as often at full coverage, where no other template contains it."""
    names = sorted(licenses.TEMPLATES)
    docs = [(100 * i + n, " ".join([licenses.TEMPLATES[name]] * n)) for i, name in enumerate(names) for n in range(1, 6)]
    got = collections.Counter((r.doc_id, r.license) for r in licenses.scan_licenses(spark.createDataFrame(docs, DOC)).collect() if r.coverage == 1)
    assert all(got[100 * i + n, name] == n for i, name in enumerate(names) for n in range(1, 6))
    assert len({n.partition("/")[0] for n in names}) >= 20
    clash = spark.createDataFrame([(1, licenses.TEMPLATES["ISC"], "x", 0)], DOC + ", license string, matched int")
    assert [r.license for r in licenses.scan_licenses(clash).collect()] == ["ISC"]
    assert licenses.scan_licenses(clash.limit(0)).count() == 0


def test_packing_round_trip(spark, edge):
    encoder = packing.Encoder(q.tokenizer_path())
    odd = [(7, "Don't we'LL x's '' <|ENDOFTEXT|> <|endoftext|> a<|b"), (8, "H\u0331 \u1e96 \u0130x I\u0307 \u03a3\u03a3 \u03c3"), (9, "a\x1cb \x1f A\xa0B\u2003C\u0085D \x00"), (10, "12/34 A1b2 ,., ;a; \u00e9t\u00e9, \u4e2d\u6587\u3002"), (11, "x" * 70_000)]
    docs = [tuple(r) for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()] + EDGE + odd
    want = collections.Counter((d, ids) for (d, _), ids in zip(docs, (encoder._slow([t or ""])[0] + packing._END for _, t in docs)))
    frame = spark.createDataFrame([(*r, 3, "x") for r in docs], DOC + ", length int, start string").repartition(4)
    rows = packing.pack_documents(frame, q.tokenizer_path(), block_tokens=50_000).collect()
    seqs, by_doc = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        seqs[r.sequence_id].append((r.offset, r.length))
        by_doc[r.doc_id, r.doc_tokens].append((r.start, r.length, r.ids_crc32))
    for s in seqs.values():
        at = 0
        for offset, n in sorted(s):
            assert offset == at
            at += n
        assert at <= 2048
    for (d, n), pieces in by_doc.items():  # rows that share id and length can't be told apart: their pieces are those of one after the other
        of = [ids for (doc, ids), times in want.items() if doc == d and len(ids) == 4 * n for _ in range(times)]
        assert of and sum(p[1] for p in pieces) == n * len(of)
        for start, length, crc in pieces:
            assert crc in {zlib.crc32(ids[4 * start : 4 * (start + length)]) for ids in of}
        if len(of) == 1:
            at = 0
            for start, length, _ in sorted(pieces):
                assert start == at
                at += length
    assert {(d, len(ids) // 4) for d, ids in want} == set(by_doc)
    used = sum(r.length for r in rows)
    assert used == sum(len(ids) // 4 * n for (_, ids), n in want.items())
    assert len(seqs) * 2048 - used <= 2048 * (used // 50_000 + 1 + 4)
    assert packing.pack_documents(frame.limit(0), q.tokenizer_path()).count() == 0


@pytest.mark.parametrize("length", [1, 7, 16])
def test_packs_leave_one_sequence_unfilled_at_most(length):
    rng = np.random.default_rng(length)
    for _ in range(200):
        sizes = rng.integers(1, 60, int(rng.integers(0, 50))).tolist()
        used, of = collections.defaultdict(list), collections.defaultdict(list)
        for d, start, n, q_, offset in packing.pack(sizes, length):
            used[q_].append((offset, n))
            of[d].append((start, n))
        for parts in (*used.values(), *of.values()):
            at = 0
            for begin, n in sorted(parts):
                assert begin == at and n > 0
                at += n
        assert [sum(n for _, n in of[d]) for d in range(len(sizes))] == sizes
        assert sum(sum(n for _, n in v) < length for v in used.values()) <= 1


def test_pipeline_stages(spark):
    import corpus_pipeline as p

    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    odd = spark.createDataFrame([(10**6, None), (10**6 + 1, "123 !"), (10**6 + 2, docs.first().text)], DOC)
    at = docs.unionByName(odd, allowMissingColumns=True)
    before = [(r.doc_id, r.text) for r in at.collect()]
    for name, stage in p.STAGES:
        out = stage(spark, at, DATA)
        if name == "pack":
            assert {r.doc_id for r in out.select("doc_id").collect()} == {d for d, _ in before}
            break
        after = [(r.doc_id, r.text) for r in out.collect()]
        assert out.columns == docs.columns and set(after) <= set(before)
        gone = {d for d, _ in before} - {d for d, _ in after}
        if name == "language":
            want = {10**6, 10**6 + 1}
        elif name == "exact_dedup":
            first = {}
            for d, t in sorted(before):
                first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t), d)
            want = {d for d, _ in before} - set(first.values())
        elif name == "near_dedup":
            want = {d for d, _, c in _near(before, p.NEAR) if d != c}
        else:
            items = [tuple(r) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
            want = {r[0] for r in _contamination(before, items) if r[5]}
        assert gone == want, name
        at, before = spark.createDataFrame([tuple(r) for r in out.collect()], docs.schema), after


def test_pipeline_stages_on_repeated_rows_shared_and_null_ids(spark, tmp_path):
    import corpus_pipeline as p

    item = " ".join(f"w{i}" for i in range(40))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    words = [f"v{i}" for i in range(60)]
    near = " ".join([*words[:-1], "other"])
    stages = dict(p.STAGES)

    def left(name, rows):
        spark.createDataFrame([(d, t, "en", "s", 0) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(path := f"{tmp_path}/{name}")
        return sorted(((r.doc_id, r.text) for r in stages[name](spark, spark.read.parquet(path), str(tmp_path)).collect()), key=str)

    a = " ".join(words)
    got = left("exact_dedup", [(1, "one two"), (1, "one two"), (2, "one  two"), (3, "shared"), (4, "lone"), (4, "shared"), (None, "shared"), (None, "null"), (None, "null"), (None, "else")])
    assert got == sorted([(1, "one two"), (3, "shared"), (4, "lone"), (None, "null"), (None, "else")], key=str)
    got = left("near_dedup", [(1, a), (1, a), (2, near), (2, "quite another text of some words"), (2, None), (2, None), (None, a), (None, "one more text without an id"), (None, "one more text without an id"), (None, "and some other text without one"), (None, None), (None, " ")])
    assert got == sorted([(1, a), (2, "quite another text of some words"), (2, None), (2, None), (None, "one more text without an id"), (None, "and some other text without one"), (None, None), (None, " ")], key=str)
    got = left("decontaminate", [(1, item), (1, "clean"), (None, item), (None, "clean as well"), (2, "clean"), (2, "clean")])
    assert got == sorted([(1, "clean"), (None, "clean as well"), (2, "clean"), (2, "clean")], key=str)
