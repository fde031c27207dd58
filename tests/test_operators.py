from pyspark.sql import functions as F

from inkstrata.functions import text as X
from inkstrata.operators import assemble as A
from inkstrata.operators import classify as C
from inkstrata.operators import quality as Q
from inkstrata.sources import tables as T
from inkstrata.streaming import events as E


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "x string").select(f(F.col("x"))).first()[0]


def test_repairs(spark):
    assert one(spark, "METHODS", X.repaired_extraction) == "## Methods"
    assert one(spark, ">75 year", X.repaired_extraction) == "\\>75 year"
    assert one(spark, "AC 25", X.repaired_markdown) == "€25"
    assert one(spark, "42: Analyses", X.repaired_markdown) == "Table 42: Analyses"
    assert one(spark, "COSTEFFECTIVENESS", X.hyphenated) == "COST-EFFECTIVENESS"
    assert one(spark, "Figure 2: survival curve", X.caption_type) == "kaplan-meier"
    assert one(spark, "Photo", X.caption_type) is None
    assert one(spark, "Bad  Thing!", X.slug) == "bad-thing"


def test_domains(spark):
    assert one(spark, "an officer", C.domain) == "health_economics"  # icer is a substring
    assert one(spark, "placebo and clearance", C.domain) == "clinical_trial"  # the first on ties
    assert one(spark, "nothing", C.domain) == "general"


def test_vector_rule(spark):
    df = spark.createDataFrame([(60, 0.5), (8, 5.0), (6, 50.0)], "d int, a double")
    assert [r[0] for r in df.select(C.has_vector_content(F.col("d"), F.col("a"))).collect()] == [False, True, False]


def test_gate(spark):
    docs = spark.createDataFrame([(1,), (2,), (3,)], "doc_id long")
    issues = spark.createDataFrame([(1, "INFO"), (1, "WARN"), (2, "WARN"), (2, "FAIL")], "doc_id long, severity string")
    assert {r.doc_id: r.exit_code for r in Q.gate(docs, issues).collect()} == {1: 2, 2: 1, 3: 0}


def test_upsert_is_idempotent(spark):
    old = spark.createDataFrame([("h", "2024", "a")], "source_hash string, converted_at string, output_path string")
    new = spark.createDataFrame([("h", "2025", "b"), ("k", "2025", "c")], old.schema)
    once = A.upsert(old, new, ["source_hash"])
    assert sorted(map(tuple, A.upsert(once, new, ["source_hash"]).collect())) == sorted(map(tuple, once.collect())) == [("h", "2025", "b"), ("k", "2025", "c")]


def test_text_reader(spark, tmp_path):
    (tmp_path / "a_b-c.txt").write_bytes("é".encode())
    (tmp_path / "d.txt").write_bytes("é".encode("latin-1"))
    assert sorted((r.title, r.text) for r in T.read_text_files(spark, str(tmp_path)).collect()) == [("a b c", "é"), ("d", "é")]


def test_json_reader(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"filename": "x.png", "page": 3}')
    (tmp_path / "b.json").write_text("{broken")
    rows = {r.filename: r for r in T.read_json(spark, str(tmp_path)).collect()}
    assert rows["x.png"].page == 3 and rows[None]._corrupt


def test_stream_equals_batch(spark, tmp_path):
    events = spark.createDataFrame([(i, "a" if i % 3 else "b") for i in range(50)], "i long, event_type string").select((F.lit("2024-01-01 00:00:00").cast("timestamp") + F.make_interval(mins=F.col("i") * 7)).alias("ts"), "event_type")
    events.write.parquet(str(tmp_path / "in"))
    q = E.windowed_counts(E.event_stream(spark, str(tmp_path / "in"), events.schema)).writeStream.outputMode("complete").format("memory").queryName("w").start()
    q.processAllAvailable()
    q.stop()
    assert sorted(map(tuple, spark.table("w").collect())) == sorted(map(tuple, E.windowed_counts(events).collect()))


def test_all_domain_compounds_get_their_hyphens(spark):
    assert len(X.DOMAIN_COMPOUNDS) == 83 and set(X.COMPOUNDS) <= set(X.DOMAIN_COMPOUNDS)
    want = [" ".join((c, c[0].upper() + c[1:], c.upper())) for c in [*X.DOMAIN_COMPOUNDS, "long-term", "quality-of-life", "evidence-based", "progression-free"]]
    df = spark.createDataFrame([(" ".join(want).replace("-", "") + " xlongterm longtermx",)], "t string")
    assert df.select(X.hyphenated(F.col("t"))).first()[0] == " ".join(want) + " xlongterm longtermx"
