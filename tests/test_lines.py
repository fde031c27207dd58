from pyspark.sql import functions as F

from inkstrata.functions import lines as L
from inkstrata.operators import images as I
from inkstrata.operators import metadata as M
from inkstrata.operators import structure as S


def one(spark, value, f, ddl="x string"):
    return spark.createDataFrame([(value,)], ddl).select(f(F.col("x"))).first()[0]


def test_signs_and_escapes(spark):
    assert one(spark, "95% CrI 20.26", L.repaired_signs) == "95% CrI -0.26"
    assert one(spark, "0.1, 20.26 and 20.26", L.repaired_signs) == "0.1, -0.26 and 20.26"
    assert one(spark, "P \\ 0.05", L.repaired_signs) == "P < 0.05"
    assert one(spark, "/unifb01t /uni00E9 /uniD83D", L.decoded_escapes) == "fit é /uniD83D"
    for f in (L.repaired_signs, L.decoded_escapes, L.single_spaced, L.demoted_headings, L.lifted_images, L.captioned_images):
        assert one(spark, "", f) == "" and one(spark, None, f) is None


def test_blanks(spark):
    assert one(spark, "  a   b  ", L.single_spaced) == "  a b  "
    assert one(spark, "```\na   b\n```\na   b", L.single_spaced) == "```\na   b\n```\na b"
    assert one(spark, "| a   b |", L.single_spaced) == "| a   b |"


def test_headings(spark):
    assert one(spark, "# ab\n## ab", L.demoted_headings) == "# ab\nab"
    assert one(spark, "## Long heading\n## Short", L.demoted_headings) == "## Long heading\nShort"
    assert one(spark, "## Long heading\n\n\n## Short", L.demoted_headings) == "## Long heading\n\n\n## Short"
    assert one(spark, "## The Problem", L.demoted_headings) == "## The Problem"


def test_tables(spark):
    rows = "x array<array<string>>"
    assert one(spark, [["a", "b|c"], ["d\ne"]], L.pipe_table, rows) == "| a | b\\|c |\n| --- | --- |\n| d e |  |"
    assert one(spark, [["h"]], L.pipe_table, rows) == "| h |\n| --- |"
    assert one(spark, [], L.pipe_table, rows) == ""
    assert one(spark, [[" ", None], []], L.is_empty_table, rows) and not one(spark, [["", "x"]], L.is_empty_table, rows)


def test_front_matter(spark):
    kept = lambda md: one(spark, md, lambda x: M.with_domain(x, F.lit("d")))
    assert kept("---\na: 1\n---\nx") == "---\na: 1\ndocument_domain: d\n---\nx"
    assert kept("---\ndocument_type: t\nb: 2\n---\n") == "---\ndocument_type: t\ndocument_domain: d\nb: 2\n---\n"
    assert kept(kept("---\na: 1\n---\nx")) == kept("---\na: 1\n---\nx")
    assert kept("no front") == "no front"
    assert one(spark, "Authors: Ann Lee, Bo Ek and C", M.authors) == ["Ann Lee", "Bo Ek"]
    assert one(spark, "# Abstract\n" + "a " * 400 + "\n# B\nz", M.abstract) == ("a " * 400)[:500]


def test_blank_needs_known_measurements(spark):
    d = spark.createDataFrame([(None,) * 7, (1500, 9, 9, 100.0, 50.0, 90, None), (9000, 900, 900, 100.0, 60.0, 90, None), (9000, 90, 90, 100.0, 1.0, 90, 100.0)], "size_bytes long, width long, height long, mean double, std double, colors long, alpha double")
    assert [r[0] for r in d.select(I.is_blank(*[F.col(c) for c in I.PIXELS])).collect()] == [False, True, False, False]


def test_zones_are_left_alone(spark):
    upper = lambda x: L.outside_zones(x, F.upper)
    assert one(spark, "a `b` ```c``` d <!-- e\n--> f http://g/h i", upper) == "A `B` ```c``` D <!-- e\n--> F http://g/h I"
    assert one(spark, "Table.10/results of ab.cd/e", upper) == "TABLE.10/RESULTS OF ab.cd/e"
    assert one(spark, "", upper) == "" and one(spark, None, upper) is None


def test_headings_by_role(spark):
    def levels(*marks):
        df = spark.createDataFrame([(1, i, x) for i, x in enumerate(marks)], "doc_id long, line_no long, line string")
        return [r["line"] for r in S.releveled(df).orderBy("line_no").collect()]

    assert levels("## A sufficiently long title", "# methods", "### a", "#### b", "##### c", "##### d") == ["# A sufficiently long title", "## methods", "### a", "#### b", "#### c", "### d"]
    assert levels("# BMJ", "### Short", "## **Results**", "text", None) == ["", "# Short", "## **Results**", "text", None]
    assert levels("## Results", "# Another heading of length") == ["# Results", "## Another heading of length"]
    assert levels("plain") == ["plain"]


def test_spacing(spark):
    assert one(spark, "don ' t , ( a ) cost - effective 95 % 3 - 4 b", L.closed_spacing) == "don't, (a) cost-effective 95% 3 - 4 b"
    assert one(spark, "a-\nb-\nc -\nd", L.joined_hyphen_breaks) == "a-b-c -\nd"
    assert one(spark, None, L.closed_spacing) is None
