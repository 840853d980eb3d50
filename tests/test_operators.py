import pytest
from conftest import rows
from pyspark.sql import functions as F
from stemmata.functions import text
from stemmata.functions.unicode import lexical
from stemmata.operators import alignment, apparatus, audit, catalog, guards, numbering, sections
from stemmata.streaming import sessions, windowed_counts


def test_text_rules(spark):
    df = spark.createDataFrame([(" a\t​b ", "doubleFollowing", "en_7", "a b~*")], "a string, b string, c string, d string")
    got = df.select(text.plain_text(F.col("a")), text.boundary(F.col("b")), text.without_language(F.col("c"), F.lit("en")), text.url_encoded(F.col("d")), text.html_escaped(F.lit("<a href='x'>&\""))).first()
    assert tuple(got) == ("a b", "\n\n", "7", "a+b~%2A", "&lt;a href=&#x27;x&#x27;&gt;&amp;&quot;")
    assert text.slug(" é-x  Ω! ") == "é_x_Ω" and text.slug("--") == "version"
    assert lexical("«λόγος,»") == "λόγος" and lexical("..") == ""
    assert spark.range(1).select(text.git_blob_sha1(F.encode(F.lit("hello\n"), "utf-8"))).first()[0] == "ce013625030ba8dba906f756967f9e9ca394464a"


def test_addresses_of_comparisons():
    assert text.comparison_address("W", 1, " 2 ") == "/compare?work=W&chapter=1&verse=2"
    assert text.comparison_address("W", 1, 2, []) == "/compare?work=W&chapter=1&verse=2&version="
    assert text.comparison_address("W", 1, 2, ["a", "b", "a"], {"b": [], "z": ["q"]}) == "/compare?work=W&chapter=1&verse=2&version=a&version=b&witness.b="
    with pytest.raises(ValueError):
        text.comparison_address("W", "", 2)


def test_dense_ids_of_skewed_and_empty(spark):
    df = spark.range(500).select(F.when(F.col("id") < 400, 7).otherwise(F.col("id")).alias("a"), F.col("id").alias("b"))
    got = numbering.dense_ids(df, ["a", "b"], "n", ranges=8).orderBy("n").collect()
    assert [r.n for r in got] == list(range(1, 501)) and [(r.a, r.b) for r in got] == sorted((r.a, r.b) for r in got)
    assert numbering.dense_ids(df.where("false"), ["a", "b"], "n").count() == 0


def test_guards(spark):
    df = spark.createDataFrame([(1, "x"), (1, "y")], "k int, v string")
    with pytest.raises(ValueError, match="'w' is not loaded"):
        guards.require_columns(df, "k", "w")
    with pytest.raises(ValueError):
        apparatus.single_readings(df, ["k"])
    with pytest.raises(ValueError):
        apparatus.exactly_one_primary(df.withColumn("is_primary", F.lit(True)), ["k"])
    with pytest.raises(ValueError, match="unknown k"):
        apparatus.chosen(df, [2], "k")
    assert apparatus.chosen(df, [], "k").count() == 0
    assert guards.dangling(df, df.where("v = 'x'"), "v").count() == 1


def test_anchors_fall_back_to_ancestors(spark):
    divs = spark.createDataFrame([(1, ["a"]), (1, ["a", "b"]), (1, ["a", "c"]), (1, ["z"])], "version int, path array<string>")
    slots = spark.createDataFrame([(1, ["a", "b"], 5), (1, ["q"], 3)], "version int, path array<string>, slot long")
    got = {tuple(r.path): (r.slot, r.anchor_level) for r in sections.anchors(divs, sections.with_ancestors(slots), "version").collect()}
    assert got == {("a",): (5, 1), ("a", "b"): (5, 2), ("a", "c"): (5, 1), ("z",): (3, 0)}


def test_alignment(spark):
    a = spark.createDataFrame([(1, "p", 1), (2, "p", 2), (3, "q", 3)], "k int, i string, o int")
    b = spark.createDataFrame([(9, "q", 1), (8, "p", 2)], "k int, i string, o int")
    assert rows(alignment.align(a, b, ["i"], ["o"], "k").select("translation_k", "source_k")) == [(1, 8), (2, None), (3, 9)]
    with pytest.raises(ValueError):
        alignment.align(a, b, ["i"], ["o"], "k", strict=True)
    assert rows(alignment.drift(a, b, ["i"])) == [("p", 1, 0, 1), ("q", 1, 0, 0)]
    signed = alignment.signatures(a.withColumn("v", F.lit(1)).union(a.withColumn("v", F.lit(2))), ["v"], ["i"])
    assert signed.select("signature").distinct().count() == 1
    m = alignment.match_versions(signed.where("v = 1").withColumnRenamed("v", "t"), signed.withColumnRenamed("v", "s"), translation="t", source="s")
    assert rows(m) == [(1, 2, None)]
    with pytest.raises(ValueError):
        alignment.one_source_each(m)
    ranked = alignment.nearest_sources(spark.createDataFrame([(1, s, s, 0, 0) for s in range(5)], "t int, s int, common int, missing int, extra int"), "t", "s")
    assert [r.s for r in ranked.orderBy("rank").collect()] == [4, 3, 2]


def test_audits(spark):
    a = spark.createDataFrame([("x",), ("x",), ("y",)], "v string")
    assert audit.parity(a, a.limit(0), ["v"]).first() == (3, 0)
    assert audit.parity(a, a, ["v"]).first() == (0, 0)
    assert not audit.passed(audit.check("c", a)) and not audit.passed(audit.check("c", a).limit(0))
    edges = spark.createDataFrame([(1, 5), (1, 6)], "src int, dst int")
    nodes = spark.createDataFrame([(1,), (2,)], "node int")
    assert rows(audit.cardinality(edges, nodes, 1, 1)) == [(1, 2), (2, 0)]
    assert audit.endpoints(edges, "e", nodes, nodes).first()[1:] == (2, 0, 2)
    read = spark.createDataFrame([(1, i, x) for i, x in enumerate([1, 2, 1, 3])], "v int, o int, reading_index int")
    assert [(r.unit_number, r.ok) for r in audit.ordered_ownership(read, ["v"], ["o"]).orderBy("o").collect()] == [(1, True), (1, True), (2, True), (2, False)]
    assert audit.member_difference(a.distinct().withColumn("d", F.col("v")), a.distinct().withColumn("d", F.lit("x")), "v", "d").count() == 1
    assert audit.key_difference(a, a.where("v = 'y'"), ["v"]).first() == ("x", "left")


def test_labels(spark):
    v = spark.createDataFrame([("A", "T"), ("A", " T "), ("B", "T"), ("B", ""), (" ", "T")], "w string, t string")
    assert rows(catalog.work_labels(v, "w", "t")) == [("A", "T (A)"), ("B", "B")]
    with pytest.raises(ValueError):
        catalog.labels_of(spark.createDataFrame([(1, [9])], "k int, ids array<int>"), spark.createDataFrame([(1, "x")], "id int, label string"), "k")
    assert rows(catalog.attach_metadata(spark.createDataFrame([("a",), ("b",)], "w string"), spark.createDataFrame([("a", 4)], "w string, slot int"), "w")) == [("a", 4), ("b", 1)]


def test_streams(spark, tmp_path):
    spark.sql("SELECT timestamp'2024-01-01 00:05:00' + make_interval(0, 0, 0, 0, 0, id * 10) AS ts, 'u' AS user, 1.0D AS value FROM range(20)").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("ts timestamp, user string, value double").parquet(str(tmp_path / "in"))
    for k, df in enumerate((windowed_counts(stream, time="ts", keys=["user"], value="value"), sessions(stream, time="ts", keys=["user"]))):
        q = df.writeStream.outputMode("append").format("memory").queryName(f"out{k}").trigger(availableNow=True).start()
        assert q.awaitTermination(120)
    assert spark.table("out0").agg(F.sum("n")).first()[0] >= 6
