"""What replaced gathered groups and full matrices gives the same rows, and the plans are those that were meant."""

import hashlib
import random
from xml.etree import ElementTree as ET

import duckdb
import pytest
from conftest import rows
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from stemmata.functions import streams
from stemmata.functions.text import slug
from stemmata.operators import alignment, apparatus, audit, intervals, numbering
from stemmata.plans import catalogue, codices, edition, editions
from stemmata.plans.oracles import SQL
from stemmata.sinks import dataset, release
from stemmata.sources import grammar, xml
from stemmata.storage import kept


def test_digests_stream(spark):
    rng = random.Random(2)
    data = [(rng.choice([None, "a", "b"]), i, rng.choice(["x", "é😀", "", None])) for i in range(500)] + [("none", 1, None)]
    df = spark.createDataFrame(data, "g string, i int, t string").repartition(7)
    want = []
    for g in (None, "a", "b"):
        said = [t for h, _, t in sorted(data, key=lambda r: r[1]) if h == g and t is not None]
        text = "\n".join(said)
        want.append((g, len(said), len(text), hashlib.sha256(text.encode()).hexdigest()))
    assert rows(streams.digests(df, ["g"], [F.col("i")], F.col("t"), "\n")) == sorted(want, key=repr)
    assert streams.digests(df.limit(0), ["g"], [F.col("i")], F.col("t"), " ").collect() == []


def test_a_witness_without_words_has_the_empty_digest(spark):
    df = spark.createDataFrame([("w", 1, ""), ("w", 2, ""), ("x", 1, "b"), ("x", 0, "a")], "witness string, unit int, text string")
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert rows(apparatus.witness_digest(df, ["unit"])) == [("w", 0, sha("")), ("x", 3, sha("a b"))]


@pytest.mark.parametrize("seed", range(2))
def test_counts_are_those_of_the_matrix(spark, seed):
    rng = random.Random(seed)
    units = [(v, u) for v in "abc" for u in range(rng.randint(0, 6))]
    witnesses = [(v, w) for v in "abcd" for w in "PQR" if rng.random() < 0.8]
    said = {(v, u, w): rng.choice(["", "x", "y z"]) for v, u in units for _, w in witnesses if rng.random() < 0.6} | {("a", 99, "P"): "nowhere"}
    u = spark.createDataFrame(units, "v string, unit int")
    w = spark.createDataFrame(witnesses, "v string, witness string")
    a = spark.createDataFrame([(*k, t) for k, t in said.items()], "v string, unit int, witness string, text string")
    matrix = apparatus.witness_matrix(u, w, a, ["v"])
    assert rows(apparatus.counted_coverage(u, w, a, ["v"])) == rows(apparatus.coverage(matrix, ["v", "witness"]))
    assert rows(apparatus.counted_text(u, w, a, ["v"])) == rows(apparatus.attested_text(matrix, ["v", "witness"], ["unit"]))


def test_dense_ids_cut_within_one_leading_value(spark):
    """One version holds nearly all rows: its ranges are cut by the rest of the order."""
    data = [("a", i, i % 3) for i in range(4000)] + [("b", 1, 0), (None, 5, 5)]
    df = spark.createDataFrame(data, "v string, i int, j int").repartition(5)
    found = numbering.dense_ids(df, ["v", "i", "j"], "n", ranges=8)
    assert [r.n for r in found.orderBy("n").collect()] == list(range(1, len(data) + 1))
    assert [tuple(r) for r in found.orderBy("n").select("v", "i").collect()] == sorted(((v, i) for v, i, _ in data), key=lambda r: (r[0] is not None, r))
    assert found.inputFiles() and len(found.inputFiles()) >= 7
    assert numbering.dense_ids(df.limit(0), ["v"], "n").collect() == []
    assert rows(numbering.dense_ids(df, ["v", "i", "j"], "n", start=10).agg(F.min("n"), F.max("n"))) == [(10, len(data) + 9)]


def test_blocks_of_keys_of_any_kind(spark):
    one = spark.createDataFrame([(2,), (10,), (2,)], "k int")
    two = spark.createDataFrame([("b", 10), ("b", 9), ("a", None)], "t string, k long")
    found = numbering.type_blocks({"one": (one, ["k"]), "none": (one.limit(0), ["k"]), "two": (two, ["t", "k"])})
    assert rows(found.select("node", "otype", "key")) == [(1, "one", "2"), (2, "one", "10"), (3, "two", "a"), (4, "two", "b/9"), (5, "two", "b/10")]


def test_slots_are_covered(spark):
    slots = spark.createDataFrame([("a",), ("b",), ("c",), ("c",)], "slot string")
    owners = spark.createDataFrame([("x", "a"), ("x", "a"), ("x", "b"), ("y", "c"), ("y", "z")], "otype string, slot string")
    assert rows(audit.covered_once(slots, owners)) == [("x", 1, 1, 1), ("y", 2, 1, 0)]


def test_contracts_and_arrays_of_a_dataset(spark, tmp_path):
    df = spark.createDataFrame([(1, ["a", 'b"'], "x")], "n int, l array<string>, extra string")
    promised = T.StructType([T.StructField("l", T.ArrayType(T.StringType())), T.StructField("n", T.LongType()), T.StructField("later", T.StringType(), True, {"description": "to come"})])
    target = str(tmp_path / "data")
    dataset.write({"t": df}, target, contracts={"t": promised}, json_arrays={"t": ["l"]})
    assert [tuple(r) for r in spark.read.parquet(f"{target}/t").collect()] == [('["a", "b\\""]', 1, None)]
    path = tmp_path / "dictionary.md"
    path.write_text(dataset.dictionary({"t": promised}))
    dataset.check_dictionary(str(path), {"t": promised})
    with pytest.raises(ValueError, match="out of date"):
        dataset.check_dictionary(str(path), {"t": df.schema})


def test_a_folder_is_that_of_its_manifest(tmp_path):
    folder = tmp_path / "data"
    folder.mkdir()
    for n in ("a.parquet", "b.parquet"):
        (folder / n).write_bytes(n.encode())
    report = {"checks": {"a": True}, "status": "passed", "failed_checks": []}
    how = {"tag": "v1", "commit": "0" * 40, "upstream_commit": "1" * 40, "licence": "CC"}
    staged = release.stage({n: str(folder / n) for n in ("a.parquet", "b.parquet")}, str(tmp_path / "out"), report, **how)
    value = release.manifest(staged["archive"], report, **how)
    release.validate_folder(value, str(folder))
    (folder / "c.parquet").write_bytes(b"new")
    with pytest.raises(ValueError, match="c.parquet"):
        release.validate_folder(value, str(folder))


def test_undeclared_sigla_of_one_slug_are_one_witness(spark):
    cited = spark.createDataFrame([("v", 2, 1, "Z a"), ("v", 1, 1, "Z_a"), ("v", 1, 2, "Z-a"), ("v", 3, 1, "P"), ("v", 4, 1, "P!"), ("w", 1, 1, "Z a"), ("v", 5, 1, "Z a"), ("v", 5, 1, "Z_a")], "v string, unit int, reading int, witness string")
    declared = spark.createDataFrame([("v", "P")], "v string, witness string")
    found = rows(apparatus.merged_by_slug(cited, declared, ["v"], ["unit", "reading"]))
    assert found == [("v", 1, 1, "Z_a"), ("v", 1, 2, "Z_a"), ("v", 2, 1, "Z_a"), ("v", 3, 1, "P"), ("v", 4, 1, "P!"), ("v", 5, 1, "Z_a"), ("w", 1, 1, "Z a")]


def test_kept_tables_are_never_gathered_in_the_driver_to_be_sent_whole(spark, tmp_path):
    """60,000 rows of one long text are a few KB of files, by which Spark would broadcast them."""
    wide = kept(spark.range(60_000).withColumn("text", F.repeat(F.lit("x"), 100)), "wide")
    other = spark.range(100_000).select("id", (F.col("id") % 7).alias("n"))
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan(other.join(wide, "id"))
    assert "Broadcast" not in plan(other.join(wide.where("id > 5").select("id").distinct(), "id", "left"))


def test_records_find_their_work_without_a_join(spark):
    docs = spark.createDataFrame([(f"C{i}.xml", bytearray(f'<book filename="C{i}" title="" textStructure="fluid"><version title="V" author="" language="Greek"><divisions><division label="C" delimiter=""/></divisions><manuscripts><ms abbrev="A" language="Greek" show="yes"/></manuscripts><text><div number="1"><unit id="1"><reading option="0" mss="A">a b</reading></unit></div></text></version></book>', "utf-8")) for i in range(3)], "path string, content binary")
    tables = xml.tables_of(docs)
    assert "Join" not in tables["tokens"]._jdf.queryExecution().executedPlan().toString()
    assert sorted((r.work_id, r.word) for r in tables["tokens"].collect()) == [(f"C{i}", w) for i in range(3) for w in "ab"]
    assert {r.work_id for r in tables["works"].collect()} == {"C0", "C1", "C2"}


def test_books_are_dealt_over_all_tasks_before_they_are_parsed(spark):
    """Adaptive planning would put few bytes into one task, however long they take to parse."""
    assert editions.books(spark, "/root/testdata/sf0.001").rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert codices.books(spark, "/root/testdata/sf0.001").rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_differences_and_numbers_of_targets_take_one_grouping(spark):
    """Joins of grouped sides hold two groupings and two sorts in a task; nulls equal nothing of the other side, as in a join."""
    a, b = (spark.createDataFrame(x, "k long, m int") for x in ([(1, 1), (1, 1), (2, 1), (None, 1)], [(1, 1), (3, 1), (None, 1), (None, 1)]))
    edges = spark.createDataFrame([(1, 5), (1, 5), (1, 6), (None, 7), (9, 9)], "src long, dst long")
    nodes = spark.createDataFrame([(1,), (1,), (2,), (None,)], "node long")
    gap, drift, few = audit.key_difference(a, b, ["k"]), alignment.drift(a, b, ["k", "m"]), audit.cardinality(edges, nodes, 1, 1)
    assert rows(gap) == sorted([(2, "left"), (None, "left"), (3, "right"), (None, "right")], key=repr)
    assert rows(drift) == sorted([(1, 1, 1, 0, 1), (2, 1, 0, 0, 1), (3, 1, 0, 1, 0), (None, 1, 0, 0, 1), (None, 1, 0, 2, 0)], key=repr)
    assert rows(few) == sorted([(1, 2), (2, 0), (None, 0)], key=repr)
    for df in (gap, drift, few):
        assert "Join" not in df._jdf.queryExecution().executedPlan().toString()


def test_token_audit_reads_each_document_by_itself(spark, tmp_path):
    """Keys repeat or are null, and a line separator at the end is a word: as in SQL, by row, without a shuffle."""
    docs = [(1, "a  b"), (1, " c\n"), (None, "d"), (None, None), (2, "e \u2028"), (3, "f \u0085 "), (4, " \t")]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    df = catalogue.token_reconstruction_audit(spark, str(tmp_path))
    assert rows(df) == sorted([(1, 2, True), (1, 1, True), (None, 1, True), (None, 0, True), (2, 2, True), (3, 2, True), (4, 0, True)], key=repr)
    want = duckdb.sql(f"WITH documents AS (SELECT * FROM '{tmp_path}/documents.parquet/*.parquet') {SQL['token_reconstruction_audit']}").fetchall()
    assert rows(df) == sorted(want, key=repr)
    assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()


def test_coverage_is_counted_by_key(spark, tmp_path):
    """Lines that differ in where a null stands are two, equal ones are one; a type without any section covers none of them."""
    line = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp"
    a = lambda order, part, discount=0.5, tax=0.5: (order, part, 1, 1, 1.0, 1.0, discount, tax, "N", "O", None)
    lines = [a(1, 1), a(1, 1), a(1, 1, None, 0.5), a(1, 1, 0.5, None), a(2, 2, 0.0), a(2, 2, -0.0), a(None, None), a(3, None), a(None, 3)]
    spark.createDataFrame(lines, line).write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.createDataFrame([(1,), (1,), (3,), (None,), (9,)], "o_orderkey long").write.parquet(str(tmp_path / "orders.parquet"))
    spark.createDataFrame([(1, 26), (2, None)], "p_partkey long, p_size int").write.parquet(str(tmp_path / "part.parquet"))
    df = catalogue.section_coverage_exactly_once(spark, str(tmp_path)).select("otype", "n_never", "n_once", "n_several")
    assert rows(df) == [("order", 3, 1, 3), ("part", 7, 0, 0)]
    views = ", ".join(f"{t} AS (SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet')" for t in ("lineitem", "orders", "part"))
    want = duckdb.sql(f"WITH {views} SELECT * FROM ({SQL['section_coverage_exactly_once']})").fetchall()
    assert rows(df) == sorted(want, key=repr)
    spark.createDataFrame(lines[:0], line).write.parquet(str(tmp_path / "lineitem.parquet"), mode="overwrite")
    assert catalogue.section_coverage_exactly_once(spark, str(tmp_path)).collect() == []


def test_positions_of_one_table_are_sent_once(spark, tmp_path):
    """Lines without a part or of several, equal ones, unpriced ones and those of no order: as SQL joins them, though lines are sent by order once."""
    line = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp"
    rng = random.Random(5)
    lines = [(rng.choice([None, *range(12)]), rng.choice([None, *range(6)]), rng.randint(1, 3), rng.choice([None, 1, 2, 3]), rng.choice([None, 1.0, 2.0, 3.0]), 1.0, 0.1, 0.1, "N", "O", None) for _ in range(150)]
    names = [(0, "a"), (1, "b"), (1, "b"), (2, None), (3, "d"), (None, "e"), (9, "f")]
    spark.createDataFrame(lines, line).write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.createDataFrame(names, "p_partkey long, p_name string").write.parquet(str(tmp_path / "part.parquet"))
    df = catalogue.positional_threeway_join(spark, str(tmp_path))
    views = ", ".join(f"{t} AS (SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet')" for t in ("lineitem", "part"))
    want = duckdb.sql(f"WITH {views} SELECT * FROM ({SQL['positional_threeway_join']})").fetchall()
    assert rows(df) == sorted(want, key=repr)
    plan = catalogue.positional_threeway_join(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "FullOuter" not in plan and plan.count("Exchange hashpartitioning(l_orderkey") == 1


def test_ranges_in_bins_are_not_sent_whole_to_all_tasks(spark):
    """Both sides are exploded, into more rows than Spark thinks by the size of what they are made of."""
    ranges = spark.range(2000).select((F.col("id") % 7).cast("string").alias("v"), F.col("id").alias("a"), (F.col("id") + 9).alias("b"))
    other = ranges.select("v", F.col("a").alias("c"), F.col("b").alias("d"))
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan(intervals.containing(ranges, other, ["v"], inner_range=("a", "a"), outer_range=("c", "d")))


def book(work, titles, text='<div number="1"><unit id="1"><reading option="0" mss="A">a <w lex="x&amp;">b</w> c</reading></unit></div>'):
    head = '<divisions><division label="C" delimiter=""/></divisions><manuscripts><ms abbrev="A" language="Greek" show="yes"/></manuscripts>'
    versions = "".join(f'<version title="{t}" author="" language="Greek">{head}<text>{text}</text></version>' for t in titles)
    return (f"{work}.xml", bytearray(f'<book filename="{work}" title="" textStructure="fluid">{versions}</book>', "utf-8"))


def test_records_need_no_join_to_find_their_version_and_unit(spark, monkeypatch):
    """Units, readings and words are projections of the parsed table; others are not made before they are asked for."""
    written = {}
    monkeypatch.setattr(edition, "kept", lambda df, name: written.setdefault(name, df) and kept(df, name))
    docs = [book("C1", ["V", "v!", "V", "W"]), book("C2", ["V"]), book("C3", ["V", "Void"], "")]
    built = edition.build(xml.tables_of(spark.createDataFrame(docs, "path string, content binary")))
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    for name in ("versions", "divs", "units", "readings", "variant_words"):
        assert not any(x in plan(built[name]) for x in ("Join", "Window", "Exchange")), name
    assert all(not isinstance(dict.__getitem__(built.tables, n), DataFrame) for n in ("words", "sections", "manuscripts", "reading_witness"))
    for name in ("sections", "unit_sections", "manuscripts", "reading_witness"):
        assert "Broadcast" not in plan(built[name]), name
    assert {"sections", "cited"} <= written.keys() and not any("Broadcast" in plan(df) for df in written.values())
    assert rows(built["versions"].select("version_id", "is_metadata_only")) == sorted([("C1__V", False), ("C1__v", False), ("C1__V_2", False), ("C1__W", False), ("C2", False), ("C3__V", True), ("C3__Void", True)], key=repr)
    assert [r.slot for r in built["words"].orderBy("slot").collect()] == list(range(1, 16))
    assert {(r.word, r.boundary) for r in built["words"].collect()} == {("a", ""), ("b", ""), ("c", "")}


def test_ids_within_a_document_are_those_of_the_operator(spark):
    rng = random.Random(3)
    works = {f"W{i}": [rng.choice(["A", "a!", "A?", "B", "", "A 2"]) for _ in range(rng.randint(1, 7))] for i in range(30)}
    table = spark.createDataFrame([(w, i, slug(t)) for w, titles in works.items() for i, t in enumerate(titles)], "work_id string, version int, slug string")
    want = {(r.work_id, r.version): r.version_id for r in numbering.version_ids(table, order=["version"]).collect()}
    for w, titles in works.items():
        found = xml.version_ids(w, [{"title": t, "version_kind": "source", "language": ""} for t in titles])
        assert found == [want[w, i] for i in range(len(titles))]


@pytest.mark.parametrize("old, new", [
    ("", ""), ("<text>", "<text>x"), ('mss="A"', ""), ('number="1"', 'number=" "'), ('lex="x&amp;"', 'lex="&#10;{}"'), ("<manuscripts>", '<manuscripts><ms abbrev="A" language="" show=""/>'), ("<text>", "<odd/><text>"),
    ("</unit>", "</unit><unit/>"), ("</unit>", "</unit>y"), ('delimiter=""', 'delimiter="" Delimiter=""'), ("</text>", "</text><text/>"), ("<w ", "<w><w/></w><w "), ('textStructure="fluid"', 'language="Greek"'), ("b</w>", "</w>"),
])
def test_a_sound_document_breaks_no_rule(old, new):
    """The look at all elements at once passes nothing that a rule finds, and text is kept as the library writes it."""
    root = ET.fromstring(bytes(book("C1", ["V"])[1]).decode().replace(old, new) if old else bytes(book("C1", ["V"])[1]))
    file = grammar.File("C1", "C1.xml", "", grammar.REVIEWED, False)
    wrong = [what for r in grammar.elements(root, "modern") for rule in grammar.OUTER for what in rule(r, file)]
    assert not (grammar.sound(root) and wrong) and (grammar.sound(root) or wrong or "language" in root.attrib)
    for e in root.iter("w"):
        assert xml._written(e) == ET.tostring(e, encoding="unicode")
