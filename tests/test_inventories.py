"""Stored indexes, vocabularies and contracts, against plain Python; and what their plans read."""

import json
import random
import re
import uuid
from collections import defaultdict

import pytest
import samples
from conftest import rows
from pyspark.sql import functions as F
from stemmata.operators import contracts, postings, vocabulary
from stemmata.plans import api, edition
from stemmata.sinks import dataset
from stemmata.sources import xml
from stemmata.sources.dataset import load_tables


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(autouse=True)
def told(spark):
    """Plans say which buckets they read; without this they only say so where a join needs the buckets."""
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
    yield
    spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")


def name():
    return f"t_{uuid.uuid4().hex}"


def test_label_index(spark, tmp_path):
    rng = random.Random(3)
    vocabulary_ = [("genre", f"g{i}") for i in range(9)] + [("figure", f"f{i}") for i in range(4)] + [("genre", "unused")]
    assigned = [(f"w{w}", kind, p, f"{kind[0]}{x}") for w in range(60) for kind, n in (("genre", 9), ("figure", 4)) for p, x in enumerate(rng.sample(range(n), rng.randint(0, 3)))]
    assigned += [(f"hot{i}", "genre", 0, "g0") for i in range(500)]
    a = spark.createDataFrame(assigned, "work string, kind string, position int, label string")
    v = spark.createDataFrame(vocabulary_, "kind string, label string")
    index = postings.LabelIndex.write(a, v, name(), folder=f"file://{tmp_path}")
    by_label, by_work = defaultdict(set), defaultdict(lambda: defaultdict(list))
    for w, kind, _, label in sorted(assigned):
        by_label[kind, label].add(w)
        by_work[w][kind].append(label)
    for kind, label in vocabulary_:
        assert [r.work for r in index.works_by(kind, label).collect()] == sorted(by_label[kind, label])
    assert {w: index[w] for w in ("w1", "w2", "hot7")} == {w: dict(by_work[w]) for w in ("w1", "w2", "hot7")}
    assert index.get("nobody") is None and index.get("nobody", 5) == 5 and [r.work for r in index.keys().collect()] == sorted(by_work)
    assert [tuple(r) for r in index.labels("genre").collect()] == sorted((x, len(by_label["genre", x])) for k, x in vocabulary_ if k == "genre")
    for missing in (lambda: index["nobody"], lambda: index.works_by("genre", "f0")):
        with pytest.raises(KeyError):
            missing()
    assert "SelectedBucketsCount: 1 out of 16" in plan_of(index.works_by("genre", "g3"))
    assert len(list((tmp_path / index.by_label.inputFiles()[0].split("/")[-2]).glob("*.parquet"))) > 16  # the hot label has several files
    for bad in ([("w", "genre", 0, "strange")], [("w", "genre", 0, "g1"), ("w", "genre", 1, "g1")]):
        with pytest.raises(ValueError, match="vocabulary|twice"):
            postings.LabelIndex.write(spark.createDataFrame(bad, a.schema), v, name(), folder=f"file://{tmp_path}")


def test_metadata_store(spark, tmp_path):
    values = [("Alpha", "title", '"A"'), ("Alpha", "fields.date", "null"), ("Alpha", "fields.n", "3"), ("Beta", "title", None)]
    store = postings.MetadataStore.write(spark.createDataFrame(values, "work string, field string, value string"), name(), folder=f"file://{tmp_path}")
    assert store["Alpha"] == store["Alpha.xml"] == {"title": "A", "fields": {"date": None, "n": 3}} and store["Beta"] == {"title": None}
    assert store.get("Gamma") is None and [r.work for r in store.keys().collect()] == ["Alpha", "Beta"]
    assert "SelectedBucketsCount: 1 out of 16" in plan_of(store.values.where("work = 'Alpha'"))
    with pytest.raises(KeyError):
        store["Gamma"]
    with pytest.raises(ValueError, match="given twice"):
        postings.MetadataStore.write(spark.createDataFrame(values[:1] * 2, "work string, field string, value string"), name(), folder=f"file://{tmp_path}")


def test_arrays_against_a_vocabulary(spark):
    docs = [None, "", "{", '{"a": 1}', '{"x": null}', '{"x": "p"}', '{"x": {"y": 1}}', '{"x": []}', '{"x": ["p", 1]}', '{"x": ["p", null]}', '{"x": [["p"]]}', '{"x": ["p", " "]}',
            '{"x": ["p", "z"]}', '{"x": ["p", "q", "p"]}', '{"x": ["q", "p"]}', '{"x": ["z", "z"]}', '["p"]']
    want = ["null", "not JSON", "not JSON", "absent", "no array", "no array", "no array", None, "no text", "no text", "no text", "blank", "unknown", "repeated", None, "unknown", "absent"]
    df = spark.createDataFrame(list(enumerate(docs)), "id int, doc string")
    found = vocabulary.checked(df, spark.createDataFrame([("p",), ("q",), ("q",)], "label string"), "id", "doc", "$.x").orderBy("id").collect()
    assert [r.reason for r in found] == want and set(want) - {None} == set(vocabulary.REASONS)
    assert [r.labels for r in found if r.reason is None] == [[], ["q", "p"]] and all(r.labels is None for r in found if r.reason)


def test_columns_in_one_pass(spark):
    data = [(i, None if i % 3 else i / 2, f"t{i % 50:03}" * 100, [i], {"a": i}) for i in range(2000)]
    df = spark.createDataFrame(data, "n long, x double, t string, l array<int>, m map<string, int>")
    found = {r.column: r for r in contracts.columns_of(df).collect()}
    assert [(found[c].position, found[c].n_rows, found[c].n_null) for c in "nxtlm"] == [(1, 2000, 0), (2, 2000, 1333), (3, 2000, 0), (4, 2000, 0), (5, 2000, 0)]
    assert (found["n"].least, found["n"].greatest, found["x"].greatest) == (0.0, 1999.0, 999.0)
    assert (found["t"].first_text, found["t"].last_text) == (("t000" * 100)[:200], ("t049" * 100)[:200]) and found["l"].first_text is None
    assert all(abs(found[c].n_distinct / n - 1) < 0.1 for c, n in (("n", 2000), ("x", 667), ("t", 50), ("l", 2000), ("m", 2000)))
    assert len(re.findall(r"Scan", plan_of(contracts.columns_of(df)))) == 1
    none = contracts.columns_of(df.limit(0)).collect()
    assert [(r.n_rows, r.n_null, r.least, r.n_distinct) for r in none] == [(0, 0, None, 0)] * 5


def test_edges_and_observed_types(spark):
    e = spark.createDataFrame([(1, 5), (1, 5), (1, 6), (2, 5), (9, 5)], "src long, dst long")
    nodes = {"a": spark.createDataFrame([(1,), (2,), (3,)], "node long"), "b": spark.createDataFrame([(1,), (2,), (9,)], "node long")}
    found = rows(contracts.edges_of({"x": contracts.Edge(e, "a", "t"), "y": contracts.Edge(e, "b", "t", 1, 2), "z": contracts.Edge(e, "b", "t", 1, 1)}, nodes))
    assert found == [("x", "a", "t", 5, 2, 1, 0, 2, False), ("y", "b", "t", 5, 3, 0, 1, 2, True), ("z", "b", "t", 5, 3, 0, 1, 2, False)]
    n = spark.createDataFrame([("word", "x", None, 1), ("unit", None, None, 2), ("word", None, None, 3)], "otype string, f string, g string, h int")
    assert rows(contracts.observed(n, ["f", "g", "h"])) == [("f", ["word"], 1), ("g", [], 0), ("h", ["unit", "word"], 3)]


def test_point_questions_read_one_bucket(spark, tmp_path):
    """A stored edition by version: a question for one version reads one bucket a table, and joins them where they are."""
    folder = samples.write(tmp_path, Alpha=samples.MODERN, Gamma=samples.COMPACT)
    built = edition.build(xml.read_editions(spark, folder, strict=False))
    prefix = name()
    dataset.store(built.tables, prefix, folder=f"file://{tmp_path}/stored", buckets=8)
    tables = load_tables(spark, prefix, built.tables)
    kept = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.requireAllClusterKeysForCoPartition")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
        a = api.Apparatus(tables)
        plan = plan_of(a.attestations("Alpha__Greek_A", 1))
        assert plan.count("SelectedBucketsCount: 1 out of 8") == plan.count("FileScan") == 3 and "Exchange" not in plan
        assert a.state("Alpha__Greek_A", 1, "Q") == "omission"
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    plain = api.Apparatus(built.tables)
    assert rows(api.Apparatus(tables).unit("Alpha__Greek_A", 2)) == rows(plain.unit("Alpha__Greek_A", 2))
    assert json.loads(spark.sql(f"DESCRIBE EXTENDED {prefix}_units AS JSON").first()[0])["statistics"]["num_rows"] == built["units"].count()
