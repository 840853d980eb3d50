import json
import zipfile

import pytest
import samples
from conftest import rows
from pyspark.sql import functions as F
from stemmata import cli
from stemmata.operators import audit
from stemmata.plans import api, edition
from stemmata.sinks import dataset, page, provenance, release
from stemmata.sources import recount, side, xml
from stemmata.sources.dataset import check_folder, load


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    return samples.write(tmp_path_factory.mktemp("sources"), Alpha=samples.MODERN, Beta=samples.LEGACY, Gamma=samples.COMPACT, Delta=samples.MIXED)


@pytest.fixture(scope="module")
def built(spark, folder, tmp_path_factory):
    e = edition.build(xml.read_editions(spark, folder, strict=False))
    target = str(tmp_path_factory.mktemp("out") / "data")
    dataset.write(e.tables, target)
    return edition.Edition({n: spark.read.parquet(f"{target}/{n}").persist() for n in e.tables}, e.warnings)


def test_versions_and_words(built):
    assert rows(built["versions"].select("version_id", "version_kind", "is_metadata_only", "source_version_id")) == [
        ("Alpha__Greek_A", "source", False, None), ("Alpha__Greek_A_2", "source", True, None), ("Alpha__translation_English_English", "generated_translation", False, "Alpha__Greek_A"),
        ("Beta", "source", False, None), ("Delta", "source", False, None), ("Gamma", "source", False, None), ("Gamma__English_Translation", "parallel_translation", False, "Gamma"),
    ]
    greek = built["words"].where("version_id = 'Alpha__Greek_A'").orderBy("slot").collect()
    assert [(w.word, w.trailer or "", w.boundary, w.is_gap) for w in greek] == [("alpha", " ", "", None), ("beta", " ", "", None), ("gamma.", "", " ", None), ("delta", "", "\n", None), (None, "", " ", 1), ("again", "", "", None)]
    assert [w.slot for w in built["words"].orderBy("slot").collect()] == list(range(1, built["words"].count() + 1))


def test_sections(built):
    found = lambda v: rows(built["sections"].where(F.col("version_id") == v).select("chapter", "label", "verse_index", "source_ref"))
    assert found("Alpha__Greek_A") == [("1", "1", 1, "1:1"), ("1", "2", 2, "1:2"), ("1", "2~2", 3, "1:2")]
    assert found("Delta") == [("P", "1", 1, "P/1"), ("P/2", "5", 2, "P/2:5")]
    assert found("Gamma") == [("1", "1.1", 1, "1.1"), ("1", "1.2", 2, "1.2")]


def test_checks_pass_and_notice_damage(spark, built, folder):
    checks = edition.checks(built)
    assert audit.passed(checks), checks.where("not ok").collect()
    parity = edition.source_parity(built, recount.inventory(xml.files(spark, folder)))
    assert parity.where("not ok").collect() == []
    broken = {
        "primary_reconstruction": ("words", lambda d: d.withColumn("word", F.when(F.col("word") == "beta", "betta").otherwise(F.col("word")))),
        "primary_exactly_one": ("readings", lambda d: d.withColumn("is_primary", F.lit(True))),
        "witness_in_version": ("manuscripts", lambda d: d.where("witness <> 'Z'")),
        "unique_addresses": ("sections", lambda d: d.withColumn("label", F.lit("1"))),
        "slots_dense": ("words", lambda d: d.where("slot <> 3")),
        "parent_of_div": ("divs", lambda d: d.where("parent is not null")),
        "translation_units_aligned": ("unit_alignment", lambda d: d.where("translation_unit <> 0")),
        "units_covered_once": ("unit_sections", lambda d: d.union(d)),
        "one_reading_a_witness": ("reading_witness", lambda d: d.union(d)),
        "reading_of_unit": ("units", lambda d: d.where("unit <> 0")),
        "generated_marker": ("versions", lambda d: d.withColumn("generation_marker", F.lit(None).cast("string"))),
        "parallel_order": ("unit_alignment", lambda d: d.withColumn("source_unit", F.lit(7))),
        "reading_indexes": ("readings", lambda d: d.withColumn("reading", F.col("reading") + 1)),
        "variant_reconstruction": ("variant_words", lambda d: d.where("variant_position = 1")),
    }
    for name, (table, damage) in broken.items():
        bad = edition.checks(edition.Edition(built.tables | {table: damage(built[table])}, built.warnings))
        assert bad.where((F.col("check") == name) & ~F.col("ok")).count() == 1, name
    with pytest.raises(ValueError, match="checks failed"):
        dataset.write({}, "/tmp/never", checks=bad)


def test_records_are_those_of_the_files(spark, built, folder):
    found = recount.records(xml.files(spark, folder)).persist()
    assert {r.kind for r in found.select("kind").distinct().collect()} | {"missing_unit_ids"} == set(recount.KINDS)
    good = edition.record_parity(built, found)
    assert good.where("not ok").collect() == [] and good.count() == len(recount.KINDS)
    change = lambda column, old, new: lambda d: d.withColumn(column, F.when(F.col(column) == old, new).otherwise(F.col(column)))
    own = {
        "readings": ("reading_payloads", change("text", "delta", "delto")),
        "manuscripts": ("manuscripts", change("name", "Papyrus1", "Papyrus")),
        "words": ("annotated_words", change("lex", "be", "he")),
        "division_specs": ("division_specs", change("label", "Verse", "Line")),
        "divs": ("divisions", change("number", "3", "4")),
        "resources": ("resources", change("url", "http://x.org", "")),
        "ellipses": ("ellipses", change("text", "...", "..")),
        "orphan_readings": ("orphan_readings", change("text", "stray", "strays")),
        "versions": ("versions", change("author", "Ed.", "Eds.")),
        "unit_alignment": ("generated_translations", lambda d: d.where("translation_unit <> 3")),
        "works": ("source_hashes", lambda d: d.withColumn("source_sha256", F.lit("0"))),
    }
    units = {
        "reading_witness": ("reading_payloads", change("witness", "Q", "P")),
        "units": ("units", lambda d: d.withColumn("path", F.reverse("path")).withColumn("is_missing_unit_id", F.lit(1))),
    }
    for damage, more in ((own, set()), (units, {"missing_unit_ids"})):
        bad = edition.record_parity(edition.Edition(built.tables | {t: f(built[t]) for t, (_, f) in damage.items()}, built.warnings), found).where("not ok").collect()
        assert {r.check for r in bad} == {k for k, _ in damage.values()} | more


def test_odd_text_reads_alike_twice():
    odd = samples.MODERN.replace("alpha <w", "a&amp;b\u2003&lt;\u200b <w").replace('morph="N"', 'morph="a&quot;b&lt;"').encode()
    first, (work, second) = xml.parse(odd, "Alpha.xml"), recount.read(odd)
    mine = sorted((r["version"], r["unit"], r["text"], r["xml"]) for r in first["readings"] if not r["is_orphan"])
    assert work == "Alpha" and mine == sorted((int(r[0]), int(r[1]), r[8], r[9]) for kind, r in second if kind == "reading_payloads")


def test_warnings_and_nodes(built):
    assert {r.warning for r in built.warnings.collect()} == {"undeclared witness Z", "repeated section 1:2", "no option 0 in unit 0", "no option 0 in unit 1"}
    nodes = edition.nodes(built)
    assert audit.contiguous(nodes).where("not ok").collect() == []
    assert nodes.agg(F.min("node"), F.max("node"), F.count("*")).first() == (1, nodes.count(), nodes.count())


def test_apparatus(built):
    a = api.Apparatus(built.tables)
    p = a.passage("Alpha__Greek_A", 1, 1)
    assert rows(p["matrix"].select("unit", "witness", "status")) == [(0, "P", "reading"), (0, "Q", "reading"), (0, "Z", "unattested"), (1, "P", "reading"), (1, "Q", "omission"), (1, "Z", "unattested")]
    texts = {r.witness: (r.attested_text, r.text) for r in p["texts"].collect()}
    assert texts == {"P": ("alpha beta gamma. delta", "alpha beta gamma. delta"), "Q": ("alpha beta gamma.", "alpha beta gamma."), "Z": ("", None)}
    assert a.state("Alpha__Greek_A", 1, "Q") == "omission" and a.state("Alpha__Greek_A", 1, "Z") == "unattested"
    assert a.witness_text("Alpha__Greek_A", "Q") == "alpha beta gamma. omega psi again"
    assert a.witness_text("Alpha__Greek_A", "Q", [3, 0]) == "again alpha beta gamma."
    assert [r.word for r in a.reading_tokens("Alpha__Greek_A", 2, 2).orderBy("position").collect()] == ["omega", "psi"]
    assert a.reading_tokens("Alpha__Greek_A", 2, 1).count() == 0
    assert rows(a.work_passage("Alpha", 1, 1).select("version_id", "status")) == [("Alpha__Greek_A", "available"), ("Alpha__Greek_A_2", "metadata_only")]
    assert rows(a.work_passage("Alpha", 9, 1).select("status")) == [("metadata_only",), ("not_present",)]
    assert a.neighbours("Alpha", 1, 2) == {"context_version": "Alpha__Greek_A", "previous": ("1", "1"), "next": ("1", "2~2")}
    assert a.neighbours("Alpha", 7, 7) == {"context_version": None, "previous": None, "next": None}
    for wrong in (lambda: a.passage("Alpha__Greek_A", 1, 9), lambda: a.work_passage("Nobody", 1, 1), lambda: a.state("Alpha__Greek_A", 0, "X")):
        with pytest.raises(KeyError):
            wrong()
    with pytest.raises(ValueError, match="translation"):
        a.passage("Alpha__translation_English_English", 1, 1)
    twice = built.tables | {"reading_witness": built["reading_witness"].union(built["reading_witness"].withColumn("reading", F.lit(2)).where("unit = 1"))}
    with pytest.raises(ValueError, match="several readings"):
        api.Apparatus(twice).attestations()


def test_translations(built):
    t = api.Translations(built.tables)
    tr = "Alpha__translation_English_English"
    assert t.source(tr) == "Alpha__Greek_A" and rows(t.versions("Gamma").select("version_id")) == [("Gamma__English_Translation",)]
    assert [(r.translation_unit_id, r.source_unit_id, r.translation_text, r.source_text) for r in t.aligned_units(tr).collect()] == [("en_1", "1", "one", "alpha beta gamma."), ("en_2", "2", "two", "delta"), ("en_3", "3", "", ""), ("en_4", "4", "four", "again")]
    assert [r.translation_unit for r in t.to_source_units(tr, [3, 0]).collect()] == [3, 0]
    assert t.passage(tr, 1, 1).count() == 2
    with pytest.raises(ValueError):
        t.to_source_units(tr, [99])
    with pytest.raises(ValueError):
        t.source("Beta")


def test_comparison_and_page(built):
    m = api.comparison(built.tables, "Alpha", 1, 1)
    assert [v["version_id"] for v in m["versions"]] == ["Alpha__Greek_A"] and [x["version_id"] for x in m["metadata_only_versions"]] == ["Alpha__Greek_A_2"]
    v = m["versions"][0]
    assert v["primary_text"] == "alpha beta gamma. delta" and [w["witness"] for w in v["witnesses"]] == ["P", "Q", "Z"]
    assert [s["text"] for s in v["translations"][0]["segments"]] == ["one", "two"]
    assert api.comparison(built.tables, "Alpha", 1, 1, versions=[])["versions"] == []
    assert api.comparison(built.tables, "Alpha", 1, 1, witnesses={"Alpha__Greek_A": []})["versions"][0]["witnesses"] == []
    with pytest.raises(ValueError):
        api.comparison(built.tables, "Alpha", 1, 1, versions=["Nope"])
    html = page.render(m, {"next": ("1", "2"), "previous": None})
    assert html == page.render(m, {"next": ("1", "2"), "previous": None}) and "[not attested]" in html
    ask = lambda q: page.route(q, lambda: [("A&B", "x <y>")], lambda *a, **k: api.comparison(built.tables, *a, **k), lambda *a: api.Apparatus(built.tables).neighbours(*a))
    assert ask("")[0] == 200 and "x &lt;y&gt;" in ask("")[1]
    assert ask("work=Alpha&chapter=1&verse=1")[0] == 200 and ask("work=Nope&chapter=1&verse=1")[0] == 400
    assert rows(api.works(built.tables).where("work_id = 'Alpha'")) == [("Alpha", "Book of Alpha (Alpha)")]


def test_side_sources(spark, tmp_path):
    good = {"_meta": {"note": "x"}, "documents": {"Alpha.xml": {"title": "T", "version": 1.0, "author": None, "fields": {"status": "s"}}}}
    path = tmp_path / "intros.json"
    path.write_text(json.dumps(good))
    works = spark.createDataFrame([("/x/Alpha.xml",)], "file string")
    assert rows(side.metadata(spark, str(path), works).select("field", "value")) == [("author", "null"), ("fields.status", '"s"'), ("title", '"T"'), ("version", "1.0")]
    with pytest.raises(ValueError):
        side.metadata(spark, str(path), works.where("false"))
    path.write_text(json.dumps({"documents": {"Alpha.xml": {"title": "T", "version": [], "fields": {}}}}))
    with pytest.raises(ValueError, match="scalar"):
        side.metadata(spark, str(path))
    c = {"source": dict.fromkeys(side.SOURCE_KEYS, "x"), "genres": [{"id": 1, "label": "g"}], "biblical_figures": [], "documents": [{"historical_doc_id": 1, "work_id": "Alpha", "genre_ids": [1], "biblical_figure_ids": []}]}
    path.write_text(json.dumps(c))
    assert side.classifications(spark, str(path))["documents"].count() == 1
    for change in ({"genres": []}, {"genres": [{"id": 0, "label": "g"}]}, {"documents": c["documents"] * 2}, {"extra": 1}, {"source": dict.fromkeys("abcdef", "x")}, {"source": c["source"] | {"status": " "}}):
        path.write_text(json.dumps(c | change))
        with pytest.raises(ValueError):
            side.classifications(spark, str(path))


def test_side_data_is_attached_and_checked(spark, tmp_path):
    intros, kinds = tmp_path / "intros.json", tmp_path / "c.json"
    intros.write_text(json.dumps({"documents": {"Alpha.xml": {"title": "T", "version": 1.0, "author": None, "fields": {"status": "é"}}, "Void.xml": {"title": "V", "version": 2, "fields": {}}}}))
    kinds.write_text(json.dumps({"source": dict.fromkeys(side.SOURCE_KEYS, "x"), "genres": [{"id": 1, "label": "g"}, {"id": 2, "label": "h"}, {"id": 3, "label": "unused"}], "biblical_figures": [], "documents": [{"historical_doc_id": 7, "work_id": "Alpha", "genre_ids": [2, 1], "biblical_figure_ids": []}]}))
    files, slots = spark.createDataFrame([("/x/Alpha.xml",), ("/x/Void.xml",)], "path string"), spark.createDataFrame([("Alpha", 4), ("Beta", 1)], "work_id string, slot int")
    claims = provenance.describe(provenance.REPOSITORY, provenance.COMMIT, provenance.LOOKED_UP, detected=provenance.COMMIT, clean=True)
    tables, checks = cli.side_tables(spark, files, slots, str(intros), str(kinds), claims)
    assert checks.where("ok").count() == checks.count() == 8
    assert rows(tables["document_metadata"].select("work_id", "slot")) == [("Alpha", 4), ("Void", 1)]
    assert rows(tables["classifications"].select("work_id", "historical_doc_id", "genres", "biblical_figures")) == [("Alpha", 7, ["h", "g"], [])]
    bad = tables | {"metadata_values": tables["metadata_values"].where("field <> 'author'"), "document_metadata": tables["document_metadata"].limit(1), "classification_vocabulary": tables["classification_vocabulary"].where("id <> 3"), "classifications": tables["classifications"].withColumn("genres", F.reverse("genres"))}
    found = recount.metadata_checks(bad, recount.raw(spark, str(intros))).unionByName(recount.classification_checks(bad, recount.raw(spark, str(kinds))))
    assert {r.check for r in found.where("not ok").collect()} == {"public_metadata_documents", "public_metadata_values", "historical_classification_values", "historical_classification_vocabulary"}
    assert cli.side_tables(spark, files, slots, None, None, {**claims, "licence": "other"})[1].where("not ok").count() == 1
    with pytest.raises(ValueError):
        cli.side_tables(spark, files.limit(1), slots, str(intros), None, claims)
    with pytest.raises(ValueError, match="intros"):
        cli.side_tables(spark, files, slots, None, str(kinds), claims)


def test_install_is_all_or_nothing(spark, tmp_path):
    target = str(tmp_path / "d")
    dataset.write({"a": spark.range(3)}, target)

    def fail():
        raise KeyboardInterrupt

    with pytest.raises(KeyboardInterrupt):
        dataset.write({"a": spark.range(9)}, target, after_install=fail)
    assert spark.read.parquet(f"{target}/a").count() == 3 and sorted(p.name for p in tmp_path.iterdir()) == ["d"]
    with pytest.raises(ValueError, match="not loaded"):
        load(spark, target, {"a": ["id", "missing"]})
    with pytest.raises(ValueError):
        dataset.overlay(spark.range(1), target, f"{target}/x", accept_noncommercial=True)
    with pytest.raises(ValueError):
        dataset.overlay(spark.range(1), target, str(tmp_path / "o"), accept_noncommercial=False)
    with pytest.raises(ValueError):
        dataset.report_path(f"{target}/r.json", target)
    (tmp_path / "odd.txt").write_text("x")
    with pytest.raises(ValueError, match="not reviewed"):
        check_folder(str(tmp_path))


def test_provenance_claims_what_it_knows():
    known = {("r", "a" * 40): provenance.Terms("free", "u", "s", "all", "by", "c")}
    full = provenance.describe("r", "a" * 40, known, detected="a" * 40, clean=True)
    assert full["licence"] == "free" and provenance.consistent(full, known)
    other = provenance.describe("r", "b" * 40, known, detected="b" * 40, clean=True)
    assert other["identity_status"] == "verified" and other["licence_status"] == "unverified" and provenance.consistent(other, known)
    for dirty in (provenance.describe("r", "a" * 40, known, detected="a" * 40), provenance.describe("r", "a" * 40, known, clean=True)):
        assert dirty["identity_status"] == "unverified" and "licence" not in dirty and provenance.consistent(dirty, known)
    assert not provenance.consistent({**other, "licence_status": "verified"}, known) and not provenance.consistent({}, known)


def test_release(tmp_path):
    (tmp_path / "a").write_text("1")
    (tmp_path / "b").write_text("2")
    files = {"b.tbl": str(tmp_path / "b"), "a.tbl": str(tmp_path / "a")}
    report = {"checks": {"x": True}, "status": "passed", "failed_checks": []}
    ids = {"tag": "v1", "commit": "a" * 40, "upstream_commit": "b" * 40, "licence": "free"}
    one, two = release.stage(files, str(tmp_path / "r1"), report, **ids), release.stage(dict(reversed(files.items())), str(tmp_path / "r2"), report, **ids)
    assert open(one["archive"], "rb").read() == open(two["archive"], "rb").read()
    value = json.load(open(one["manifest"]))
    with zipfile.ZipFile(one["archive"], "a") as z:
        z.writestr("c.tbl", "3")
    with pytest.raises(ValueError):
        release.validate(value, one["archive"], report)
    for bad in ({**report, "checks": {}}, {**report, "checks": {"x": 1}}, {**report, "status": "failed"}):
        with pytest.raises(ValueError):
            release.gate(bad)
