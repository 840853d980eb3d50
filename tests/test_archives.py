"""Archives as tables, and the checks of anchors, owners and makers."""

import hashlib
import io
import zipfile

import pytest
import samples
from conftest import rows
from pyspark.sql import functions as F
from stemmata import cli
from stemmata.operators import anchoring, parallels
from stemmata.plans import edition
from stemmata.sinks import dataset, release
from stemmata.sources import archives, grammar, xml
from stemmata.sources.grammar import SourceError

from xml.etree import ElementTree as ET


def sha(data):
    return hashlib.sha256(data).hexdigest()


def put(path, members):
    with zipfile.ZipFile(path, "w") as out:
        for name, data in members:
            out.writestr(name, data)
    return str(path)


def test_write_read_and_compare(spark, tmp_path):
    content = [(f"a{i % 3}", f"m{i:03}", bytes([i]) * i * 1000) for i in range(40)] + [("a0", "empty", b""), ("a1", "null", None)]
    df = spark.createDataFrame(content, "archive string, member string, content binary")
    for name in ("one", "two"):
        archives.write(df.repartition(3 if name == "one" else 5), f"file://{tmp_path}/{name}")
    found = archives.read(spark, f"file://{tmp_path}/one")
    assert rows(found.select("archive", "member", "n_bytes", "sha256", "problem")) == sorted(((f"{a}.zip", m, len(c or b""), sha(c or b""), None) for a, m, c in content), key=repr)
    assert [(tmp_path / "one" / f"a{i}.zip").read_bytes() for i in range(3)] == [(tmp_path / "two" / f"a{i}.zip").read_bytes() for i in range(3)]
    assert archives.differences(found, archives.read(spark, f"{tmp_path}/two")).collect() == []
    assert archives.read(spark, f"{tmp_path}/one/a0.zip").count() == 15
    (tmp_path / "none").mkdir()
    assert archives.read(spark, str(tmp_path / "none")).collect() == []


def test_differences_have_kinds(spark, tmp_path):
    a = put(tmp_path / "a.zip", [("same", b"x"), ("gone", b"y"), ("other", b"z")])
    b = put(tmp_path / "b.zip", [("same", b"x"), ("new", b"y"), ("other", b"zz")])
    found = rows(release.compared(spark, a, b).select("member", "kind"))
    assert found == [("gone", "missing"), ("new", "surplus"), ("other", "changed")]
    with pytest.raises(ValueError, match="gone"):
        release.same_members(spark, a, b)
    release.same_members(spark, a, put(tmp_path / "c.zip", [("data/other", b"z"), ("data/same", b"x"), ("data/gone", b"y"), ("app/config.yaml", b"q")]), folder="data")
    assert cli.main(["differences", a, a]) == 0 and cli.main(["differences", a, b]) == 1


@pytest.mark.filterwarnings("ignore:Duplicate name")
def test_bad_members_are_broken(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "bad.zip", "w") as out:
        for name in ("twice", "twice", "../out", "/root", "a//b", "ok"):
            out.writestr(name, b"1")
        link = zipfile.ZipInfo("link")
        link.external_attr = 0o120777 << 16
        out.writestr(link, b"target")
        out.mkdir("folder")
    data = bytearray(open(put(tmp_path / "torn.zip", [("x", b"a" * 500)]), "rb").read())
    data[60] ^= 1
    (tmp_path / "torn.zip").write_bytes(bytes(data))
    (tmp_path / "text.zip").write_bytes(b"no archive")
    found = {(r.archive, r.member): r.problem or "" for r in archives.read(spark, str(tmp_path)).collect()}
    assert found["bad.zip", "ok"] == "" and found["bad.zip", "link"] == "a link or device" and found["bad.zip", "folder/"] == "a folder"
    assert all(found["bad.zip", n] == "a name that leaves the archive" for n in ("../out", "/root", "a//b")) and found["bad.zip", "twice"] == "repeated"
    assert found["torn.zip", "x"].startswith("unreadable") and found["text.zip", ""].startswith("no archive")
    bad = archives.read(spark, str(tmp_path / "bad.zip"))
    assert {r.member for r in archives.differences(bad, bad).where("kind = 'broken'").collect()} == {"twice", "../out", "/root", "a//b", "link", "folder/"}


def test_members_stream():
    """No member is held whole: a source that counts what is asked for at once."""
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as out:
        out.writestr("big", b"0" * (5 << 20))
    assert [r[:2] for r in archives.members(buffer)] == [("big", 5 << 20)]


def test_manifest_members_are_compared(spark, tmp_path):
    file = tmp_path / "units.parquet"
    file.write_bytes(b"data")
    report = {"checks": {"a": True}, "status": "passed", "failed_checks": []}
    staged = release.stage({"units.parquet": str(file)}, str(tmp_path / "out"), report, tag="v1", commit="0" * 40, upstream_commit="1" * 40, licence="CC")
    value = release.manifest(staged["archive"], report, tag="v1", commit="0" * 40, upstream_commit="1" * 40, licence="CC")
    assert archives.differences(release.listed(spark, value), archives.read(spark, staged["archive"]), by=[]).collect() == []


# --- anchors, owners, makers ----------------------------------------------------------------


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    folder = samples.write(tmp_path_factory.mktemp("sources"), Alpha=samples.MODERN, Gamma=samples.COMPACT)
    e = edition.build(xml.read_editions(spark, folder, strict=False))
    target = str(tmp_path_factory.mktemp("out") / "data")
    dataset.write(e.tables, target)
    t = {n: spark.read.parquet(f"{target}/{n}").persist() for n in e.tables}
    t["anchors"] = anchoring.technical(t).persist()
    t["versions"] = edition.with_generation(t["versions"], "").persist()
    return edition.Edition(t, e.warnings)


def test_where_nodes_without_words_stand(built):
    found = rows(built["anchors"].where("version_id like 'Alpha__Greek%'").select("version_id", "otype", "key", "slot"))
    first = built["words"].where("version_id = 'Alpha__Greek_A'").agg(F.min("slot")).first()[0]
    assert found == [
        *[("Alpha__Greek_A", *x, first) for x in (("ellipsis", "0/5"), ("manuscript", "P"), ("manuscript", "Q"), ("manuscript", "Z"), ("orphan_reading", "0/6"), ("resource", "1"))],
    ]


def test_each_check_of_ownership_notices_damage(built):
    names = ["ellipsis_anchors", "generated_translation_provenance", "manuscript_ownership", "missing_unit_id_once", "orphan_reading_anchors", "orphan_witness_ownership", "parallel_translation_alignment", "resource_ownership"]
    assert rows(edition.ownership_checks(built)) == [(n, 0, True) for n in names]
    at = lambda kind: F.col("otype") == kind
    swap = lambda d: d.withColumn("unit", F.when(F.col("version_id") == "Gamma__English_Translation", 1 - F.col("unit")).otherwise(F.col("unit")))
    broken = [
        ("ellipsis_anchors", "anchors", lambda d: d.withColumn("slot", F.when(at("ellipsis"), 99).otherwise(F.col("slot")))),
        ("ellipsis_anchors", "anchors", lambda d: d.union(d.where(at("ellipsis")))),
        ("orphan_reading_anchors", "anchors", lambda d: d.withColumn("div", F.when(~at("orphan_reading"), F.col("div")))),
        ("orphan_witness_ownership", "manuscripts", lambda d: d.where("witness <> 'P'")),
        ("manuscript_ownership", "manuscripts", lambda d: d.withColumn("work_id", F.lit("other"))),
        ("manuscript_ownership", "versions", lambda d: d.union(d)),
        ("resource_ownership", "resources", lambda d: d.withColumn("version_id", F.lit("nowhere"))),
        ("generated_translation_provenance", "versions", lambda d: d.withColumn("generation_model", F.lit("guess"))),
        ("generated_translation_provenance", "versions", lambda d: d.withColumn("generation_marker", F.lit(None).cast("string"))),
        ("parallel_translation_alignment", "units", swap),
        ("parallel_translation_alignment", "unit_alignment", lambda d: d.where("translation_unit <> 0")),
        ("parallel_translation_alignment", "unit_alignment", lambda d: d.withColumn("source_unit", F.lit(1))),
        ("parallel_translation_alignment", "manuscripts", lambda d: d.where("witness <> 'Eng'")),
        ("missing_unit_id_once", "units", lambda d: d.withColumn("unit_id", F.lit("")).withColumn("source_ref", F.lit("1"))),
        ("parallel_translation_alignment", "versions", lambda d: d.withColumn("source_format", F.lit("modern"))),
    ]
    for name, table, damage in broken:
        bad = edition.Edition(built.tables | {table: damage(built[table])}, built.warnings)
        assert not edition.ownership_violations(bad)[name]().isEmpty(), (name, table)


def test_makers_of_a_known_commit(built):
    commit = next(iter(edition.GENERATION))
    known = edition.with_generation(built["versions"], commit)
    made = known.where("version_kind = 'generated_translation'").select("generation_method", "generation_model")
    assert rows(made) == [edition.GENERATION[commit]] and edition.unproven(known, commit).collect() == []
    assert edition.unproven(known, "").count() == 1 and edition.unproven(built["versions"], commit).count() == 1


def test_kinds_of_misalignment(built):
    turned = built["units"].withColumn("unit", F.when(F.col("version_id") == "Gamma__English_Translation", 1 - F.col("unit")).otherwise(F.col("unit")))
    kinds = {r.kind for r in edition.misaligned(built.tables | {"units": turned}).collect()}
    assert parallels.SWAPPED in kinds and "link elsewhere" in kinds


@pytest.mark.parametrize("old, new, what", [
    ('id="1.2"', 'id="2.2"', "unit is not of its division"), ('id="1.2"', 'id="1.1"', "unit id is repeated"), ('id="1.2"', 'id="1. "', "unit is not of its division"),
    ('lang="grc"', 'lang="ara"', "original and its English"), ('title="English Translation"', 'title="Text"', "original and its English"), ('type="section"', 'type="page"', "known kind"),
    ('mss="K"', 'mss="L"', "declared witness"), ('mss="Eng"', 'mss="K"', "declared witness"), ('<manuscript id="K" name="Kodex"/>', "", "own witness"),
    ('<manuscript id="K" name="Kodex"/>', '<manuscript id="K" name="a"/><manuscript id="K" name="b"/>', "declared twice"), ('id="K"', 'id="Eng"', "own witness"),
    ('option="base" mss="K">nomos', 'option="0" mss="K">nomos', "base reading"), ('<unit id="1.2"><reading option="base" mss="Eng">law</reading></unit>', "", "not the original's"),
    ('<unit id="1.1"><reading option="base" mss="K">logos</reading></unit><unit id="1.2"><reading option="base" mss="K">nomos</reading></unit>', "", "without units"),
    ('filename="Gamma.xml"', 'filename="Delta.xml"', "file name"),
])
def test_compact_books_are_pairs(old, new, what):
    assert old in samples.COMPACT
    with pytest.raises(SourceError, match=what):
        grammar.check(ET.fromstring(samples.COMPACT.replace(old, new, 1)), "Gamma.xml", "")
