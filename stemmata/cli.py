"""spark-submit entry: convert a folder of sources to a dataset, compare a passage, add an overlay."""

from __future__ import annotations

import argparse
import os
import sys

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .operators import audit, catalog
from .operators.guards import none_of
from .plans import api, edition
from .session import session
from .sinks import dataset, page, provenance, release
from .sources import recount, side, tei, xml
from .sources.dataset import check_folder, git_clean, git_commit, load_all
from .storage import kept

TABLES = ("works", "versions", "units", "readings", "words", "variant_words", "sections", "unit_sections", "manuscripts", "reading_witness", "unit_alignment")


def side_tables(spark, files: DataFrame, slots: DataFrame, intros: str | None, classifications: str | None, claims: dict[str, str]) -> tuple[dict[str, DataFrame], DataFrame]:
    """Tables of the side data and of where the sources come from, and their checks. ``files``: (path); ``slots``: (work_id, slot)."""
    tables = {"provenance": spark.createDataFrame(sorted(claims.items()), "key string, value string")}
    terms = provenance.consistent({r.key: r.value for r in tables["provenance"].collect()}, provenance.LOOKED_UP)
    checks = [spark.createDataFrame([("corpus_license_provenance", int(not terms), terms)], "check string, n_broken long, ok boolean")]
    if classifications and not intros:
        raise ValueError("classifications need the documents of intros.json")
    if intros:
        values = side.metadata(spark, intros, files.select(F.col("path").alias("file")))
        documents = values.select("document", "source_sha256").distinct().withColumn("work_id", catalog.without_xml_suffix(F.col("document")))
        tables["metadata_values"] = values
        tables["document_metadata"] = catalog.attach_metadata(documents, slots, "work_id")
        checks.append(recount.metadata_checks(tables, recount.raw(spark, intros)))
    if classifications:
        read = side.classifications(spark, classifications)
        known = catalog.known_works(read["documents"], tables["document_metadata"], "work_id")
        tables["classifications"] = known
        for kind, ids in (("genres", "genre_ids"), ("biblical_figures", "figure_ids")):
            labels = catalog.labels_of(known.select("work_id", F.col(ids).alias("ids")), read[kind], "work_id").groupBy("work_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("position", "label"))), lambda x: x["label"]).alias(kind))
            tables["classifications"] = tables["classifications"].join(labels, "work_id", "left").withColumn(kind, F.coalesce(kind, F.array().cast("array<string>")))
        tables["classification_vocabulary"] = read["genres"].withColumn("kind", F.lit("genres")).unionByName(read["biblical_figures"].withColumn("kind", F.lit("biblical_figures")))
        tables["classification_source"] = read["source"]
        checks.append(recount.classification_checks(tables, recount.raw(spark, classifications)))
    return tables, audit.all_checks(*checks)


def convert(spark, source: str, output: str, report: str | None, classifications: str | None = None, commit: str | None = None, dictionary: str | None = None) -> int:
    check_folder(source, reviewed_files=(".TJob.xml.un~", "grammateus.dtd", "tags"))
    files = xml.files(spark, source)
    parsed = xml.read_editions(spark, source)
    none_of(xml.unparsed(files, parsed["works"]), "files with content that no work was read from")
    built = edition.build(parsed)
    parity = edition.source_parity(built, recount.inventory(files))
    detected, clean = git_commit(source), git_clean(source)
    claims = provenance.describe(provenance.REPOSITORY, commit or detected or "", provenance.LOOKED_UP, detected=detected, clean=clean)
    known = claims["commit"] if claims["identity_status"] == provenance.VERIFIED else ""
    built.tables["versions"] = edition.with_generation(built["versions"], known)
    built.tables["anchors"] = kept(edition.anchors(built), "anchors")
    intros = os.path.join(source, "intros.json")
    slots = built["words"].select("version_id", "slot").join(built["versions"].select("version_id", "work_id"), "version_id")
    more, side_checks = side_tables(spark, files, slots, intros if os.path.isfile(intros) else None, classifications, claims)
    checks = edition.checks(built).unionByName(parity.where("not ok").agg(F.count("*").alias("n_broken")).select(F.lit("source_parity").alias("check"), "n_broken", (F.col("n_broken") == 0).alias("ok"))).unionByName(edition.record_parity(built, recount.records(files))).unionByName(edition.ownership_checks(built, known)).unionByName(side_checks).persist()
    where = dataset.report_path(report or f"{output}.report.json", output)
    result = dataset.report(checks, parity.groupBy("item").agg(F.sum("n_edition")), where, upstream_commit=detected, upstream_clean=clean, provenance=claims, capabilities=edition.capabilities(built))
    if result["failed_checks"]:
        print("failed: " + ", ".join(result["failed_checks"]), file=sys.stderr)
        return 1
    tables = built.tables | more
    if dictionary:
        dataset.check_dictionary(dictionary, {n: df.schema for n, df in tables.items()})
    dataset.write(tables, output, checks=checks)
    return 0


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="stemmata")
    commands = parser.add_subparsers(dest="command", required=True)
    c = commands.add_parser("convert")
    c.add_argument("source")
    c.add_argument("--output", required=True)
    c.add_argument("--report")
    c.add_argument("--classifications", help="a JSON file of genres and figures of works; needs intros.json in the source folder")
    c.add_argument("--upstream-commit")
    c.add_argument("--dictionary", help="a data dictionary that must be that of the dataset")
    b = commands.add_parser("compare")
    b.add_argument("dataset")
    for name in ("work", "chapter", "verse"):
        b.add_argument(name)
    m = commands.add_parser("morphology")
    for name in ("dataset", "work", "tei", "source"):
        m.add_argument(name)
    m.add_argument("--output", required=True)
    m.add_argument("--licence-url", default=tei.LICENCE_URL, help="address that the TEI file's licence must have")
    m.add_argument("--language", default=tei.LANGUAGE, help="language that the TEI file's text must have")
    m.add_argument("--accept-noncommercial", action="store_true")
    d = commands.add_parser("differences", help="members by which one archive differs from another; 1 if there are any")
    d.add_argument("expected")
    d.add_argument("found")
    d.add_argument("--folder", default="", help="where in the second archive the first one's members stand")
    a = parser.parse_args(argv)
    spark = session()
    if a.command == "differences":
        found = release.compared(spark, a.expected, a.found, folder=a.folder).orderBy("member").toLocalIterator()
        lines = [f"{r.kind}\t{r.member}" for r in found]
        print("\n".join(lines))
        return int(bool(lines))
    if a.command == "convert":
        return convert(spark, a.source, a.output, a.report, a.classifications, a.upstream_commit, a.dictionary)
    tables = load_all(spark, a.dataset, TABLES)
    if a.command == "compare":
        around = api.Apparatus(tables).neighbours(a.work, a.chapter, a.verse)
        print(page.render(api.comparison(tables, a.work, a.chapter, a.verse), around))
        return 0
    with open(a.tei, "rb") as f, open(a.source, "rb") as g:
        words, source = tei.morphology(spark, f.read(), a.work, a.licence_url, a.language), tei.source_words(spark, g.read(), a.work)
    own = tables["versions"].where((F.col("work_id") == a.work) & (F.col("version_kind") == "source")).select("version_id")
    slots = tables["words"].join(own, "version_id").join(tables["unit_sections"], ["version_id", "unit"]).select(F.concat("chapter", F.lit("."), "verse").alias("ref"), "slot", "word")
    dataset.overlay(tei.align(source, words, slots), a.dataset, a.output, accept_noncommercial=a.accept_noncommercial)
    return 0


if __name__ == "__main__":
    sys.exit(main())
