"""Questions to a built edition. Answers are DataFrames; what the edition can't answer raises before anything runs."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import unique
from ..operators import alignment, apparatus, catalog
from ..operators.guards import exists, none_of, require_columns

V = ["version_id"]
VERSIONS, WITNESSES = 2, 4  #: how many are shown when nothing is selected


class Apparatus:
    """Readings and witnesses of source versions. ``tables`` as ``edition.build`` makes them, or as loaded."""

    def __init__(self, tables: dict[str, DataFrame]):
        self.t = tables
        require_columns(tables["versions"], "version_id", "work_id", "version_kind")
        self.sources = apparatus.historical(tables["versions"])

    def _source(self, version: str) -> None:
        row = self.t["versions"].where(F.col("version_id") == version).select("version_kind").first()
        if row is None:
            raise KeyError(version)
        if row[0] in apparatus.TRANSLATIONS:
            raise ValueError(f"{version} is a translation: it has no apparatus")

    def witnesses(self, version: str) -> DataFrame:
        self._source(version)
        own = apparatus.without_synthetic(self.t["manuscripts"].where(F.col("version_id") == version))
        none_of(own.groupBy("witness").count().where("count > 1"), "a manuscript is declared twice")
        return own.orderBy("witness")

    def attestations(self, version: str | None = None, unit: int | None = None, witness: str | None = None) -> DataFrame:
        """(version_id, unit, reading, witness, text) of witnesses that are manuscripts; what is not asked for is neither read nor checked."""
        cited = self.t["reading_witness"]
        for column, value in (("unit", unit), ("witness", witness)):
            cited = cited if value is None else cited.where(F.col(column) == value)
        real = apparatus.without_synthetic(self.t["manuscripts"]).select(*V, "witness")
        if version is not None:
            cited, real = cited.where(F.col("version_id") == version), real.where(F.col("version_id") == version)
        out = cited.join(real, [*V, "witness"], "left_semi").join(self.t["readings"].select(*V, "unit", "reading", "text"), [*V, "unit", "reading"])
        return apparatus.single_readings(out, [*V, "unit", "witness"])

    def units_of(self, version: str, chapter: object, verse: object) -> DataFrame:
        self._source(version)
        here = (F.col("version_id") == version) & (F.col("chapter") == str(chapter)) & (F.col("verse") == str(verse))
        found = exists(self.t["unit_sections"].where(here), f"{version} has no {chapter}:{verse}")
        return found.join(self.t["units"], [*V, "unit"]).select(*V, "unit", "unit_id", "source_ref")

    def passage(self, version: str, chapter: object, verse: object) -> dict[str, DataFrame]:
        """units, readings (with their witnesses), matrix, coverage and texts of one passage."""
        units = self.units_of(version, chapter, verse)
        said = self.attestations(version).join(units.select(*V, "unit"), [*V, "unit"], "left_semi")
        readings = self.t["readings"].join(units.select(*V, "unit"), [*V, "unit"], "left_semi")
        listed = said.groupBy(*V, "unit", "reading").agg(F.array_sort(F.collect_list("witness")).alias("witnesses"))
        matrix = apparatus.witness_matrix(units, self.witnesses(version).select(*V, "witness"), said, V)
        by = [*V, "witness"]
        return {
            "units": units,
            "readings": readings.join(listed, [*V, "unit", "reading"], "left").select(*V, "unit", "reading", "text", "is_primary", (F.col("text") == "").alias("is_omission"), F.coalesce("witnesses", F.array().cast("array<string>")).alias("witnesses")),
            "matrix": matrix,
            "coverage": apparatus.coverage(matrix, by),
            "texts": apparatus.attested_text(matrix, by, ["unit"]),
        }

    def unit(self, version: str, unit: int) -> DataFrame:
        """The readings of one unit with their witnesses."""
        self._source(version)
        return apparatus.listing(self.attestations(version, unit), [*V, "unit", "reading"])

    def state(self, version: str, unit: int, witness: str) -> str:
        exists(self.witnesses(version).where(F.col("witness") == witness), f"{witness} is no witness of {version}")
        row = self.attestations(version, unit, witness).first()
        return apparatus.UNATTESTED if row is None else apparatus.OMISSION if not row.text else apparatus.READING

    def witness_text(self, version: str, witness: str, units: Iterable[int] | None = None) -> str:
        """A witness' text through the version, or through ``units`` in their order."""
        exists(self.witnesses(version).where(F.col("witness") == witness), f"{witness} is no witness of {version}")
        said = self.attestations(version, witness=witness)
        order = None if units is None else said.sparkSession.createDataFrame(list(enumerate(units)), "position int, unit int")
        row = apparatus.witness_text(said, ["unit"], units=order).first()
        return row.text if row else ""

    def reading_tokens(self, version: str, unit: int, reading: int) -> DataFrame:
        """The words of one reading: slots of a primary one, variant words of another; none of an omission."""
        here = (F.col("version_id") == version) & (F.col("unit") == unit)
        own = exists(self.t["readings"].where(here & (F.col("reading") == reading)), f"{version} has no reading {reading} in unit {unit}").first()
        if own.is_primary:
            return self.t["words"].where(here & F.col("is_gap").isNull()).select("position", "word", "prefix", "trailer")
        return self.t["variant_words"].where(here & (F.col("reading") == reading)).select(F.col("variant_position").alias("position"), "word", "prefix", "trailer")

    def work_passage(self, work: str, chapter: object, verse: object) -> DataFrame:
        """(version_id, title, language, author, status) of every version of a work, by version."""
        versions = exists(self.sources.where(F.col("work_id") == work), f"unknown work {work}")
        bare = versions.where("is_metadata_only").select("version_id")
        found = apparatus.work_passages([(str(chapter), str(verse))], versions.select("version_id", "title", "language", "author"), self.t["unit_sections"], version="version_id", address=["chapter", "verse"], bare=bare)
        return found.select("version_id", "title", "language", "author", "status").orderBy("version_id")

    def neighbours(self, work: str, chapter: object, verse: object, preferred: Iterable[object] = ()) -> dict[str, object]:
        """The addresses before and after, in the first preferred version that has the address; all null if none has."""
        versions = exists(self.sources.where(F.col("work_id") == work), f"unknown work {work}")
        ranks = {v: i for i, v in enumerate(unique(preferred))}
        order = versions.select("version_id").orderBy("version_id").collect()
        listed = versions.sparkSession.createDataFrame([(r[0], ranks.get(r[0], len(ranks) + i)) for i, r in enumerate(order)], "version_id string, preference int")
        addresses = self.t["sections"].join(listed, "version_id").withColumn("address", F.struct("chapter", F.col("label").alias("verse")))
        around = apparatus.neighbours(addresses, V, ["verse_index"], "address").where((F.col("chapter") == str(chapter)) & (F.col("label") == str(verse)))
        none_of(around.groupBy("version_id").count().where("count > 1"), "an address occurs twice")
        row = around.orderBy("preference").first()
        pair = lambda x: None if x is None else (x.chapter, x.verse)
        return {"context_version": row.version_id if row else None, "previous": pair(row.previous) if row else None, "next": pair(row.next) if row else None}


class Translations:
    """Translations and what they translate, unit by unit."""

    def __init__(self, tables: dict[str, DataFrame]):
        self.t = tables

    def versions(self, work: str | None = None, language: str | None = None) -> DataFrame:
        v = self.t["versions"]
        found = v.where(F.col("version_kind").isin(*apparatus.TRANSLATIONS))
        if work is not None:
            found = found.where(F.col("work_id") == work)
        if language is not None:
            found = found.where(F.col("language") == language)
        none_of(found.join(v.select(F.col("version_id").alias("source_version_id")), "source_version_id", "left_anti"), "a translation without a source version")
        return found.select("version_id", "work_id", "title", "language", "source_version_id", "generation_marker").orderBy("work_id", "version_id")

    def source(self, version: str) -> str:
        rows = self.versions().where(F.col("version_id") == version).collect()
        if len(rows) != 1:
            raise ValueError(f"{version} is no translation of one source version")
        return rows[0].source_version_id

    def aligned_units(self, version: str) -> DataFrame:
        """Translation unit, source unit, their ids, the source's reference and both texts, in the translation's order."""
        two = F.col("version_id").isin(version, self.source(version))
        linked = self.t["unit_alignment"].where(F.col("version_id") == version)
        none_of(linked.groupBy("translation_unit").count().where("count > 1"), "a unit with several source units")
        text = apparatus.exactly_one_primary(self.t["readings"].where(two), [*V, "unit"]).where("is_primary").select(*V, "unit", "text")
        sides = self.t["units"].where(two).select(*V, "unit", "unit_id", "source_ref").join(text, [*V, "unit"])
        tr = sides.select(F.col("version_id"), F.col("unit").alias("translation_unit"), F.col("unit_id").alias("translation_unit_id"), F.col("text").alias("translation_text"))
        src = sides.select(F.col("version_id").alias("source_version_id"), F.col("unit").alias("source_unit"), F.col("unit_id").alias("source_unit_id"), "source_ref", F.col("text").alias("source_text"))
        return linked.join(tr, [*V, "translation_unit"]).join(src, ["source_version_id", "source_unit"]).select("translation_unit", "source_unit", "translation_unit_id", "source_unit_id", "source_ref", "translation_text", "source_text").orderBy("translation_unit")

    def to_source_units(self, version: str, units: Iterable[int]) -> DataFrame:
        """The translation's unit of each source unit in the order given, null where it has none."""
        source, linked = self.source(version), self.t["unit_alignment"].where(F.col("version_id") == version)
        wanted = linked.sparkSession.createDataFrame(list(enumerate(units)), "position int, source_unit int")
        own = self.t["units"].where(F.col("version_id") == source).select(F.col("unit").alias("source_unit"))
        none_of(wanted.join(own, "source_unit", "left_anti"), f"units that are not of {source}")
        return alignment.to_source_units(linked, wanted, "unit").select("position", "source_unit", "translation_unit").orderBy("position")

    def passage(self, version: str, chapter: object, verse: object) -> DataFrame:
        here = self.t["unit_sections"].where((F.col("version_id") == version) & (F.col("chapter") == str(chapter)) & (F.col("verse") == str(verse)))
        units = exists(here, f"{version} has no {chapter}:{verse}").select(F.col("unit").alias("translation_unit"))
        return self.aligned_units(version).join(units, "translation_unit", "left_semi")


def comparison(tables: dict[str, DataFrame], work: str, chapter: object, verse: object, *, versions: Iterable[str] | None = None, witnesses: dict[str, Iterable[str]] | None = None) -> dict:
    """One passage across the versions of its work, ready to be shown: a small answer, on the driver.

    No selection means the first versions (those with the passage first) and witnesses (showable ones first);
    an empty selection stays empty; an unknown one raises.
    """
    app, tr = Apparatus(tables), Translations(tables)
    status = app.work_passage(work, chapter, verse).collect()
    textual = [r for r in status if r.status != "metadata_only"]
    ids = [r.version_id for r in textual]
    ranked = sorted(textual, key=lambda r: (r.status != "available", r.version_id))
    chosen = [r.version_id for r in ranked][:VERSIONS] if versions is None else list(unique(versions))
    if unknown := [v for v in [*chosen, *(witnesses or {})] if v not in ids]:
        raise ValueError(f"unknown versions: {', '.join(unknown)}")
    made = [r for r in tr.versions(work).collect()]
    out = {"work": work, "reference": (str(chapter), str(verse)), "versions": [], "version_choices": [{**r.asDict(), "selected": r.version_id in chosen} for r in textual], "metadata_only_versions": [r.asDict() for r in status if r.status == "metadata_only"]}
    for v in chosen:
        own = next(r for r in textual if r.version_id == v)
        view = {**own.asDict(), "primary_segments": [], "primary_text": None, "witness_choices": [], "witnesses": [], "translations": []}
        if own.status == "available":
            p = app.passage(v, chapter, verse)
            primary = apparatus.exactly_one_primary(p["readings"], [*V, "unit"]).where("is_primary").join(p["units"], [*V, "unit"]).orderBy("unit").collect()
            view["primary_segments"] = [{"unit": r.unit_id, "status": "reading" if r.text else "omission", "text": r.text} for r in primary]
            view["primary_text"] = " ".join(r.text for r in primary if r.text)
            listed = app.witnesses(v).withColumn("showable", apparatus.showable(F.coalesce("is_undeclared", F.lit(0)) != 1, F.col("show"))).collect()
            sigla = [r.witness for r in listed]
            if witnesses is not None and v in witnesses:
                picked = list(unique(witnesses[v]))
                if unknown := [w for w in picked if w not in sigla]:
                    raise ValueError(f"unknown witnesses of {v}: {', '.join(unknown)}")
            else:
                picked = [r.witness for r in sorted(listed, key=lambda r: (not r.showable, r.witness))][:WITNESSES]
            view["witness_choices"] = [{"witness": r.witness, "name": r.name, "selected": r.witness in picked} for r in listed]
            cells = p["matrix"].where(F.col("witness").isin(picked)).orderBy("unit").collect() if picked else []
            view["witnesses"] = [{"witness": w, "segments": [{"unit": c.unit_id, "status": c.status, "text": c.text} for c in cells if c.witness == w]} for w in picked]
            units = [r.unit for r in p["units"].orderBy("unit").collect()]
            for t in (t for t in made if t.source_version_id == v):
                found = {r.source_unit: r for r in tr.aligned_units(t.version_id).where(F.col("source_unit").isin(units)).collect()}
                view["translations"].append({**t.asDict(), "segments": [{"unit": found[u].translation_unit_id, "text": found[u].translation_text} for u in units if u in found]})
        out["versions"].append(view)
    return out


def works(tables: dict[str, DataFrame]) -> DataFrame:
    """(work_id, label) of works with source versions, by id."""
    titled = apparatus.historical(tables["versions"]).join(tables["works"].select("work_id", F.col("title").alias("work_title")), "work_id")
    return catalog.work_labels(titled, "work_id", "work_title").orderBy("work_id")
