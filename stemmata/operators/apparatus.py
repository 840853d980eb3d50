"""Critical apparatus: who attests what.

Tables (keys may be any columns; ``version`` is the list of key columns of an edition or passage):
units(version.., unit), readings(version.., unit, reading_index, text, ...), witnesses(version.., witness),
attestations(version.., unit, witness, text): one row for each reading and witness that cites it.

Four absences differ and are never merged: omission (a reading without text), unattested (no reading of
that witness), not_present (the version lacks the address), metadata_only (the version has no text).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.streams import digests
from ..functions.unicode import slug
from .guards import none_of, repeated
from .numbering import ordinal

READING, OMISSION, UNATTESTED = "reading", "omission", "unattested"
TRANSLATIONS = ("generated_translation", "parallel_translation")


def historical(versions: DataFrame, kind: str = "version_kind") -> DataFrame:
    """Versions that are sources, not translations."""
    return versions.where(~F.coalesce(F.col(kind), F.lit("")).isin(*TRANSLATIONS))


def without_synthetic(witnesses: DataFrame) -> DataFrame:
    """Witnesses that stand for a manuscript; a blank siglum is none."""
    return witnesses.where((F.coalesce("is_synthetic", F.lit(0)) != 1) & (F.trim(F.coalesce("witness", F.lit(""))) != ""))


def single_readings(attestations: DataFrame, keys: list[str], *, check: bool = True) -> DataFrame:
    """``attestations`` if no witness has two readings of a unit; else an error that names some."""
    if check:
        none_of(repeated(attestations, *keys), "a witness has several readings of a unit")
    return attestations


def state(reading: Column, text: Column) -> Column:
    return F.when(reading.isNull(), UNATTESTED).when(F.coalesce(text, F.lit("")) == "", OMISSION).otherwise(READING)


def witness_matrix(units: DataFrame, witnesses: DataFrame, attestations: DataFrame, version: list[str], *, unit: str = "unit", witness: str = "witness", text: str = "text") -> DataFrame:
    """Each unit with each witness of its version, and the witness' state there.

    Units meet witnesses by an equi-join on the version; the attestations join on the full key.
    """
    cells = units.join(witnesses, version)
    found = attestations.select(*version, unit, witness, F.coalesce(text, F.lit("")).alias("text"), F.lit(True).alias("__read"))
    joined = cells.join(found, [*version, unit, witness], "left")
    return joined.withColumn("status", state(F.col("__read"), F.col("text"))).drop("__read")


def coverage(matrix: DataFrame, by: list[str]) -> DataFrame:
    """Per witness the number of units by state, and whether none is unattested."""
    n = lambda s: F.count_if(F.col("status") == s)
    return matrix.groupBy(*by).agg(n(READING).alias("n_reading"), n(OMISSION).alias("n_omission"), n(UNATTESTED).alias("n_unattested"), (n(UNATTESTED) == 0).alias("complete"))


def counted_coverage(units: DataFrame, witnesses: DataFrame, attestations: DataFrame, version: list[str], *, unit: str = "unit", witness: str = "witness", text: str = "text") -> DataFrame:
    """``coverage`` of the matrix of all three, without making it: what a witness attests is counted where it stands, and what it leaves
    out is the rest of its version's units. A witness has one reading of a unit."""
    sums = _attested(units, attestations, [*version, witness], version, unit, [F.count_if(F.col(text) != "").alias("n_reading"), F.count_if(F.coalesce(text, F.lit("")) == "").alias("n_omission")])
    whole = _of_all(units, witnesses, sums, version, witness)
    n = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    out = whole.select(*version, witness, "__units", n("n_reading"), n("n_omission")).withColumn("n_unattested", F.col("__units") - F.col("n_reading") - F.col("n_omission"))
    return out.select(*version, witness, "n_reading", "n_omission", "n_unattested", (F.col("n_unattested") == 0).alias("complete"))


def counted_text(units: DataFrame, witnesses: DataFrame, attestations: DataFrame, version: list[str], *, unit: str = "unit", witness: str = "witness", text: str = "text") -> DataFrame:
    """``attested_text`` of the matrix of all three in the order of units, without making it."""
    sums = _attested(units, attestations, [*version, witness], version, unit, [joined_text(F.coalesce(text, F.lit("")), [F.col(unit)]).alias("attested_text"), F.count("*").alias("__n")])
    whole = _of_all(units, witnesses, sums, version, witness)
    said, complete = F.coalesce("attested_text", F.lit("")), F.coalesce("__n", F.lit(0)) == F.col("__units")
    return whole.select(*version, witness, said.alias("attested_text"), complete.alias("complete"), F.when(complete, said).alias("text"))


def _attested(units: DataFrame, attestations: DataFrame, by: list[str], version: list[str], unit: str, sums: list[Column]) -> DataFrame:
    return attestations.join(units.select(*version, unit).distinct(), [*version, unit], "left_semi").groupBy(*by).agg(*sums)


def _of_all(units: DataFrame, witnesses: DataFrame, sums: DataFrame, version: list[str], witness: str) -> DataFrame:
    """The witnesses of all versions that have units, with the number of these and what is known of the witness."""
    whole = units.groupBy(*version).agg(F.count("*").alias("__units"))
    return witnesses.select(*version, witness).join(whole, version).join(sums, [*version, witness], "left")


def joined_text(text: Column, order: list[Column]) -> Column:
    """Aggregate: texts that are not empty, in order, with a space between."""
    item = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)], text.alias("t"))
    kept = F.array_sort(F.collect_list(F.when(text != "", item)))
    return F.array_join(F.transform(kept, lambda x: x["t"]), " ")


def attested_text(matrix: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """Per witness its text as far as attested, and the text of the passage where it is complete."""
    got = matrix.groupBy(*by).agg(joined_text(F.col("text"), [F.col(c) for c in order]).alias("attested_text"), F.count_if(F.col("status") == UNATTESTED).alias("__gaps"))
    return got.withColumn("complete", F.col("__gaps") == 0).withColumn("text", F.when(F.col("complete"), F.col("attested_text"))).drop("__gaps")


def witness_text(attestations: DataFrame, order: list[str], *, witness: str = "witness", text: str = "text", units: DataFrame | None = None) -> DataFrame:
    """The text of each witness over the corpus in corpus order, or over ``units`` (with ``position``) in their order."""
    rows, by = attestations, [F.col(c) for c in order]
    if units is not None:
        rows, by = rows.join(units, [c for c in units.columns if c != "position"]), [F.col("position")]
    return rows.groupBy(witness).agg(joined_text(F.col(text), by).alias("text"))


def witness_digest(attestations: DataFrame, order: list[str], *, witness: str = "witness", text: str = "text") -> DataFrame:
    """(witness, n_chars, sha256) of the text of each witness over the corpus in corpus order; the text itself is never put together."""
    said = F.when(F.col(text) != "", F.col(text))
    found = digests(attestations, [witness], [F.col(c) for c in order], said, " ")
    empty = attestations.select(witness).distinct().join(found, witness, "left")
    return empty.select(witness, F.coalesce("n_chars", F.lit(0)).cast("long").alias("n_chars"), F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("sha256"))


def primary(readings: DataFrame, unit: list[str], *, option: str = "option", order: list[str]) -> DataFrame:
    """Of each unit the first reading whose option is exactly ``0``, else the first."""
    rank = F.row_number().over(Window.partitionBy(*unit).orderBy((F.coalesce(option, F.lit("")) != "0"), *order))
    return readings.withColumn("__rank", rank).where("__rank = 1").drop("__rank")


def exactly_one_primary(readings: DataFrame, unit: list[str], flag: str = "is_primary") -> DataFrame:
    none_of(readings.groupBy(*unit).agg(F.count_if(F.col(flag)).alias("n")).where("n <> 1"), "a unit has not exactly one primary reading")
    return readings


def listing(attestations: DataFrame, unit: list[str], *, text: str = "text", witness: str = "witness") -> DataFrame:
    """The readings of each unit with the sorted list of their witnesses."""
    return attestations.groupBy(*unit, text).agg(F.count("*").alias("n_witnesses"), F.array_join(F.array_sort(F.collect_set(F.col(witness).cast("string"))), " ").alias("witnesses"))


def passages(addresses: DataFrame, sections: DataFrame, key: list[str]) -> DataFrame:
    """Each address asked for with what is found there; ``status`` available or not_present."""
    found = sections.withColumn("__there", F.lit(True))
    return addresses.join(found, key, "left").withColumn("status", F.when(F.col("__there"), "available").otherwise("not_present")).drop("__there")


def work_passages(addresses: list[tuple], versions: DataFrame, sections: DataFrame, *, version: str, address: list[str], bare: DataFrame | None = None) -> DataFrame:
    """Each address in each version: available or not_present; versions without text are metadata_only.

    ``addresses``: the few that are asked for, as tuples in the order of the columns ``address``.
    ``bare``: the versions that have metadata only.
    """
    there = sections.select(version, *address).distinct().withColumn("__there", F.lit(True))
    places = F.array(*[F.struct(*[F.lit(x).cast(sections.schema[c].dataType).alias(c) for c, x in zip(address, a, strict=True)]) for a in addresses])
    asked = versions.withColumn("__at", F.explode(places)).select(*versions.columns, *[F.col(f"__at.{c}").alias(c) for c in address])
    textual = asked if bare is None else asked.join(bare.select(version), version, "left_anti")
    out = textual.join(there, [version, *address], "left").withColumn("status", F.when(F.col("__there"), "available").otherwise("not_present")).drop("__there")
    if bare is not None:
        out = out.unionByName(asked.join(bare.select(version), version, "left_semi").withColumn("status", F.lit("metadata_only")))
    return out


def undeclared(cited: DataFrame, declared: DataFrame, key: list[str], on: list[str] | None = None) -> DataFrame:
    """Witnesses that are cited but not declared, once each, marked as such. ``on``: the part of the key that a declaration names."""
    return cited.select(*key).distinct().join(declared.select(*(on or key)).distinct(), on or key, "left_anti").withColumn("is_undeclared", F.lit(1))


def merged_by_slug(cited: DataFrame, declared: DataFrame, version: list[str], order: list[str]) -> DataFrame:
    """``cited`` (version.., order.., witness) with undeclared sigla of a version that make one slug as one witness: it bears the siglum that is
    cited first, of those in one reading the least. Declared sigla stay apart, whatever their slug."""
    strange = undeclared(cited, declared, [*version, "witness"]).select(*version, "witness", slug("witness").alias("__slug"))
    first = cited.join(strange, [*version, "witness"]).groupBy(*version, "__slug").agg(F.min_by("witness", F.struct(*order, "witness")).alias("__first"))
    named = strange.join(first.hint("merge"), [*version, "__slug"]).select(*version, "witness", "__first")
    return cited.join(named, [*version, "witness"], "left").withColumn("witness", F.coalesce("__first", "witness")).select(*cited.columns).distinct()


def reading_tokens(tokens: DataFrame, readings: DataFrame, key: list[str]) -> DataFrame:
    """Tokens of readings that have text: a reading without text has none."""
    return tokens.join(readings.where(F.coalesce("text", F.lit("")) != "").select(*key).distinct(), key, "left_semi")


def neighbours(sections: DataFrame, version: list[str], order: list[str], address: str) -> DataFrame:
    """Previous and next address within the version; never beyond its ends."""
    w = Window.partitionBy(*version).orderBy(*order)
    return sections.withColumn("previous", F.lag(address).over(w)).withColumn("next", F.lead(address).over(w))


def first_by_preference(rows: DataFrame, keys: list[str], preference: list[Column | str]) -> DataFrame:
    return rows.withColumn("__rank", ordinal(keys, preference)).where("__rank = 1").drop("__rank")


def showable(declared: Column, show: Column) -> Column:
    """Declared and not hidden."""
    hidden = ("0", "false", "hide", "hidden", "no", "off")
    return F.coalesce(declared, F.lit(True)) & ~F.lower(F.trim(F.coalesce(show, F.lit("")))).isin(*hidden)


def defaults(rows: DataFrame, keys: list[str], preferred: Column, order: list[str], limit: int) -> DataFrame:
    """The first ``limit`` rows of each key, preferred ones first."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.when(preferred, 0).otherwise(1), *order))
    return rows.withColumn("choice", rank).where(F.col("choice") <= limit)


def chosen(rows: DataFrame, selection: list[object], key: str) -> DataFrame:
    """Rows of an explicit selection in its order, each once; a value without a row is an error. An empty selection gives none."""
    spark = rows.sparkSession
    unique = list(dict.fromkeys(selection))
    picks = spark.createDataFrame([(i, str(x)) for i, x in enumerate(unique, 1)], "position int, __key string")
    none_of(picks.join(rows.select(F.col(key).cast("string").alias("__key")), "__key", "left_anti"), f"unknown {key}")
    return rows.withColumn("__key", F.col(key).cast("string")).join(picks, "__key").drop("__key")


def display_label(otype: Column, name: Column, text: Column) -> Column:
    """How a node without words of its own is shown."""
    named = F.coalesce(F.nullif(F.trim(F.coalesce(name, F.lit(""))), F.lit("")), otype)
    return F.when(otype.isin("reading", "orphan_reading") & (F.coalesce(text, F.lit("")) == ""), "[omission]").when(otype.isin("reading", "orphan_reading", "ellipsis"), text).otherwise(named)
