"""Queries over books that hold what plain ones lack: ellipses, stray readings, resources, empty divisions, lost versions, translations.

A conversation is a work. Its turns are units, two to a part, with a gap where the system speaks; assistants have a second
reading, cited by a witness that nobody declared. Odd parts end in an ellipsis, even ones hold a division with nothing
but an ellipsis, some parts a stray reading, and some works a part without any text. Every third work has a version
that is lost, every second one a generated translation.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import shapes
from ..sources import xml
from . import edition
from .editions import _inside, _tagged, built_once, spread
from .projections import table

_HEAD = '<divisions><division label="Part" delimiter=":"/><division label="Line" delimiter=""/></divisions>'


def books(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(path, content): one document a conversation."""
    turns = table(spark, sf_dir, "conversations").where("conv_id is not null and turn is not null").groupBy("conv_id", "turn").agg(F.min("role").alias("role"), F.sum(F.length("text")).alias("n"))
    c, t, part = F.col("conv_id"), F.col("turn"), F.col("part")
    turns = turns.withColumn("part", F.floor(t / 2))
    said = F.when(F.col("role") == "system", "").otherwise(_tagged("t", t, " n", F.col("n")))
    more = F.when(F.col("role") == "assistant", '<reading option="1" mss="B Z">alt</reading>').otherwise("")
    line = _tagged('<div number="', t % 2, '"><unit id="', c, ".", t, '"><reading option="0" mss="A">', said, "</reading>", more, "</unit></div>")
    english = _tagged('<div number="', t % 2, '"><unit id="en_', c, ".", t, '"><reading option="0" mss="OCP-Trans">e', t, "</reading></unit></div>")
    lines = turns.withColumn("xml", line).withColumn("en", english)
    by = ["conv_id", "part"]
    parts = _inside(spread(lines, "conv_id"), by, ["turn"], "xml", "en")
    empty = F.when(part % 2 == 0, '<div number="9"><elipsis>gone</elipsis></div>').otherwise("<elipsis>...</elipsis>")
    stray = F.when((c + part) % 3 == 0, _tagged('<reading option="0" mss="A">stray ', c, "</reading>")).otherwise("")
    parts = parts.withColumn("xml", _tagged('<div number="', part, '">', F.col("xml"), empty, stray, "</div>")).withColumn("en", _tagged('<div number="', part, '">', F.col("en"), "</div>"))
    works = _inside(parts, ["conv_id"], ["part"], "xml", "en")
    witness = '<ms abbrev="A" language="Greek" show="yes"/>'
    link = _tagged('<resources><resource name="Log"><info>kept</info><URL>http://example.org/', c, "</URL></resource></resources>")
    last = F.when(c % 5 == 0, '<div number="99"><elipsis>end</elipsis></div>').otherwise("")
    source = _tagged('<version title="Source" author="" language="Greek">', _HEAD, F.when(c % 4 == 0, link).otherwise(""), "<manuscripts>", witness, '<ms abbrev="B" language="Greek" show="no"/></manuscripts><text>', F.col("xml"), last, "</text></version>")
    lost = F.when(c % 3 == 0, _tagged('<version title="Lost" author="" language="Greek">', _HEAD, link, "<manuscripts>", witness, "</manuscripts><text/></version>")).otherwise("")
    english = F.when(c % 2 == 0, _tagged('<version title="English" author="" language="English">', _HEAD, '<manuscripts><ms abbrev="OCP-Trans" language="English" show="yes"/></manuscripts><text>', F.col("en"), "</text></version>")).otherwise("")
    name = _tagged("T", c)
    content = _tagged('<book filename="', name, '" title="Talk ', c, '" textStructure="fluid">', source, lost, english, "</book>")
    return works.select(_tagged(name, ".xml").alias("path"), content.cast("binary").alias("content"))


def built(spark: SparkSession, sf_dir: str) -> edition.Edition:
    return built_once(spark, sf_dir, ("conversations",), books)


def codex_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many nodes without words of their own stand at which slot."""
    return edition.anchors(built(spark, sf_dir)).groupBy("version_id", "otype", "slot").agg(F.count("*").alias("n"))


def codex_translations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The units of generated translations with those of their sources."""
    return built(spark, sf_dir)["unit_alignment"].select("version_id", "translation_unit", "source_version_id", "source_unit")


def damaged(whole: edition.Edition) -> edition.Edition:
    """The edition with faults planted by the number of the work, one kind for each check of ownership."""
    t = whole.tables
    work = t["versions"].select("version_id", F.substring("work_id", 2, 20).cast("long").alias("__work"))

    def broken(df: DataFrame, change: Callable[[DataFrame], DataFrame]) -> DataFrame:
        return change(df.join(work, "version_id")).drop("__work")

    shifted = lambda c, where: F.when(where, F.col(c) + 1).otherwise(F.col(c)).alias(c)
    w, otype = F.col("__work"), F.col("otype")
    places = broken(edition.anchors(whole), lambda d: d.withColumn("slot", shifted("slot", (otype == "ellipsis") & (w % 7 == 1))).withColumn("div", F.when((otype != "orphan_reading") | (w % 11 != 2), F.col("div"))))
    versions = broken(edition.with_generation(t["versions"], ""), lambda d: d.withColumn("generation_marker", F.when(w % 10 != 2, F.col("generation_marker"))).withColumn("generation_model", F.when((w % 10 == 4) & (F.col("version_kind") == "source"), "guessed")))
    manuscripts = broken(t["manuscripts"], lambda d: d.where((w % 13 != 3) | (F.col("witness") != "A")).withColumn("version", shifted("version", w % 6 == 4)))
    units = broken(t["units"], lambda d: d.withColumn("unit_id", F.when(w % 9 == 5, "").otherwise(F.col("unit_id"))).withColumn("source_ref", F.when(w % 9 == 5, F.get("path", F.lit(0))).otherwise(F.col("source_ref"))))
    resources = broken(t["resources"], lambda d: d.withColumn("version_id", F.when(w % 8 == 0, F.concat("version_id", F.lit("x"))).otherwise(F.col("version_id"))))
    return edition.Edition(t | {"anchors": places, "versions": versions, "manuscripts": manuscripts, "resources": resources, "units": units}, whole.warnings)


def codex_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The checks of ownership over the edition with planted faults: how many rows break each."""
    return edition.ownership_checks(damaged(built(spark, sf_dir))).select("check", "n_broken", "ok")


def codex_tree_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shape of the tree of each version."""
    return shapes.version_shapes(built(spark, sf_dir).tables)


def codex_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How nodes without words of their own are shown, and how often."""
    return edition.labels(built(spark, sf_dir)).groupBy("version_id", "otype", "label").agg(F.count("*").alias("n"))


def codex_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text of each version by the form of its words, with what separates units."""
    return edition.running_text(built(spark, sf_dir))


ALL: list[Callable[[SparkSession, str], DataFrame]] = [codex_anchors, codex_translations, codex_report, codex_tree_shapes, codex_labels, codex_texts]

_BOOKS = """t AS (
  SELECT conv_id AS c, turn AS t, turn // 2 AS part, min(role) AS role FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL GROUP BY 1, 2, 3
), w AS (SELECT DISTINCT c FROM t), v AS (
  SELECT c, 0 AS kind, CASE WHEN c % 3 = 0 THEN 'T' || c || '__Source' ELSE 'T' || c END AS version_id FROM w
  UNION ALL SELECT c, 1, 'T' || c || '__Lost' FROM w WHERE c % 3 = 0
  UNION ALL SELECT c, 2, 'T' || c || '__translation_English_English' FROM w WHERE c % 2 = 0
), u AS (
  SELECT v.c, kind, version_id, t, part, row_number() OVER (PARTITION BY version_id ORDER BY t) - 1 AS unit, CASE WHEN kind = 2 OR role = 'system' THEN 1 ELSE 2 END AS n
  FROM v JOIN t ON v.c = t.c WHERE kind <> 1
), s AS (
  SELECT *, sum(n) OVER (ORDER BY version_id, unit) - n + 1 AS slot FROM u
), first AS (SELECT c, kind, version_id, min(slot)::BIGINT AS slot FROM s GROUP BY ALL),
p AS (SELECT c, version_id, part, min(slot)::BIGINT AS slot FROM s WHERE kind = 0 GROUP BY ALL),
whole AS (
  SELECT v.c, v.kind, v.version_id, coalesce(f.slot, o.slot) AS slot FROM v LEFT JOIN first f ON f.version_id = v.version_id LEFT JOIN first o ON o.c = v.c AND o.kind = 0
), m AS (
  SELECT version_id, c, kind, 'A' AS witness FROM v WHERE kind < 2 UNION ALL SELECT version_id, c, kind, 'B' FROM v WHERE kind = 0
  UNION ALL SELECT version_id, c, kind, 'OCP-Trans' FROM v WHERE kind = 2
  UNION ALL SELECT DISTINCT version_id, v.c, kind, 'Z' FROM v JOIN t ON v.c = t.c WHERE kind = 0 AND role = 'assistant'
), n AS (
  SELECT w.version_id, w.c, 'manuscript' AS otype, w.slot FROM m JOIN whole w ON w.version_id = m.version_id
  UNION ALL SELECT version_id, c, 'resource', slot FROM whole WHERE kind = 0 AND c % 4 = 0 OR kind = 1
  UNION ALL SELECT version_id, c, 'ellipsis', slot FROM p
  UNION ALL SELECT version_id, c, 'ellipsis', slot FROM whole WHERE kind = 0 AND c % 5 = 0
  UNION ALL SELECT version_id, c, 'orphan_reading', slot FROM p WHERE (c + part) % 3 = 0
)"""

SQL = {
    "codex_anchors": f"WITH {_BOOKS} SELECT version_id, otype, slot, count(*) AS n FROM n GROUP BY ALL",
    "codex_translations": f"""
WITH {_BOOKS} SELECT a.version_id, a.unit AS translation_unit, b.version_id AS source_version_id, b.unit AS source_unit FROM u a JOIN u b ON a.c = b.c AND a.t = b.t WHERE a.kind = 2 AND b.kind = 0""",
    "codex_report": f"""
WITH {_BOOKS}, broken("check", n_broken) AS (
  SELECT 'ellipsis_anchors', count(*) FROM n WHERE otype = 'ellipsis' AND c % 7 = 1
  UNION ALL SELECT 'orphan_reading_anchors', count(*) FROM n WHERE otype = 'orphan_reading' AND c % 11 = 2
  UNION ALL SELECT 'orphan_witness_ownership', count(*) FROM n WHERE otype = 'orphan_reading' AND c % 13 = 3
  UNION ALL SELECT 'manuscript_ownership', count(*) FROM m WHERE c % 6 = 4 AND witness <> 'Z' AND NOT (witness = 'A' AND c % 13 = 3)
  UNION ALL SELECT 'resource_ownership', count(*) FROM n WHERE otype = 'resource' AND c % 8 = 0
  UNION ALL SELECT 'generated_translation_provenance', count(*) FROM v WHERE c % 10 = 2 AND kind = 2 OR c % 10 = 4 AND kind < 2
  UNION ALL SELECT 'parallel_translation_alignment', count(*) FROM v WHERE kind > 2
  UNION ALL SELECT 'missing_unit_id_once', count(*) FROM (SELECT version_id, c FROM u WHERE c % 9 = 5 GROUP BY version_id, c, part HAVING count(*) > 1)
)
SELECT "check", n_broken, n_broken = 0 AS ok FROM broken""",
    "codex_labels": f"""
WITH {_BOOKS}, l AS (
  SELECT version_id, 'manuscript' AS otype, witness AS label FROM m
  UNION ALL SELECT version_id, 'resource', 'Log' FROM v WHERE kind = 0 AND c % 4 = 0 OR kind = 1
  UNION ALL SELECT version_id, 'ellipsis', CASE WHEN part % 2 = 0 THEN 'gone' ELSE '...' END FROM p
  UNION ALL SELECT version_id, 'ellipsis', 'end' FROM v WHERE kind = 0 AND c % 5 = 0
  UNION ALL SELECT version_id, 'orphan_reading', 'stray ' || c FROM p WHERE (c + part) % 3 = 0
  UNION ALL SELECT version_id, 'reading', CASE WHEN kind = 2 THEN 'e' || u.t WHEN role = 'system' THEN '[omission]' ELSE 't' || u.t || ' n' || chars END
    FROM u JOIN t ON u.c = t.c AND u.t = t.t JOIN (SELECT conv_id, turn, sum(length(text))::BIGINT AS chars FROM conversations GROUP BY 1, 2) x ON x.conv_id = u.c AND x.turn = u.t
  UNION ALL SELECT version_id, 'reading', 'alt' FROM u JOIN t ON u.c = t.c AND u.t = t.t WHERE kind = 0 AND role = 'assistant'
)
SELECT version_id, otype, label, count(*) AS n FROM l GROUP BY ALL""",
    "codex_texts": f"""
WITH {_BOOKS}, x AS (
  SELECT version_id, unit, CASE WHEN kind = 2 THEN 'e' || u.t WHEN role = 'system' THEN '' ELSE 't' || u.t || ' n' || chars END AS said, unit = max(unit) OVER (PARTITION BY version_id) AS last
  FROM u JOIN t ON u.c = t.c AND u.t = t.t JOIN (SELECT conv_id, turn, sum(length(text))::BIGINT AS chars FROM conversations GROUP BY 1, 2) y ON y.conv_id = u.c AND y.turn = u.t
)
SELECT version_id, string_agg(said || CASE WHEN last THEN '' ELSE ' ' END, '' ORDER BY unit) AS text FROM x GROUP BY version_id""",
    "codex_tree_shapes": f"""
WITH {_BOOKS}, d AS (
  SELECT v.version_id, v.c, v.kind, count(DISTINCT t.part) AS parts, count(*) AS lines, count(DISTINCT CASE WHEN t.part % 2 = 0 THEN t.part END) AS empty,
    count(DISTINCT CASE WHEN (v.c + t.part) % 3 = 0 THEN t.part END) AS stray
  FROM v JOIN t ON t.c = v.c GROUP BY ALL
)
SELECT version_id, CASE WHEN kind = 1 THEN 'no divisions' ELSE 'one level' END AS shape, CASE WHEN kind = 1 THEN 0 ELSE 2 END::BIGINT AS unit_levels,
  CASE kind WHEN 0 THEN parts + lines + empty + CASE WHEN c % 5 = 0 THEN 1 ELSE 0 END WHEN 1 THEN 0 ELSE parts + lines END::BIGINT AS n_divs,
  CASE kind WHEN 0 THEN empty + CASE WHEN c % 5 = 0 THEN 1 ELSE 0 END ELSE 0 END::BIGINT AS n_bare_subtrees,
  kind <> 1 AS has_units, kind = 0 AS has_other_items
FROM d""",
}
