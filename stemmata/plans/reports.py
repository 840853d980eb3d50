"""Queries of containment, order, drift, omissions and matched measurements over the driver's tables, each with its SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import diagnostics, intervals, numbering, parallels
from ..sources import archives
from ..storage import new_folder
from .projections import table

LINE = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
_ORDER = ", ".join(f"{c} NULLS FIRST" for c in LINE)
#: Sections of orders: how many keys each takes together, from the smallest on; the last takes all.
SECTIONS = {"order": 1, "ten": 10, "hundred": 100, "corpus": 0}


def _sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(otype, rank, key, first, last): orders, tens and hundreds of orders and the corpus, as ranges of slots."""
    slots = numbering.dense_ids(table(spark, sf_dir, "lineitem"), LINE, "slot")
    orders = slots.groupBy("l_orderkey").agg(F.min("slot").alias("first"), F.max("slot").alias("last"))
    parts = []
    for rank, (otype, size) in enumerate(SECTIONS.items()):
        key = F.floor(F.col("l_orderkey") / size) if size else F.lit(0)
        parts.append(orders.groupBy(key.cast("long").alias("key")).agg(F.min("first").alias("first"), F.max("last").alias("last")).select(F.lit(otype).alias("otype"), F.lit(rank).alias("rank"), "key", "first", "last"))
    return reduce(DataFrame.unionByName, parts)


def section_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All sections above every section, by slots alone."""
    every = _sections(spark, sf_dir)
    side = lambda p: every.select(*[F.col(c).alias(f"{p}_{c}") for c in every.columns])
    both = intervals.containing(side("inner"), side("outer"), [], inner_range=("inner_first", "inner_last"), outer_range=("outer_first", "outer_last"))
    return both.where("inner_rank < outer_rank").select("inner_otype", "inner_key", "outer_otype", "outer_key")


def section_contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The converse: of every section the number of sections of each type in it, with their first and last slot."""
    every = _sections(spark, sf_dir)
    side = lambda p: every.select(*[F.col(c).alias(f"{p}_{c}") for c in every.columns])
    both = intervals.containing(side("inner"), side("outer"), [], inner_range=("inner_first", "inner_last"), outer_range=("outer_first", "outer_last"))
    return both.where("inner_rank < outer_rank").groupBy("outer_otype", "outer_key", "inner_otype").agg(F.count("*").alias("n"), F.min("inner_first").alias("first_slot"), F.max("inner_last").alias("last_slot"))


def overlapping_shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of a customer's orders whose lines were shipped over periods with a day in common."""
    day = F.unix_date(F.col("l_shipdate").cast("date")).cast("long")
    periods = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.min(day).alias("first"), F.max(day).alias("last"))
    own = table(spark, sf_dir, "orders").select("o_custkey", F.col("o_orderkey").alias("l_orderkey")).join(periods, "l_orderkey")
    a = own.select("o_custkey", F.col("l_orderkey").alias("order_a"), F.col("first").alias("first_a"), F.col("last").alias("last_a"))
    b = own.select("o_custkey", F.col("l_orderkey").alias("order_b"), F.col("first").alias("first_b"), F.col("last").alias("last_b"))
    both = intervals.overlapping(a, b, ["o_custkey"], left_range=("first_a", "last_a"), right_range=("first_b", "last_b"))
    days = F.least("last_a", "last_b") - F.greatest("first_a", "first_b") + 1
    return both.where("order_a < order_b").select("o_custkey", "order_a", "order_b", days.cast("long").alias("n_days"))


def parallel_order_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of an order by number, without large ones, against those by day of shipment, without accepted ones."""
    lines = table(spark, sf_dir, "lineitem").withColumn("day", F.col("l_shipdate")).select("*", F.col("l_linenumber").alias("unit"))
    source = lines.where("l_quantity <= 45").withColumn("moment", F.lit(None).cast("timestamp"))
    other = lines.where("l_returnflag <> 'A'").withColumn("moment", F.col("day"))
    found = parallels.order_violations(source, other, ["l_orderkey"], ["unit"], ["moment", *LINE[1:]])
    return found.select("l_orderkey", F.col("unit").cast("long"), "kind", "source_place", "other_place")


def _pairs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Lines as units of a translation, in order of shipment; the numbers of an order's lines, once each, as units of its source."""
    lines = table(spark, sf_dir, "lineitem").withColumn("said", F.when(F.col("l_discount") == 0, "").when(F.col("l_tax") == 0, "[...]").otherwise(F.col("l_returnflag")))
    return lines.where("l_returnflag <> 'R'"), lines.select("l_orderkey", "l_linenumber").distinct()


def translation_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    generated, source = _pairs(spark, sf_dir)
    return diagnostics.translation_drift(generated, source, ["l_orderkey"], ["l_linenumber"], ["l_linenumber"])


def translation_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drift and collisions of ids by region and nation, with totals of both levels."""
    generated, _ = _pairs(spark, sf_dir)
    collided = diagnostics.id_collisions(generated, ["l_orderkey"], "l_linenumber", "said").groupBy("l_orderkey").agg(
        F.count("*").alias("groups"), F.sum("occurrences").alias("occurrences"), F.count_if("all_equal").alias("equal"), F.sum("n_empty").alias("empty"), F.sum("n_placeholder").alias("placeholder")
    )
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    places = table(spark, sf_dir, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("c_custkey").alias("o_custkey"), "n_name", "r_name")
    orders = table(spark, sf_dir, "orders").select("o_custkey", F.col("o_orderkey").alias("l_orderkey")).join(places, "o_custkey")
    records = translation_drift(spark, sf_dir).join(orders, "l_orderkey").join(collided, "l_orderkey", "left")
    n = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    sums = {"n_versions": F.count("*"), "n_equal": F.count_if("sequence_equal")} | {c: n(c) for c in ("generated_units", "source_units", "common", "missing", "extra", "groups", "occurrences", "equal", "empty", "placeholder")}
    return diagnostics.totals(records, ["r_name", "n_name"], sums)


def _omissions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Returned lines as omissions of the source, lines without discount as marked ones of the translation."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_linenumber").cast("long").alias("unit"), "l_returnflag", "l_discount")
    return lines.where("l_returnflag = 'R'"), lines.where("l_discount < 0.03")


def omission_marker_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return diagnostics.omission_runs(*_omissions(spark, sf_dir), ["l_orderkey"], "unit")


def omission_state_mismatches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines by order and number: how many are returned, against how many of the others say that they are empty."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_returnflag") == "R").alias("empty"), (F.col("l_discount") < 0.03).alias("marked"))
    source, generated = lines.where("empty or l_linenumber < 6"), lines.where("not empty or marked")
    return diagnostics.state_mismatches(source, generated, ["l_orderkey", "l_linenumber"], empty="empty", marker="marked")


def matched_block_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Views and purchases as the old variant, clicks and errors as the new one, in each user's order."""
    events = table(spark, sf_dir, "events").where("event_type <> 'signup'")
    variant = F.when(F.col("event_type").isin("view", "purchase"), "A").otherwise("B")
    blocks = diagnostics.abba_blocks(events.withColumn("variant", variant), ["user_id"], ["ts", "event_id"])
    return diagnostics.matched_summary(blocks.withColumn("label", F.col("user_id") % 10), ["label"])


def _released(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Documents as members of archives, a thousand numbers to each; and a second release that lacks some, has some changed and some new."""
    docs = table(spark, sf_dir, "documents").where("doc_id is not null").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    named = docs.select("doc_id", F.concat(F.lit("docs-"), F.floor(F.col("doc_id") / 1000).cast("string")).alias("archive"), F.concat(F.lit("d"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("member"), "text")
    text = F.when(F.col("doc_id") % 29 == 3, F.concat("text", F.lit("!"))).otherwise(F.col("text"))
    kept = named.where("doc_id % 31 <> 7").withColumn("text", text)
    new = named.where("doc_id % 37 = 5").withColumn("member", F.concat(F.lit("n"), F.col("doc_id").cast("string"), F.lit(".txt"))).withColumn("text", F.lit("new"))
    content = lambda df: df.select("archive", "member", F.encode("text", "UTF-8").alias("content"))
    return content(named), content(kept.unionByName(new))


def archive_member_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both releases written as zip archives, read back and compared by member."""
    found = []
    for rows, name in zip(_released(spark, sf_dir), ("first", "second"), strict=True):
        folder = new_folder(spark, f"release-{name}")
        archives.write(rows, folder)
        found.append(archives.read(spark, folder))
    return archives.differences(*found)


ALL: list[Callable[[SparkSession, str], DataFrame]] = [
    archive_member_differences, section_containment, section_contents, overlapping_shipments, parallel_order_violations, translation_drift, translation_totals,
    omission_marker_runs, omission_state_mismatches, matched_block_summary,
]

_SECTIONS = f"""slots AS (SELECT *, row_number() OVER (ORDER BY {_ORDER}) AS slot FROM lineitem),
o AS (SELECT l_orderkey AS k, min(slot) AS first, max(slot) AS last FROM slots GROUP BY 1),
s(otype, rank, key, first, last) AS (
  SELECT 'order', 0, k, first, last FROM o
  UNION ALL SELECT 'ten', 1, k // 10, min(first), max(last) FROM o GROUP BY 3
  UNION ALL SELECT 'hundred', 2, k // 100, min(first), max(last) FROM o GROUP BY 3
  UNION ALL SELECT 'corpus', 3, 0, min(first), max(last) FROM o
), pairs AS (
  SELECT i.otype AS inner_otype, i.key AS inner_key, i.first, i.last, u.otype AS outer_otype, u.key AS outer_key
  FROM s i JOIN s u ON u.first <= i.first AND i.last <= u.last AND i.rank < u.rank
)"""
_PAIRS = """g AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_discount = 0 THEN '' WHEN l_tax = 0 THEN '[...]' ELSE l_returnflag END AS said FROM lineitem WHERE l_returnflag <> 'R'),
s AS (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem),
gn AS (SELECT l_orderkey, l_linenumber, count(*) AS n FROM g GROUP BY ALL),
counts AS (SELECT l_orderkey, coalesce(n, 0) AS a, CASE WHEN s.l_linenumber IS NULL THEN 0 ELSE 1 END AS b FROM gn FULL JOIN s USING (l_orderkey, l_linenumber)),
sums AS (SELECT l_orderkey, sum(least(a, b))::BIGINT AS common, sum(greatest(b - a, 0))::BIGINT AS missing, sum(greatest(a - b, 0))::BIGINT AS extra FROM counts GROUP BY 1),
gp AS (SELECT l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) - 1 AS place FROM g),
sp AS (SELECT l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) - 1 AS place FROM s),
firsts AS (SELECT l_orderkey, min(place) AS first_mismatch FROM gp FULL JOIN sp USING (l_orderkey, place) WHERE gp.l_linenumber IS DISTINCT FROM sp.l_linenumber GROUP BY 1),
drift AS (
  SELECT l_orderkey, common + extra AS generated_units, common + missing AS source_units, common, missing, extra, missing = 0 AND extra = 0 AS multiset_equal,
    first_mismatch IS NULL AS sequence_equal, first_mismatch FROM sums LEFT JOIN firsts USING (l_orderkey)
)"""
_RUNS = """a AS (
  SELECT l_orderkey, min(unit) AS omitted_first, max(unit) AS omitted_last FROM (
    SELECT l_orderkey, unit, unit - row_number() OVER (PARTITION BY l_orderkey ORDER BY unit) AS run FROM (SELECT DISTINCT l_orderkey, l_linenumber::BIGINT AS unit FROM lineitem WHERE l_returnflag = 'R')
  ) GROUP BY l_orderkey, run
), b AS (
  SELECT l_orderkey, min(unit) AS marked_first, max(unit) AS marked_last FROM (
    SELECT l_orderkey, unit, unit - row_number() OVER (PARTITION BY l_orderkey ORDER BY unit) AS run FROM (SELECT DISTINCT l_orderkey, l_linenumber::BIGINT AS unit FROM lineitem WHERE l_discount < 0.03)
  ) GROUP BY l_orderkey, run
)"""

SQL = {
    "archive_member_differences": """
WITH a AS (SELECT 'docs-' || doc_id // 1000 || '.zip' AS archive, 'd' || doc_id || '.txt' AS member, sha256(coalesce(text, '')) AS sha FROM documents WHERE doc_id IS NOT NULL),
b AS (
  SELECT 'docs-' || doc_id // 1000 || '.zip' AS archive, 'd' || doc_id || '.txt' AS member, sha256(coalesce(text, '') || CASE WHEN doc_id % 29 = 3 THEN '!' ELSE '' END) AS sha FROM documents WHERE doc_id % 31 <> 7
  UNION ALL SELECT 'docs-' || doc_id // 1000 || '.zip', 'n' || doc_id || '.txt', sha256('new') FROM documents WHERE doc_id % 37 = 5
)
SELECT archive, member, CASE WHEN b.sha IS NULL THEN 'missing' WHEN a.sha IS NULL THEN 'surplus' ELSE 'changed' END AS kind, a.sha AS expected_sha256, b.sha AS found_sha256
FROM a FULL JOIN b USING (archive, member) WHERE a.sha IS DISTINCT FROM b.sha""",
    "section_containment": f"WITH {_SECTIONS} SELECT inner_otype, inner_key, outer_otype, outer_key FROM pairs",
    "section_contents": f"WITH {_SECTIONS} SELECT outer_otype, outer_key, inner_otype, count(*) AS n, min(first) AS first_slot, max(last) AS last_slot FROM pairs GROUP BY ALL",
    "overlapping_shipments": """
WITH p AS (SELECT o_custkey, o_orderkey, min(l_shipdate::DATE) AS first, max(l_shipdate::DATE) AS last FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2)
SELECT a.o_custkey, a.o_orderkey AS order_a, b.o_orderkey AS order_b, (least(a.last, b.last) - greatest(a.first, b.first) + 1)::BIGINT AS n_days
FROM p a JOIN p b ON a.o_custkey = b.o_custkey AND a.o_orderkey < b.o_orderkey AND a.first <= b.last AND b.first <= a.last""",
    "parallel_order_violations": f"""
WITH s AS (SELECT l_orderkey, l_linenumber, min(place) AS place, count(*) AS n FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY {_ORDER}) AS place FROM lineitem WHERE l_quantity <= 45) GROUP BY 1, 2),
o AS (SELECT l_orderkey, l_linenumber, min(place) AS place, count(*) AS n FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate NULLS FIRST, {_ORDER}) AS place FROM lineitem WHERE l_returnflag <> 'A') GROUP BY 1, 2),
j AS (
  SELECT l_orderkey, l_linenumber AS unit, s.place AS source_place, o.place AS other_place,
    CASE WHEN coalesce(s.n, 0) > 1 OR coalesce(o.n, 0) > 1 THEN 'repeated' WHEN o.place IS NULL THEN 'missing' WHEN s.place IS NULL THEN 'extra' END AS kind
  FROM s FULL JOIN o USING (l_orderkey, l_linenumber)
), r AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY other_place) AS r FROM j WHERE kind IS NULL),
w AS (SELECT *, lag(r) OVER (PARTITION BY l_orderkey ORDER BY source_place) AS before FROM r)
SELECT l_orderkey, unit::BIGINT AS unit, kind, source_place, other_place FROM j WHERE kind IS NOT NULL
UNION ALL
SELECT l_orderkey, unit::BIGINT, CASE WHEN r < before THEN 'swapped' ELSE 'shifted' END, source_place, other_place FROM w WHERE r < before OR source_place <> other_place""",
    "translation_drift": f"WITH {_PAIRS} SELECT * FROM drift",
    "translation_totals": f"""
WITH {_PAIRS}, c AS (
  SELECT l_orderkey, count(*) AS groups, sum(n)::BIGINT AS occurrences, count(*) FILTER (WHERE same) AS equal, sum(e)::BIGINT AS empty, sum(p)::BIGINT AS placeholder FROM (
    SELECT l_orderkey, l_linenumber, count(*) AS n, min(said) = max(said) AS same, count(*) FILTER (WHERE said = '') AS e, count(*) FILTER (WHERE said = '[...]') AS p FROM g GROUP BY 1, 2
  ) WHERE n > 1 GROUP BY 1
), r AS (
  SELECT d.*, r_name, n_name, c.* EXCLUDE (l_orderkey) FROM drift d JOIN orders ON d.l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey LEFT JOIN c ON c.l_orderkey = d.l_orderkey
)
SELECT r_name, n_name, grouping(r_name, n_name)::BIGINT AS grouping, count(*) AS n_versions, count(*) FILTER (WHERE sequence_equal) AS n_equal,
  {', '.join(f'coalesce(sum({c}), 0)::BIGINT AS {c}' for c in ('generated_units', 'source_units', 'common', 'missing', 'extra', 'groups', 'occurrences', 'equal', 'empty', 'placeholder'))}
FROM r GROUP BY ROLLUP (r_name, n_name)""",
    "omission_marker_runs": f"""
WITH {_RUNS}, met AS (SELECT * FROM a JOIN b USING (l_orderkey) WHERE omitted_first <= marked_last AND marked_first <= omitted_last)
SELECT l_orderkey, CASE WHEN omitted_first = marked_first AND omitted_last = marked_last THEN 'exact' ELSE 'matched' END AS status, omitted_first, omitted_last, marked_first, marked_last,
  least(omitted_last, marked_last) - greatest(omitted_first, marked_first) + 1 AS shared FROM met
UNION ALL SELECT l_orderkey, 'unmarked', omitted_first, omitted_last, NULL, NULL, 0 FROM a ANTI JOIN met USING (l_orderkey, omitted_first)
UNION ALL SELECT l_orderkey, 'unfounded', NULL, NULL, marked_first, marked_last, 0 FROM b ANTI JOIN met USING (l_orderkey, marked_first)""",
    "omission_state_mismatches": """
WITH s AS (SELECT l_orderkey, l_linenumber, count(*) AS n_source, count(*) FILTER (WHERE l_returnflag = 'R') AS n_empty FROM lineitem WHERE l_returnflag = 'R' OR l_linenumber < 6 GROUP BY 1, 2),
g AS (SELECT l_orderkey, l_linenumber, count(*) AS n_generated, count(*) FILTER (WHERE l_discount < 0.03) AS n_marked FROM lineitem WHERE l_returnflag <> 'R' OR l_discount < 0.03 GROUP BY 1, 2),
b AS (SELECT l_orderkey, l_linenumber, coalesce(n_source, 0) AS n_source, coalesce(n_empty, 0) AS n_empty, coalesce(n_generated, 0) AS n_generated, coalesce(n_marked, 0) AS n_marked FROM s FULL JOIN g USING (l_orderkey, l_linenumber))
SELECT *, n_source > 1 OR n_generated > 1 AS ambiguous FROM b WHERE n_source <> n_generated OR n_empty <> n_marked""",
    "matched_block_summary": """
WITH e AS (
  SELECT user_id, CASE WHEN event_type IN ('view', 'purchase') THEN 'A' ELSE 'B' END AS variant, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS place
  FROM events WHERE event_type <> 'signup'
), f AS (SELECT user_id, place // 4 AS block, list(variant ORDER BY place) AS variants, list(value ORDER BY place) AS v FROM e GROUP BY 1, 2),
m AS (SELECT user_id % 10 AS label, (v[1] + v[4]) / 2 AS a, (v[2] + v[3]) / 2 AS b FROM f WHERE variants = ['A', 'B', 'B', 'A']),
s AS (SELECT label, count(*) AS n_blocks, round(median(a), 3) AS baseline_median, round(median(b), 3) AS candidate_median, round(median(b - a), 3) AS median_difference FROM m GROUP BY 1)
SELECT *, CASE WHEN candidate_median > 0 THEN round(baseline_median / candidate_median, 3) END AS ratio FROM s""",
}
