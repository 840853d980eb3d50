"""Queries of stored indexes, controlled vocabularies and contracts over the driver's tables, each with its SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import contracts, postings, vocabulary
from ..storage import new_folder
from .projections import table

#: The columns of the driver's tables.
COLUMNS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def label_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of part names and types as labels of parts, stored as an index and read back with the labels that no part bears."""
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("work"), F.array_distinct(F.split("p_name", " ")).alias("words"), "p_type", "p_brand")
    words = part.select("work", F.lit("word").alias("kind"), F.posexplode("words").alias("position", "label"))
    types = part.select("work", F.lit("type").alias("kind"), F.lit(0).alias("position"), F.col("p_type").alias("label"))
    assigned = words.unionByName(types)
    unused = part.select(F.lit("word").alias("kind"), F.col("p_brand").alias("label"))
    name = f"labels_{uuid.uuid4().hex}"
    index = postings.LabelIndex.write(assigned, assigned.select("kind", "label").unionByName(unused).distinct(), name, folder=new_folder(spark, "labels"))
    return index.postings()


def label_arrays_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrays of labels made of the events' properties, sound and unsound, against the types of events but one."""
    k, kind = F.get_json_object("props", "$.k").cast("long"), F.col("event_type")
    q = F.concat(F.lit('"'), kind, F.lit('"'))
    doc = (
        F.when(k % 11 == 0, F.concat(F.lit('{"labels": ['), q))
        .when(k % 13 == 0, F.lit('{"other": 1}'))
        .when(k % 7 == 0, F.concat(F.lit('{"labels": '), q, F.lit("}")))
        .when(k % 5 == 0, F.concat(F.lit('{"labels": ['), q, F.lit(", "), k.cast("string"), F.lit("]}")))
        .when(k % 17 == 0, F.concat(F.lit('{"labels": ['), q, F.lit(', " "]}')))
        .when(k % 3 == 0, F.concat(F.lit('{"labels": ['), q, F.lit(", "), q, F.lit("]}")))
        .when(k != 1, F.concat(F.lit('{"labels": ['), q, F.lit(', "any"]}')))
    )
    events = table(spark, sf_dir, "events")
    rows = events.select("event_id", doc.alias("doc"))
    known = events.where("event_type <> 'signup'").select(F.col("event_type").alias("label")).distinct().unionByName(spark.createDataFrame([("any",)], "label string"))
    found = vocabulary.checked(rows, known, "event_id", "doc", "$.labels")
    return found.select("event_id", "reason", F.when(F.col("labels").isNotNull(), F.size("labels")).cast("long").alias("n_labels"), F.get("labels", F.lit(0)).alias("first_label"))


def column_contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Types, nulls and ranges of every column of every table."""
    return contracts.catalog({n: table(spark, sf_dir, n) for n in COLUMNS}).drop("n_distinct")


def edge_contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges between the tables: numbers of targets, and whether they are as promised."""
    t = lambda name, src, dst: table(spark, sf_dir, name).select(F.col(src).cast("long").alias("src"), F.col(dst).cast("long").alias("dst"))
    nodes = {n: table(spark, sf_dir, n).select(F.col(c).cast("long").alias("node")) for n, c in (("customer", "c_custkey"), ("orders", "o_orderkey"), ("nation", "n_nationkey"), ("supplier", "s_suppkey"), ("part", "p_partkey"))}
    edges = {
        "customer_of_nation": contracts.Edge(t("customer", "c_custkey", "c_nationkey"), "customer", "nation", 1, 1),
        "order_of_customer": contracts.Edge(t("orders", "o_orderkey", "o_custkey"), "orders", "customer", 1, 1),
        "orders_by_customer": contracts.Edge(t("orders", "o_custkey", "o_orderkey"), "customer", "orders", 1),
        "parts_in_order": contracts.Edge(t("lineitem", "l_orderkey", "l_partkey"), "orders", "part", 1, 7),
        "parts_by_supplier": contracts.Edge(t("lineitem", "l_suppkey", "l_partkey"), "supplier", "part"),
    }
    return contracts.edges_of(edges, nodes)


def observed_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """On which kinds of texts which columns have values."""
    features = ["lang", "source", "n_chars", "url", "html", "role", "turn", "text", "quality"]
    named = {"document": "documents", "page": "pages", "turn": "conversations", "item": "benchmark", "label": "labels"}
    each = []
    for otype, name in named.items():
        df = table(spark, sf_dir, name)
        each.append(df.select(F.lit(otype).alias("otype"), *[F.col(c).cast("string") if c in df.columns else F.lit(None).cast("string").alias(c) for c in features]))
    found = contracts.observed(reduce(DataFrame.unionByName, each), features)
    return found.select("feature", F.array_join("otypes", " ").alias("otypes"), "n_values")


ALL: list[Callable[[SparkSession, str], DataFrame]] = [label_postings, label_arrays_checked, column_contracts, edge_contracts, observed_features]

_NUMBERS = ("int", "bigint", "double")


def _column_sql() -> str:
    parts = []
    for name, columns in COLUMNS.items():
        for i, (c, kind) in enumerate((x.split(" ") for x in columns.split(", ")), 1):
            n = [f"{f}({c})::DOUBLE + 0.0" if kind in _NUMBERS else "NULL::DOUBLE" for f in ("min", "max")]
            t = [f"left({f}({c}), 200)" if kind == "string" else "NULL::VARCHAR" for f in ("min", "max")]
            parts.append(f"SELECT '{name}' AS \"table\", '{c}' AS \"column\", '{kind}' AS type, {i} AS position, count(*) AS n_rows, count(*) - count({c}) AS n_null, {n[0]} AS least, {n[1]} AS greatest, {t[0]} AS first_text, {t[1]} AS last_text FROM {name}")
    return "\nUNION ALL ".join(parts)


def _edge_sql(name: str, rows: str, src: str, dst: str, source: str, key: str, target: str, least: int, most: int | None) -> str:
    bad = f"x.src IS NULL OR t < {least}" + (f" OR t > {most}" if most else "")
    return f"""SELECT '{name}' AS edge, '{source}' AS source, '{target}' AS target, coalesce(sum(e), 0)::BIGINT AS n_edges, count(*) FILTER (WHERE x.src IS NOT NULL AND t > 0) AS n_sources,
  count(*) FILTER (WHERE x.src IS NOT NULL AND t = 0) AS n_without, min(t) FILTER (WHERE x.src IS NOT NULL) AS least, max(t) FILTER (WHERE x.src IS NOT NULL) AS greatest, count(*) FILTER (WHERE {bad}) = 0 AS ok
FROM (SELECT n.src, e, coalesce(t, 0) AS t FROM (SELECT DISTINCT {key}::BIGINT AS src FROM {source}) n FULL JOIN (SELECT {src}::BIGINT AS src, count(*) AS e, count(DISTINCT {dst}) AS t FROM {rows} GROUP BY 1) d ON n.src = d.src) x"""


SQL = {
    "label_postings": """
WITH a AS (SELECT DISTINCT p_partkey::VARCHAR AS work, 'word' AS kind, unnest(string_split(p_name, ' ')) AS label FROM part UNION ALL SELECT p_partkey::VARCHAR, 'type', p_type FROM part),
v AS (SELECT kind, label FROM a UNION SELECT 'word', p_brand FROM part)
SELECT v.kind, v.label, a.work FROM v LEFT JOIN a ON v.kind = a.kind AND v.label = a.label""",
    "label_arrays_checked": """
WITH d AS (
  SELECT event_id, CASE WHEN k % 11 = 0 THEN '{"labels": [' || q WHEN k % 13 = 0 THEN '{"other": 1}' WHEN k % 7 = 0 THEN '{"labels": ' || q || '}' WHEN k % 5 = 0 THEN '{"labels": [' || q || ', ' || k || ']}'
    WHEN k % 17 = 0 THEN '{"labels": [' || q || ', " "]}' WHEN k % 3 = 0 THEN '{"labels": [' || q || ', ' || q || ']}' WHEN k <> 1 THEN '{"labels": [' || q || ', "any"]}' END AS doc
  FROM (SELECT event_id, json_extract_string(props, '$.k')::BIGINT AS k, '"' || event_type || '"' AS q FROM events)
), p AS (
  SELECT event_id, doc, CASE WHEN json_valid(doc) THEN doc END AS good FROM d
), l AS (
  SELECT event_id, doc, good, json_type(good, '$.labels') AS kind, CASE WHEN json_type(good, '$.labels') = 'ARRAY' THEN json_extract(good, '$.labels[*]') END AS members FROM p
), t AS (SELECT *, list_transform(members, lambda x: CASE WHEN json_type(x) = 'VARCHAR' THEN json_extract_string(x, '$') END) AS texts FROM l),
known AS (SELECT list(DISTINCT event_type) || ['any'] AS k FROM events WHERE event_type <> 'signup'),
j AS (
  SELECT event_id, texts, CASE WHEN doc IS NULL THEN 'null' WHEN good IS NULL THEN 'not JSON' WHEN kind IS NULL THEN 'absent' WHEN kind <> 'ARRAY' THEN 'no array'
    WHEN len(list_filter(texts, lambda x: x IS NULL)) > 0 THEN 'no text' WHEN len(list_filter(texts, lambda x: trim(x) = '')) > 0 THEN 'blank'
    WHEN len(list_filter(texts, lambda x: NOT list_contains(k, x))) > 0 THEN 'unknown' WHEN len(list_distinct(texts)) < len(texts) THEN 'repeated' END AS reason
  FROM t, known
)
SELECT event_id, reason, CASE WHEN reason IS NULL THEN len(texts) END::BIGINT AS n_labels, CASE WHEN reason IS NULL THEN texts[1] END AS first_label FROM j""",
    "column_contracts": _column_sql(),
    "edge_contracts": "\nUNION ALL ".join([
        _edge_sql("customer_of_nation", "customer", "c_custkey", "c_nationkey", "customer", "c_custkey", "nation", 1, 1),
        _edge_sql("order_of_customer", "orders", "o_orderkey", "o_custkey", "orders", "o_orderkey", "customer", 1, 1),
        _edge_sql("orders_by_customer", "orders", "o_custkey", "o_orderkey", "customer", "c_custkey", "orders", 1, None),
        _edge_sql("parts_in_order", "lineitem", "l_orderkey", "l_partkey", "orders", "o_orderkey", "part", 1, 7),
        _edge_sql("parts_by_supplier", "lineitem", "l_suppkey", "l_partkey", "supplier", "s_suppkey", "part", 0, None),
    ]),
    "observed_features": """
WITH r(otype, feature, n) AS (
  SELECT 'document', unnest(['lang', 'source', 'n_chars', 'text']), unnest([count(lang), count(source), count(n_chars), count(text)]) FROM documents
  UNION ALL SELECT 'page', unnest(['url', 'html']), unnest([count(url), count(html)]) FROM pages
  UNION ALL SELECT 'turn', unnest(['role', 'turn', 'text']), unnest([count(role), count(turn), count(text)]) FROM conversations
  UNION ALL SELECT 'item', 'text', count(text) FROM benchmark UNION ALL SELECT 'label', 'quality', count(quality) FROM labels
)
SELECT feature, coalesce(string_agg(otype, ' ' ORDER BY otype) FILTER (WHERE n > 0), '') AS otypes, sum(n)::BIGINT AS n_values FROM r GROUP BY 1""",
}
