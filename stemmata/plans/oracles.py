"""DuckDB SQL that gives the rows of the catalogue's queries, written apart from them."""

from __future__ import annotations

from . import codices, editions, inventories, reports
from .projections import ATTESTATIONS, MATRIX, UNITS, WITNESSES

LINE_ORDER = "l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate"
WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
PLACES = """SELECT c_custkey, r_name, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""
OCCURRENCES = """SELECT event_id, user_id, event_type, value, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS k FROM events"""
ALIGNED = f"""SELECT coalesce(a.user_id, b.user_id) AS user_id, coalesce(a.k, b.k) AS occurrence, a.event_id AS translation_event_id, b.event_id AS source_event_id,
  a.value AS translation_value, b.value AS source_value
FROM (SELECT * FROM ({OCCURRENCES}) WHERE event_type = 'view') a FULL JOIN (SELECT * FROM ({OCCURRENCES}) WHERE event_type = 'click') b ON a.user_id = b.user_id AND a.k = b.k"""
URL = "replace(replace(url_encode({0}), '%20', '+'), '%7E', '~')"

SQL: dict[str, str] = {
    "passage_lookup": """
WITH f AS (SELECT conv_id, turn, count(*) AS n_rows, min(role) AS role, min(text) AS text FROM conversations GROUP BY ALL),
a AS (SELECT conv_id, unnest([0, 1, 99])::BIGINT AS turn FROM (SELECT DISTINCT conv_id FROM conversations))
SELECT a.conv_id, a.turn, f.n_rows, f.role, f.text, CASE WHEN f.n_rows IS NULL THEN 'not_present' ELSE 'available' END AS status
FROM a LEFT JOIN f ON a.conv_id = f.conv_id AND a.turn = f.turn""",
    "work_passage_status": f"""
WITH u AS ({UNITS}), asked AS (SELECT unnest([1, 3, 7])::BIGINT AS unit)
SELECT o.o_custkey AS work, o.o_orderkey AS version, asked.unit,
  CASE WHEN o.o_orderkey NOT IN (SELECT version FROM u) THEN 'metadata_only' WHEN u.unit IS NULL THEN 'not_present' ELSE 'available' END AS status
FROM orders o CROSS JOIN asked LEFT JOIN u ON u.version = o.o_orderkey AND u.unit = asked.unit""",
    "witness_state_matrix": f"SELECT version, unit, witness, status, text FROM ({MATRIX})",
    "witness_coverage": f"""
SELECT version, witness, count(*) FILTER (WHERE status = 'reading') AS n_reading, count(*) FILTER (WHERE status = 'omission') AS n_omission,
  count(*) FILTER (WHERE status = 'unattested') AS n_unattested, count(*) FILTER (WHERE status = 'unattested') = 0 AS complete
FROM ({MATRIX}) GROUP BY ALL""",
    "witness_attested_text": f"""
WITH g AS (SELECT version, witness, coalesce(string_agg(text, ' ' ORDER BY unit) FILTER (WHERE text <> ''), '') AS attested_text, count(*) FILTER (WHERE status = 'unattested') = 0 AS complete FROM ({MATRIX}) GROUP BY ALL)
SELECT version, witness, attested_text, complete, CASE WHEN complete THEN attested_text END AS text FROM g""",
    "witness_text_corpus_order": f"""
SELECT witness, length(t)::BIGINT AS n_chars, sha256(t) AS sha256 FROM (
  SELECT witness, coalesce(string_agg(text, ' ' ORDER BY version, unit) FILTER (WHERE text <> ''), '') AS t FROM ({ATTESTATIONS}) GROUP BY witness)""",
    "primary_reading": f"""
WITH r AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {LINE_ORDER}) AS reading_index, CASE WHEN l_returnflag = 'N' THEN '0' ELSE l_returnflag END AS option FROM lineitem),
p AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY option <> '0', reading_index) AS k FROM r)
SELECT l_orderkey, l_linenumber, reading_index, option, l_partkey, coalesce(try_cast(option AS INT), -1) AS option_number FROM p WHERE k = 1""",
    "apparatus_listing": f"""
SELECT version, unit, text, count(*) AS n_witnesses, string_agg(DISTINCT witness::VARCHAR, ' ' ORDER BY witness::VARCHAR) AS witnesses FROM ({ATTESTATIONS}) GROUP BY version, unit, text""",
    "reading_tokens": f"""
SELECT conv_id, turn, CASE WHEN role = 'user' THEN 'word' ELSE 'variant_word' END AS kind, unnest(range(1, len(w) + 1))::BIGINT AS position, unnest(w) AS word
FROM (SELECT conv_id, turn, role, {WORDS} AS w FROM conversations)""",
    "tokenize_documents": f"""
SELECT doc_id, position, word, CASE WHEN position < n THEN ' ' ELSE '' END AS trailer FROM (
  SELECT doc_id, unnest(range(1, len(w) + 1))::BIGINT AS position, unnest(w) AS word, len(w) AS n FROM (SELECT doc_id, {WORDS} AS w FROM documents))""",
    "token_reconstruction_audit": r"""
SELECT doc_id, len(w)::BIGINT AS n_tokens, array_to_string(w, ' ') = regexp_replace(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g'), '^ | $', '', 'g') AS ok
FROM (SELECT doc_id, text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents)""",
    "slot_numbering": f"SELECT row_number() OVER (ORDER BY l_orderkey, l_linenumber, {LINE_ORDER}) AS slot, l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem",
    "section_address": f"SELECT c_custkey, r_name || ':' || n_name || '.' || c_custkey AS source_ref, r_name || ':' || n_name AS chapter, c_custkey::VARCHAR AS verse FROM ({PLACES})",
    "one_level_sections": "SELECT p_brand AS version, '1' AS chapter, p_partkey::VARCHAR AS verse, p_partkey::VARCHAR AS source_ref, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS verse_index FROM part",
    "mixed_depth_sections": f"""
SELECT r_name || ':' || n_name AS chapter, c_custkey::VARCHAR AS verse, r_name || ':' || n_name || '.' || c_custkey AS source_ref, false AS is_shallow
FROM ({PLACES}) WHERE c_custkey IN (SELECT o_custkey FROM orders)
UNION ALL
SELECT r_name, n_name, r_name || ':' || n_name, true FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey IN (SELECT s_nationkey FROM supplier)""",
    "duplicate_section_labels": """
SELECT version, o_orderkey, verse, CASE WHEN k = 1 THEN verse ELSE verse || '~' || k END AS label, k AS section_occurrence FROM (
  SELECT o_custkey AS version, o_orderkey, year(o_orderdate)::VARCHAR AS verse, row_number() OVER (PARTITION BY o_custkey, year(o_orderdate) ORDER BY o_orderkey) AS k FROM orders)""",
    "boundary_text": """
SELECT conv_id, turn, role, CASE WHEN role = 'assistant' AND turn % 4 = 1 THEN chr(10) || chr(10) WHEN role = 'assistant' THEN chr(10)
  WHEN lead(1) OVER (PARTITION BY conv_id ORDER BY turn, role) IS NULL THEN '' ELSE ' ' END AS boundary FROM conversations""",
    "nearest_nonempty_ancestor": f"""
WITH p AS ({PLACES}), o AS (SELECT p.*, o_orderkey FROM orders JOIN p ON o_custkey = c_custkey),
c AS (SELECT c_custkey, min(o_orderkey) AS a FROM o GROUP BY 1), n AS (SELECT n_name, min(o_orderkey) AS a FROM o GROUP BY 1), r AS (SELECT r_name, min(o_orderkey) AS a FROM o GROUP BY 1)
SELECT p.r_name || '/' || p.n_name || '/' || p.c_custkey AS place, coalesce(c.a, n.a, r.a, (SELECT min(o_orderkey) FROM o)) AS anchor,
  CASE WHEN c.a IS NOT NULL THEN 3 WHEN n.a IS NOT NULL THEN 2 WHEN r.a IS NOT NULL THEN 1 ELSE 0 END::BIGINT AS anchor_level
FROM p LEFT JOIN c ON c.c_custkey = p.c_custkey LEFT JOIN n ON n.n_name = p.n_name LEFT JOIN r ON r.r_name = p.r_name""",
    "undeclared_witness_synthesis": """
SELECT DISTINCT l_returnflag AS version, l_suppkey AS witness, 1 AS is_undeclared FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 5000)""",
    "version_ids_slug": """
WITH s AS (SELECT p_partkey, p_brand, p_brand || '__' || trim(regexp_replace(p_name, '[^A-Za-z0-9]+', '_', 'g'), '_') AS base FROM part),
k AS (SELECT *, row_number() OVER (PARTITION BY base ORDER BY p_partkey) AS k, count(*) OVER (PARTITION BY p_brand) AS n FROM s)
SELECT p_partkey, CASE WHEN n = 1 THEN p_brand WHEN k = 1 THEN base ELSE base || '_' || k END AS version_id FROM k""",
    "passage_neighbors": """
SELECT o_custkey, o_orderkey, lag(o_orderkey) OVER w AS previous, lead(o_orderkey) OVER w AS next FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)""",
    "preferred_version_neighbors": """
WITH y AS (SELECT DISTINCT o_custkey, year(o_orderdate)::INT AS year FROM orders),
n AS (SELECT *, lag(year) OVER w AS previous, lead(year) OVER w AS next FROM y WINDOW w AS (PARTITION BY o_custkey ORDER BY year)),
f AS (SELECT c_nationkey, year, c_custkey AS context_version, previous, next, row_number() OVER (PARTITION BY c_nationkey, year ORDER BY c_acctbal DESC, c_custkey) AS k FROM n JOIN customer ON o_custkey = c_custkey)
SELECT c_nationkey, year, context_version, previous, next FROM f WHERE k = 1""",
    "default_version_selection": """
WITH r AS (SELECT c_nationkey, c_custkey, c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P') AS available FROM customer)
SELECT * FROM (SELECT c_nationkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY NOT available, c_custkey) AS choice, c_custkey, available FROM r) WHERE choice <= 2""",
    "default_witness_selection": f"""
WITH r AS (SELECT w.version, w.witness, s_name, s_acctbal > 5000 AND s_nationkey % 5 <> 0 AS showable FROM ({WITNESSES}) w JOIN supplier ON s_suppkey = w.witness)
SELECT * FROM (SELECT version, row_number() OVER (PARTITION BY version ORDER BY NOT showable, s_name) AS choice, witness, showable FROM r) WHERE choice <= 4""",
    "explicit_selection_order": """
SELECT p.i AS position, s_suppkey, s_name FROM supplier JOIN (VALUES (1::BIGINT, 7), (2, 3), (3, 1), (4, 9)) p(i, k) ON s_suppkey = p.k""",
    "multiset_signature_match": """
WITH c AS (SELECT l_orderkey, l_linenumber, l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY ALL),
s AS (SELECT l_orderkey, string_agg(l_linenumber || ',' || l_returnflag || ',' || l_linestatus || ',' || n, ';' ORDER BY l_linenumber, l_returnflag, l_linestatus) AS sig FROM c GROUP BY 1),
f AS (SELECT sig, count(*) AS n, min(l_orderkey) AS source FROM s JOIN orders ON o_orderkey = l_orderkey WHERE o_orderstatus = 'F' GROUP BY 1)
SELECT l_orderkey AS translation, coalesce(f.n, 0) AS n_matches, CASE WHEN f.n = 1 THEN f.source END AS source
FROM s JOIN orders ON o_orderkey = l_orderkey LEFT JOIN f ON f.sig = s.sig WHERE o_orderstatus = 'O'""",
    "occurrence_alignment": f"SELECT user_id, occurrence, translation_event_id, source_event_id FROM ({ALIGNED})",
    "aligned_units": f"SELECT translation_event_id, source_event_id, translation_value, source_value FROM ({ALIGNED}) WHERE translation_event_id IS NOT NULL AND source_event_id IS NOT NULL",
    "aligned_to_source_units": f"SELECT source_event_id, translation_event_id FROM ({ALIGNED}) WHERE source_event_id IS NOT NULL",
    "alignment_drift": """
WITH a AS (SELECT user_id, count(*) FILTER (WHERE event_type = 'view') AS a, count(*) FILTER (WHERE event_type = 'click') AS b FROM events WHERE event_type IN ('view', 'click') GROUP BY 1)
SELECT user_id, least(a, b) AS common, greatest(b - a, 0) AS missing, greatest(a - b, 0) AS extra FROM a""",
    "alignment_coverage_by_type": f"""
WITH o AS ({OCCURRENCES}), v AS (SELECT user_id, k FROM o WHERE event_type = 'view')
SELECT event_type, count(*) AS n_units, count(v.k) AS n_aligned, round(count(v.k) / count(*)::DOUBLE, 3) AS coverage
FROM o LEFT JOIN v ON o.user_id = v.user_id AND o.k = v.k GROUP BY 1""",
    "collision_groups": "SELECT md5(text) AS md5, count(*) AS n, min(doc_id) AS first, max(doc_id) AS last FROM documents GROUP BY 1 HAVING count(*) > 1",
    "positional_threeway_join": f"""
WITH a AS (SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, {LINE_ORDER}) AS position, l_partkey AS source_part FROM lineitem),
b AS (SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, {LINE_ORDER}) AS position, l_partkey AS word_part, p_name FROM lineitem JOIN part ON l_partkey = p_partkey),
c AS (SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, {LINE_ORDER}) AS position, l_partkey AS slot_part FROM lineitem WHERE l_quantity > 1)
SELECT l_orderkey, position, source_part, word_part, slot_part, p_name, coalesce(source_part = word_part AND source_part = slot_part, false) AS agree
FROM a FULL JOIN b USING (l_orderkey, position) FULL JOIN c USING (l_orderkey, position)""",
    "classification_lookup": """
SELECT p_partkey, unnest(range(0, len(w)))::BIGINT AS position, unnest(w) AS id, upper(unnest(w)) AS label FROM (SELECT p_partkey, string_split(p_name, ' ') AS w FROM part)""",
    "works_by_label": """
SELECT label, count(DISTINCT p_partkey) AS n_works, min(p_partkey) AS first_work, max(p_partkey) AS last_work
FROM (SELECT p_partkey, upper(unnest(string_split(p_name, ' '))) AS label FROM part) GROUP BY 1""",
    "vocabulary_with_unused": """
WITH v AS (SELECT DISTINCT upper(unnest(string_split(p_name, ' '))) AS label FROM part UNION SELECT DISTINCT upper(p_type) FROM part),
u AS (SELECT upper(unnest(string_split(p_name, ' '))) AS label FROM part)
SELECT v.label, count(u.label) AS n FROM v LEFT JOIN u ON v.label = u.label GROUP BY 1""",
    "metadata_json_fields": "SELECT event_id, json_extract_string(props, '$.k') AS k, json_extract_string(props, '$.absent') AS absent FROM events",
    "metadata_scalar_count": "SELECT event_type, sum(coalesce(len(json_keys(props)), 0))::BIGINT AS n_scalars, count(*) AS n_documents FROM events GROUP BY 1",
    "work_chooser_labels": """
WITH s AS (SELECT source, count(DISTINCT trim(coalesce(lang, ''))) AS n, max(trim(coalesce(lang, ''))) AS t FROM documents WHERE trim(coalesce(source, '')) <> '' GROUP BY 1)
SELECT source, CASE WHEN n = 1 AND t <> '' THEN t || ' (' || source || ')' ELSE source END AS label FROM s""",
    "edge_type_contract": """
SELECT 'line_of' AS edge, count(*) AS n_edges, 0::BIGINT AS bad_sources, count(*) FILTER (WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)) AS bad_targets FROM lineitem
UNION ALL SELECT 'order_of', count(*), 0, count(*) FILTER (WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)) FROM orders
UNION ALL SELECT 'customer_of', count(*), 0, count(*) FILTER (WHERE c_nationkey NOT IN (SELECT n_nationkey FROM nation)) FROM customer
UNION ALL SELECT 'nation_of', count(*), 0, count(*) FILTER (WHERE n_regionkey NOT IN (SELECT r_regionkey FROM region)) FROM nation""",
    "edge_cardinality_contract": """
SELECT o_orderkey, count(DISTINCT l_suppkey) AS n_targets FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1 HAVING count(DISTINCT l_suppkey) NOT BETWEEN 1 AND 5""",
    "contiguous_type_blocks": """
WITH n AS (SELECT (SELECT count(DISTINCT o_orderkey) FROM orders) AS o, (SELECT count(DISTINCT c_custkey) FROM customer) AS c, (SELECT count(DISTINCT n_nationkey) FROM nation) AS a, (SELECT count(DISTINCT r_regionkey) FROM region) AS r)
SELECT 'order' AS otype, 1::BIGINT AS first_node, o AS last_node, o AS n, true AS ok FROM n
UNION ALL SELECT 'customer', o + 1, o + c, c, true FROM n UNION ALL SELECT 'nation', o + c + 1, o + c + a, a, true FROM n UNION ALL SELECT 'region', o + c + a + 1, o + c + a + r, r, true FROM n""",
    "section_coverage_exactly_once": """
WITH l AS (SELECT DISTINCT * FROM lineitem),
c AS (SELECT 'order' AS otype, (SELECT count(*) FROM orders WHERE o_orderkey = l_orderkey) AS n FROM l UNION ALL SELECT 'part', (SELECT count(*) FROM part WHERE p_partkey = l_partkey AND p_size <= 25) FROM l)
SELECT otype, count(*) FILTER (WHERE n = 0) AS n_never, count(*) FILTER (WHERE n = 1) AS n_once, count(*) FILTER (WHERE n > 1) AS n_several FROM c GROUP BY 1""",
    "section_address_collisions": "SELECT o_custkey, year(o_orderdate)::BIGINT AS year, count(*) AS n, min(o_orderkey) AS first, max(o_orderkey) AS last FROM orders GROUP BY 1, 2 HAVING count(*) > 1",
    "ownership_audit": """
WITH n AS (
  SELECT 'order_of_line' AS "check", (SELECT count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)) AS n_broken
  UNION ALL SELECT 'status_of_line', (SELECT count(*) FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey WHERE o_orderstatus IS DISTINCT FROM l_linestatus)
  UNION ALL SELECT 'customer_of_order', (SELECT count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer))
  UNION ALL SELECT 'nation_of_supplier', (SELECT count(*) FROM supplier WHERE s_nationkey NOT IN (SELECT n_nationkey FROM nation)))
SELECT "check", n_broken, n_broken = 0 AS ok FROM n""",
    "occurrence_ownership_audit": """
WITH w AS (SELECT l_orderkey, l_linenumber, lag(l_linenumber) OVER o AS before, row_number() OVER o AS k
  FROM lineitem WINDOW o AS (PARTITION BY l_orderkey ORDER BY l_shipdate, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus))
SELECT l_orderkey, count(*) FILTER (WHERE l_linenumber = 1) AS n_units, count(*) FILTER (WHERE NOT (l_linenumber = 1 OR (before IS NOT NULL AND l_linenumber = before + 1))) AS n_out_of_order FROM w GROUP BY 1""",
    "multiset_parity": """
WITH b AS (SELECT l_orderkey, min(l_linestatus) AS s FROM lineitem GROUP BY 1)
SELECT (SELECT count(*) FROM (SELECT o_orderkey, o_orderstatus FROM orders EXCEPT ALL SELECT * FROM b)) AS only_left, (SELECT count(*) FROM (SELECT * FROM b EXCEPT ALL SELECT o_orderkey, o_orderstatus FROM orders)) AS only_right""",
    "key_set_difference": """
SELECT DISTINCT o_orderkey AS key, 'left' AS only_in FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
UNION ALL SELECT DISTINCT l_orderkey, 'right' FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)""",
    "inventory_counts": " UNION ALL ".join(f"SELECT '{t}' AS otype, count(*) AS n FROM {t}" for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")),
    "content_hash": """
SELECT source, count(*) AS n, sha256(string_agg(m, chr(10) ORDER BY m)) AS set_sha256 FROM (SELECT source, doc_id || ':' || sha256(text) AS m FROM documents) GROUP BY 1""",
    "latency_summary": """
SELECT event_type, count(*) AS n, arg_min(value, (ts, event_id)) AS first, median(value) AS median, min(value) AS least, max(value) AS greatest FROM events GROUP BY 1""",
    "comparison_model": f"""
WITH p AS (SELECT * FROM (SELECT o_custkey AS work, o_orderkey AS version, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey NOT IN (SELECT l_orderkey FROM lineitem), o_orderkey) AS version_choice FROM orders) WHERE version_choice <= 2),
w AS (SELECT * FROM (SELECT version, witness, row_number() OVER (PARTITION BY version ORDER BY witness) AS witness_choice FROM ({WITNESSES})) WHERE witness_choice <= 4)
SELECT p.work, p.version_choice, m.version, w.witness_choice, m.witness, m.unit, m.status, m.text
FROM ({MATRIX}) m JOIN p ON p.version = m.version JOIN w ON w.version = m.version AND w.witness = m.witness""",
    "comparison_href": f"""
SELECT p_partkey, '/compare?work=' || {URL.format("p_brand")} || '&chapter=' || {URL.format("p_type")} || '&verse=' || {URL.format("p_name")} || '&version=' AS href FROM part""",
    "html_escape": """
WITH e AS (SELECT page_id, replace(replace(replace(replace(replace(coalesce(html, ''), '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), '''', '&#x27;') AS s FROM pages)
SELECT page_id, length(s) AS n_chars, md5(s) AS md5 FROM e""",
}

SQL |= editions.SQL | reports.SQL | codices.SQL | inventories.SQL
