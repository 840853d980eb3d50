"""The queries of this subpackage, each with the parameters of production over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import conversations, fill_middle, line_dedup, media, mixing, near_dup, packing, quality, token_counts, token_files, topk, toxicity, url_filter
from .storage import arrow_batches, table

TOKENIZER = "byte_bpe_50k.json"
WORDS = "word_bpe_49k.json"
RULES = [("block", "com", "/en/"), ("allow", "example.com", "/en/7"), ("allow", "net", "/de/"), ("block", "example.net", "/de/8"), ("block", "org", "/es/")]
TOXIC, GOOD = 0.7, 0.3


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    arrow_batches(spark)
    return table(spark, sf_dir, "documents")


def _learnable(spark: SparkSession, sf_dir: str, modulus: int, remainder: int) -> DataFrame:
    return table(spark, sf_dir, "labels").where(~toxicity.held_out(F.col("doc_id"), modulus, remainder))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    model = toxicity.train(docs, _learnable(spark, sf_dir, 3, 1))
    found = toxicity.score(docs, model, passages=False)
    return found.select("doc_id", toxicity.held_out(F.col("doc_id"), 3, 1).alias("held_out"), "score", (F.col("score") >= TOXIC).cast("int").alias("predicted"), "n_passages")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.dedup(_documents(spark, sf_dir).select("doc_id", "text"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


OP2_SQL = r"""
WITH lines AS (
  SELECT doc_id, i, line, translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents)
), owners AS (
  SELECT key, min(doc_id) AS owner FROM lines WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2
), marked AS (
  SELECT l.doc_id, l.i, l.line, o.owner IS NOT NULL AND o.owner <> l.doc_id AS gone FROM lines l LEFT JOIN owners o ON l.key = o.key
)
SELECT doc_id, count(*)::BIGINT AS n_lines, (count(*) FILTER (WHERE gone))::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


def op3_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = media.stored(_documents(spark, sf_dir).select("doc_id", "text"))
    sequences = media.interleave(store.select("doc_id", "n_bytes", "html"))
    return media.resolve(sequences, media.described(store)).select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "position", "caption")


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(_documents(spark, sf_dir).select("doc_id", "text"), width=4)


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    return token_counts.counted(docs, public_tokenizers.path(TOKENIZER)).select("doc_id", *token_counts.RESULT)


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge(pages, RULES).select("page_id", "host", "path", "rule", "verdict")


OP6_SQL = r"""
WITH rest AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1, 's') AS path FROM rest
), rules(verdict, host, path) AS (
  VALUES ('block', 'com', '/en/'), ('allow', 'example.com', '/en/7'), ('allow', 'net', '/de/'), ('block', 'example.net', '/de/8'), ('block', 'org', '/es/')
), hits AS (
  SELECT p.page_id, r.host || r.path AS rule, r.verdict,
         row_number() OVER (PARTITION BY p.page_id ORDER BY length(r.host) DESC, length(r.path) DESC) AS k
  FROM parts p JOIN rules r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
)
SELECT p.page_id, p.host, p.path, h.rule, coalesce(h.verdict, 'allow') AS verdict
FROM parts p LEFT JOIN (SELECT * FROM hits WHERE k = 1) h ON p.page_id = h.page_id
"""


def op7_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars", "text"))


OP7_SQL = r"""
WITH RECURSIVE sizes AS (
  SELECT source, count(*) AS size FROM documents GROUP BY source
), rates AS (
  SELECT source, 1.0::DOUBLE / (SELECT count(*)::DOUBLE FROM sizes) * (SELECT count(*)::DOUBLE FROM documents) / size AS rate FROM sizes
), terms AS (
  SELECT doc_id, d.source, lang, n_chars, text, greatest(ceil(rate / 16.0), 1)::INT AS parts, rate / greatest(ceil(rate / 16.0), 1)::INT AS part
  FROM documents d JOIN rates r ON d.source IS NOT DISTINCT FROM r.source
), draws AS (
  SELECT doc_id, source, lang, n_chars, text, part, i,
         ('0x' || substr(md5('mix-1:' || coalesce(doc_id::VARCHAR, '') || ':' || i), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0 AS u
  FROM (SELECT *, unnest(range(1, parts + 1)) AS i FROM terms)
), steps AS (
  SELECT DISTINCT part, 0 AS k, exp(-part) AS p, exp(-part) AS c FROM draws
  UNION ALL
  SELECT part, k + 1, p * part / (k + 1)::DOUBLE, c + p * part / (k + 1)::DOUBLE FROM steps WHERE k < 72
), counts AS (
  SELECT d.doc_id, d.source, d.lang, d.n_chars, d.text, d.i, count(*) FILTER (WHERE s.k < 72 AND s.c <= d.u) AS n
  FROM draws d JOIN steps s ON d.part = s.part GROUP BY ALL
), copies AS (
  SELECT doc_id, source, lang, n_chars, text, sum(n)::INT AS copies FROM counts GROUP BY ALL
), each AS (
  SELECT *, unnest(range(0, copies))::INT AS copy FROM copies WHERE copies > 0
)
SELECT doc_id, source, lang, n_chars, text, copy, copies, md5('mix-1:' || coalesce(doc_id::VARCHAR, '') || '#' || copy) AS mix_key FROM each
"""


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_documents(spark, sf_dir), public_tokenizers.path(TOKENIZER))


def op9_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, 10)


OP9_SQL = r"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), q AS (SELECT * FROM v WHERE vec_id % 100 = 0),
s AS (
  SELECT q.vec_id AS query_id, v.vec_id, list_sum(list_transform(list_zip(q.e, v.e), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM q JOIN v ON q.vec_id <> v.vec_id AND len(q.e) = len(v.e)
), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INT AS rank, vec_id, score FROM r WHERE rank <= 10
"""


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    model = quality.train(docs, _learnable(spark, sf_dir, 5, 0))
    found = quality.score(docs, model)
    return found.select("doc_id", toxicity.held_out(F.col("doc_id"), 5, 0).alias("held_out"), "score", (F.col("score") >= GOOD).cast("int").alias("predicted"))


def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = token_files.write(_documents(spark, sf_dir), public_tokenizers.path(WORDS))
    return token_files.read(spark, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    arrow_batches(spark)
    repaired = conversations.repair(conversations.damaged(rows))
    every = rows.select("conv_id").distinct()
    sums = repaired.conversations.withColumnRenamed("conv_id", "__c")
    digests = conversations.digests(repaired.turns).withColumnRenamed("conv_id", "__d")
    found = every.join(sums, F.col("conv_id").eqNullSafe(F.col("__c")), "left").join(digests, F.col("conv_id").eqNullSafe(F.col("__d")), "left")
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    digest = F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256))
    return found.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), digest.alias("repaired_sha256"))


def _ways() -> str:
    """One more row of the search, in SQL: each state is a struct of cost, edits and the rows so far."""
    said = "chr(10) || r.role || ':' || r.text"
    way = lambda s, cost, letter, more="''", if_="true": f"CASE WHEN d.s{s} IS NOT NULL AND {if_} THEN {{'c': d.s{s}.c + {cost}, 'a': d.s{s}.a || '{letter}', 'o': d.s{s}.o || {more}}} END"
    least = lambda *x: f"list_min([{', '.join(x)}])"
    gone = lambda s: way(s, 2, "D")
    stays = lambda s, initial: way(s, "r.more", "K", said, f"r.may_stay AND r.initial = '{initial}'")
    becomes = lambda s, role: way(s, "1 + r.more", "R", f"chr(10) || '{role}:' || r.text", "r.may_stay")
    n = [
        least(gone(0)),
        least(gone(1), stays(0, "s")),
        least(gone(2), *(f(s, x) for s in (0, 1, 3) for f, x in ((stays, "u"), (becomes, "user")))),
        least(gone(3), stays(2, "a"), becomes(2, "assistant")),
    ]
    return ", ".join(f"{x} AS n{i}" for i, x in enumerate(n))


def _inserted(x: str, role: str) -> str:
    return f"CASE WHEN {x} IS NOT NULL THEN {{'c': {x}.c + 5, 'a': {x}.a || 'I', 'o': {x}.o || chr(10) || '{role}:'}} END"


OP12_SQL = rf"""
WITH RECURSIVE hashed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(list_reduce(list_prepend(4294967295, list_transform(range(1, length(key) + 1), lambda i: ascii(substr(key, i, 1))::BIGINT)),
      lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) % 20 AS kind
  FROM (SELECT *, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations)
), damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(CASE WHEN kind = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM hashed WHERE kind <> 0
), placed AS (
  SELECT *, row_number() OVER w AS k, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth,
    lag(substr(role, 1, 1)) OVER w || substr(role, 1, 1) AS pair, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body
  FROM damaged WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy)
), judged AS (
  SELECT *, CASE WHEN body = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate' WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault FROM placed
), r AS (
  SELECT conv_id, k, role, text, substr(role, 1, 1) AS initial, fault NOT IN ('blank', 'duplicate') AS may_stay, CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END AS more FROM judged
), d AS (
  SELECT DISTINCT conv_id, 0::BIGINT AS k, {{'c': 0, 'a': '', 'o': ''}} AS s0, NULL::STRUCT(c INTEGER, a VARCHAR, o VARCHAR) AS s1,
    {{'c': 5, 'a': 'I', 'o': chr(10) || 'user:'}} AS s2, {{'c': 10, 'a': 'II', 'o': chr(10) || 'user:' || chr(10) || 'assistant:'}} AS s3
  FROM r
  UNION ALL
  SELECT conv_id, k, n0, n1, c2, list_min([n3, {_inserted('c2', 'assistant')}]) FROM (
    SELECT *, list_min([n2, {_inserted('n0', 'user')}, {_inserted('n1', 'user')}, {_inserted('n3', 'user')}]) AS c2 FROM (
      SELECT r.conv_id, r.k, {_ways()}
      FROM d JOIN r ON d.conv_id IS NOT DISTINCT FROM r.conv_id AND r.k = d.k + 1
    )
  )
), sums AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, count(*) FILTER (WHERE fault = 'blank') AS blank,
    count(*) FILTER (WHERE fault = 'duplicate') AS duplicate, count(*) FILTER (WHERE fault = 'truncated') AS truncated,
    count(*) FILTER (WHERE k > 1 AND pair NOT IN ('su', 'ua', 'au')) AS illegal, max(k) AS k FROM judged GROUP BY conv_id
), best AS (
  SELECT s.*, list_min([d.s0, d.s3]) AS way FROM sums s JOIN d ON s.conv_id IS NOT DISTINCT FROM d.conv_id AND s.k = d.k
)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
  coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(way.c, 0)::BIGINT AS cost, coalesce(way.a, '') AS audit,
  sha256(coalesce(substr(way.o, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN best b ON c.conv_id IS NOT DISTINCT FROM b.conv_id
"""


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fill_middle.transformed(_documents(spark, sf_dir).select("doc_id", "text"))
    back = fill_middle.restored(F.col("output"), F.col("form"))
    return found.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(back, 256).alias("restored_sha256"))


OP13_SQL = """
WITH h AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents
), u AS (
  SELECT doc_id, text, regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]') AS u,
    ('0x' || substr(h, 1, 8))::BIGINT AS h1, ('0x' || substr(h, 9, 8))::BIGINT AS h2, ('0x' || substr(h, 17, 8))::BIGINT AS h3, ('0x' || substr(h, 25, 8))::BIGINT AS h4 FROM h
), c AS (
  SELECT *, len(u) AS n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS i, greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS j,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM u
), p AS (
  SELECT *, array_to_string(u[1:i], '') AS prefix, array_to_string(u[i + 1:j], '') AS middle, array_to_string(u[j + 1:], '') AS suffix FROM c
)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(prefix) END::BIGINT AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END::BIGINT AS middle_chars,
  sha256(CASE form WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle ELSE text END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM p
"""


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = [op1_toxicity, op2_line_dedup, op3_media_columns, op4_near_dedup, op5_token_counts, op6_url_filter, op7_source_mix, op8_packing, op9_exact_topk, op10_quality, op11_token_files, op12_conversation_repair, op13_fill_in_middle, pipeline]
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    return {"op2_line_dedup": OP2_SQL, "op6_url_filter": OP6_SQL, "op7_source_mix": OP7_SQL, "op9_exact_topk": OP9_SQL, "op12_conversation_repair": OP12_SQL, "op13_fill_in_middle": OP13_SQL}
