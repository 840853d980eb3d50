"""From raw documents to packed training sequences: five stages, each written and read again.

All stages take null, empty and very long texts, repeated rows, empty tables and extra columns of any name; their
docstrings say what becomes of them. Columns that no stage reads are carried along, untouched.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stemmata.llm import line_dedup, mixing, near_dup, packing, toxicity
from stemmata.llm.storage import arrow_batches, table, written

TOXIC = 0.7
TOKENIZER = "byte_bpe_50k.json"
#: Columns that stages read; all others get other names while a stage's operator runs.
READ = ("doc_id", "text", "source")


def _apart(docs: DataFrame, operate: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """What ``operate`` leaves of ``docs``, with their columns; those that are only carried cannot clash with its results."""
    names = {c: c if c in READ else f"__carried{i}" for i, c in enumerate(docs.columns)}
    left = operate(docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()]))
    return left.select(*[F.col(n).alias(c) for c, n in names.items()])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, trained on all labels, rejects go.

    Null and empty texts have no evidence and stay, equal rows share their fate, and without labels of both
    classes all stay.
    """
    arrow_batches(spark)
    model = toxicity.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return _apart(docs, lambda d: toxicity.score(d, model, passages=False).where(f"score < {TOXIC}"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines held by a smaller doc_id go, and with them the documents that lose lines and have no other word; n_chars follows the text.

    Such a document's whole content stays elsewhere. Texts that were null or empty before stay as they are; rows without a
    doc_id keep all lines; rows of one doc_id are one document, so equal rows keep the same lines.
    """
    arrow_batches(spark)
    left = _apart(docs, lambda d: line_dedup.dedup(d).where(F.coalesce((F.col("n_dropped") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(True))))
    return left.select(*[F.length("text").alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in left.columns]).to(docs.schema)


def keep_first_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the smallest doc_id stays.

    Documents are near copies by their texts of now or by those of the table of documents: line dedup takes from
    a near copy just what it shares with its original, so that the rest no longer shows it. The smallest doc_id of a group
    owned the shared lines and has them still. Empty texts are linked with nothing and stay; rows without a
    doc_id stay; equal rows stay once.
    """
    arrow_batches(spark)
    return near_dup.first_of_each(docs, before=table(spark, sf_dir, "documents"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All sources get equal weight; documents repeat by Poisson counts and are shuffled.

    A null source is a source of its own; a null doc_id draws like an empty one; equal rows get equal counts.
    """
    return _apart(docs, mixing.mix)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their places in sequences of 1024 tokens.

    ``row_id`` tells the copies of a document apart that the mixture holds. Null and empty texts are one
    end token; rows without a doc_id are packed like others.
    """
    arrow_batches(spark)
    rows = docs.select("doc_id", "text", F.monotonically_increasing_id().alias("row_id"))
    return packing.pack(rows, public_tokenizers.path(TOKENIZER), row="row_id")


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("MinHash near-dedup", keep_first_of_near_copies),
    ("mixing sources", mix_sources),
    ("best-fit packing", pack_sequences),
]

#: Stages 1, 3 and 5 (a trained model, sketches, a linear program) have no SQL; tests compare run() with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, name.replace(" ", "-"))
    return docs
