"""Mixing sources to target weights by Poisson replication, in DataFrame operations only.

A source's repetition rate is weight * total / size, so that the expected size of the mixture is the
corpus' own and the expected share of each source is its weight. A document's number of copies is the
inverse of the Poisson distribution with that rate at a number in [0, 1) that only the seed and the
doc_id decide. Copies are dealt by a hash and sorted by it within partitions: a global random order
that can be made again.

The distribution function is made once for each source. The rates are one row per source: broadcast if there are ``BROADCAST`` at most, otherwise joined with
the large sources' rows spread by salt.

Results by case: a null source is a source of its own; a source without a weight (or weight 0) gives no
copy if weights are given, and weights that are missing altogether are equal; a null doc_id is hashed
as an empty text; equal rows get equal counts; an empty table gives an empty mixture; null texts have
size 0 under ``measure="chars"``; columns named like a result column are replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import partitions

#: Sources whose rates may be broadcast.
BROADCAST = 100_000
SALTS = 64
SEED = "mix-1"
RESULT = ("copy", "copies", "mix_key")
#: Hexadecimal digits of a digest that make a number below 1: 52 bits, exact in a double.
_DIGITS = 13
#: A rate above this is drawn as a sum of independent rates of at most this, so that exp(-rate) is not 0.
_TERM = 16.0
#: Terms of the distribution function at rate 16: the rest is below 2**-52.
_LENGTH = 72


def _unit(digest: F.Column) -> F.Column:
    return F.conv(F.substring(digest, 1, _DIGITS), 16, 10).cast("long").cast("double") / float(16**_DIGITS)


def _distribution(part: F.Column) -> F.Column:
    """The Poisson distribution function with this rate at 0 .. _LENGTH - 1, as an array."""
    start = F.struct(F.array(F.exp(-part)).alias("c"), F.exp(-part).alias("p"))

    def step(s: F.Column, k: F.Column) -> F.Column:
        p = s["p"] * part / k.cast("double")
        return F.struct(F.concat(s["c"], F.array(F.element_at(s["c"], -1) + p)).alias("c"), p.alias("p"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(_LENGTH - 1)), start, step, lambda s: s["c"])


def _draws(parts: F.Column, distribution: F.Column, key: F.Column) -> F.Column:
    """Sum of as many inverses of the distribution function as the rate has parts, each at a number of ``key``."""
    u = lambda i: _unit(F.md5(F.concat(key, F.lit(":"), i.cast("string"))))
    numbers = F.transform(F.sequence(F.lit(1), parts), u)
    return F.aggregate(numbers, F.lit(0), lambda n, x: n + F.size(F.filter(distribution, lambda c: c <= x)))


def rates(docs: DataFrame, weights: dict[str | None, float] | None, *, source: str = "source", text: str = "text", measure: str = "docs") -> DataFrame:
    """(__source, __parts, __distribution) for each source: its repetition rate in equal parts, and a part's distribution function. ``measure``: docs or chars, the unit of weights and sizes."""
    amount = F.count("*") if measure == "docs" else F.sum(F.coalesce(F.length(f"`{text}`"), F.lit(0)))
    sizes = docs.groupBy(F.col(f"`{source}`").alias("__source")).agg(amount.cast("long").alias("size"))
    if weights is None:
        sizes = sizes.withColumn("weight", F.lit(1.0))
    else:
        pairs = F.array(*[F.struct(F.lit(s).cast("string").alias("w_source"), F.lit(float(w)).alias("weight")) for s, w in weights.items()]).cast("array<struct<w_source: string, weight: double>>")
        given = docs.sparkSession.range(1).select(F.inline(pairs))
        sizes = sizes.join(F.broadcast(given), F.col("__source").cast("string").eqNullSafe(F.col("w_source")), "left").withColumn("weight", F.coalesce("weight", F.lit(0.0)))
    totals = sizes.agg(F.sum("size").alias("total"), F.sum("weight").alias("weights"))
    rate = F.when((F.col("size") > 0) & (F.col("weights") > 0), F.col("weight") / F.col("weights") * F.col("total") / F.col("size")).otherwise(0.0)
    t = totals.first()
    return sizes.withColumn("total", F.lit(t.total or 0).cast("double")).withColumn("weights", F.lit(t.weights or 0.0).cast("double")).select("__source", rate.alias("__rate")).withColumn("__parts", F.greatest(F.ceil(F.col("__rate") / _TERM), F.lit(1)).cast("int")).select("__source", "__parts", _distribution(F.col("__rate") / F.col("__parts")).alias("__distribution"))


def mix(docs: DataFrame, weights: dict[str | None, float] | None = None, *, source: str = "source", doc_id: str = "doc_id", text: str = "text", measure: str = "docs", seed: str = SEED) -> DataFrame:
    """Each document as many times as it is drawn, shuffled globally; copy counts from 0, copies is their number."""
    names = [c for c in docs.columns if c not in RESULT]
    rate = rates(docs, weights, source=source, text=text, measure=measure)
    found = docs.select(*[f"`{c}`" for c in names], F.col(f"`{source}`").alias("__with"))
    if rate.limit(BROADCAST + 1).count() <= BROADCAST:
        drawn = found.join(F.broadcast(rate), F.col("__with").eqNullSafe(F.col("__source")))
    else:
        salted = rate.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        drawn = found.withColumn("__salted", F.pmod(F.xxhash64(f"`{doc_id}`"), F.lit(SALTS)).cast("int")).join(salted, F.col("__with").eqNullSafe(F.col("__source")) & (F.col("__salted") == F.col("__salt")))
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("")))
    drawn = drawn.withColumn("copies", _draws(F.col("__parts"), F.col("__distribution"), key)).where("copies > 0")
    copies = drawn.withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
    keyed = copies.withColumn("mix_key", F.md5(F.concat(key, F.lit("#"), F.col("copy").cast("string"))))
    out = [*[F.col(f"`{c}`") for c in names], "copy", "copies", "mix_key"]
    return keyed.select(*out).repartition(partitions(docs.sparkSession), "mix_key").sortWithinPartitions("mix_key")
