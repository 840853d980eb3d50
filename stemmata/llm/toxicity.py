"""Toxic passages by maximum-scoring segment search.

Training. In each labelled text a word counts once, with the words before and after its first occurrence;
equal ones count once a class, so that copies of a text, whole or nearly so, add no evidence. A word's
weight is the log-odds of its toxic contexts under a Dirichlet prior whose mean is the share of toxic
contexts of all words. Words that are too rare to tell share the evidence of a beginning: beginnings of 8 letters
down to 2 are counted over the words that have no longer chosen one, each without the word that shows
most, and chosen only as toxic; last come the words that differ from their chosen beginning, or from the prior. What differs is told by
Benjamini and Hochberg's rule over all candidates of a step (false discoveries are ``FALSE`` of the chosen,
whatever the number of labels), with Chernoff's bound as the test.

Scoring: one linear scan per text (Ruzzo-Tompa) finds all maximal segments. Weights are log-likelihood
ratios, so the scale lambda of the extreme-value law is 1 by construction: a segment of score S in a text
of n words is expected K * n * exp(-S) times by chance; K is fitted on labelled clean texts that gave no
weights. Segments expected less than ``SIGNIFICANT`` times are passages. The sum of the best r normalised
scores has a known tail; the least tail over r, a logistic curve fitted on the same texts, and nothing else
give the document's score.

Results by case: null, empty and wordless texts have no passage and get the score of a text without
evidence; without labelled texts of both classes every score is 0; null labels and null doc_ids teach
nothing; repeated rows and copies give weights once and are scored alike; long texts are read to the end; an empty
table gives no row; extra columns stay, and columns named like a result column are replaced.
"""

from __future__ import annotations

import functools
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import written

#: Labelled rows that train the weights and the calibration, at most (in the mean): the labelled set is
#: thinned by a hash of doc_id when it is larger. All other steps cover all rows.
TRAIN_ROWS = 60_000
#: Lengths of the beginnings that words share, longest first: no length is preferred, all compete by the same rule of false discoveries.
BEGINNINGS = (8, 7, 6, 5, 4, 3, 2)
#: Pseudo-contexts of the Dirichlet prior of a word or beginning.
PRIOR = 2.0
#: Share of false ones among the words and beginnings that get a weight ...
FALSE = 0.05
#: ... and contexts that a candidate needs at least.
LEAST = 3
#: Expected chance segments a passage may have.
SIGNIFICANT = 0.05
#: What a token without a weight adds: clean text must score below 0 in the mean.
DRIFT = -0.02
#: Words whose weights a task keeps at hand; more start the list anew.
AT_HAND = 1 << 20
RESULT = ("score", "n_passages", "passages")
_WORD = re.compile(r"[^\W_]+")


@dataclass(frozen=True)
class Model:
    weights: dict[str, float]  #: of words, and of beginnings (with a star)
    k: float  #: of the extreme-value law
    slope: float
    middle: float

    def score(self, evidence: float) -> float:
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, self.slope * (math.log1p(evidence) - self.middle)))))


def tokens(text: str) -> list[str]:
    return _WORD.findall(text.lower())


class Lookup(dict):
    """The weight of every word that is asked for: its own, else that of its longest weighted beginning, else none."""

    def __init__(self, weights: dict[str, float]):
        super().__init__()
        self.weights = weights

    def __missing__(self, word: str) -> float | None:
        found = self.weights.get(word)
        for k in BEGINNINGS:
            if found is None and k < len(word):
                found = self.weights.get(word[:k] + "*")
        if len(self) >= AT_HAND:
            self.clear()
        self[word] = found
        return found


def segments(weights: dict[str, float], words: list[str]) -> list[tuple[float, int, int]]:
    """All maximal scoring segments (score, first word, end) of a word list, in linear time.

    A word that only repeats the one before it counts like one without a weight. Runs between weighted words add up to one gap, so the list of candidates only grows with weighted words.
    """
    found: list[tuple[float, float, int, int, int]] = []  # sum before, sum at the end, first, end, last one with a smaller sum before
    total, last = 0.0, 0
    weight = weights.__getitem__ if isinstance(weights, Lookup) else weights.get
    for i, w in enumerate(map(weight, words)):
        if w is None or (i and words[i] == words[i - 1]):
            continue
        total += DRIFT * (i - last)
        last = i + 1
        before, total = total, total + w
        if w <= 0:
            continue
        first = i
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][0] >= before:
                j = found[j][4]
            if j < 0 or found[j][1] >= total:
                break
            before, first = found[j][0], found[j][2]
            del found[j:]
        found.append((before, total, first, i + 1, j))
    return [(hi - lo, a, b) for lo, hi, a, b, _ in found]


def evidence(k: float, n: int, scores: list[float]) -> float:
    """-ln of the least tail of the best r normalised scores, for each r at which the tail of a sum holds."""
    best, total = 0.0, 0.0
    base = math.log(max(k * n, 1e-9))
    for r, s in enumerate(sorted(scores, reverse=True), 1):
        total += s - base
        if total <= r * (r - 1):
            break
        if r > 1:
            tail = -total + (r - 1) * math.log(total) - math.lgamma(r + 1) - math.lgamma(r)
        else:
            tail = math.log(-math.expm1(-math.exp(-total))) if total < 30 else -total
        best = max(best, -tail - (r - 1) * math.log(2))
    return best


def train(docs: DataFrame, labels: DataFrame, *, text: str = "text", label: str = "toxic", doc_id: str = "doc_id") -> Model:
    """Fit on the texts with a label 0 or 1 (the larger of several). Every third, by a hash, calibrates; the others give weights."""
    known = labels.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{label}`").cast("int").alias("y")).where("id is not null and y in (0, 1)").groupBy("id").agg(F.max("y").alias("y"))
    share = min(1.0, TRAIN_ROWS / max(1, known.count()))
    if share < 1:
        known = known.where(F.pmod(F.xxhash64("id", F.lit("rows")), F.lit(1 << 20)) < int(share * (1 << 20)))
    texts = docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").alias("text")).where("text is not null")
    rows = texts.join(F.broadcast(known), "id").select("text", "y", F.pmod(F.xxhash64("id", F.lit("fold")), F.lit(3)).alias("fold"))  # known has TRAIN_ROWS rows
    weights = _weights(rows.where("fold <> 0"))
    if not weights:
        return Model({}, 1.0, 1.0, 1e6)
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    scanned = written(rows.where("fold = 0").mapInArrow(lambda it: _scanned(it, shared), "y int, n long, s array<double>"), "toxic-fold")
    k = _fit_k([(r.n, r.s) for r in scanned.where("y = 0").select("n", F.array_max("s").alias("s")).collect()])  # TRAIN_ROWS rows
    found = scanned.mapInArrow(lambda it: _evidence(it, k), "y int, x double").collect()  # TRAIN_ROWS rows
    slope, middle = _logistic(np.array([r.x for r in found], float), np.array([r.y for r in found], float))
    return Model(weights, k, slope, middle)


def _weights(rows: DataFrame) -> dict[str, float]:
    """Weights of words and beginnings from labelled texts (text, y)."""
    spark = rows.sparkSession
    # a row for each word of a text; bit i of firsts: no word before it in the text has the i-th of the beginnings
    seen = rows.select("text", "y").mapInArrow(_words, "word string, context long, firsts int, y int").repartition("word").groupBy("word", "context", "y").agg(F.expr("bit_or(firsts)").alias("firsts"))
    kinds = {"": F.lit(1), **{str(k): F.col("firsts").bitwiseAND(1 << i).cast("boolean").cast("int") for i, k in enumerate(BEGINNINGS)}}
    counts = [F.sum(n * (F.col("y") if bad else 1)).alias(f"{'bad' if bad else 'all'}{k}") for k, n in kinds.items() for bad in (False, True)]
    table = written(seen.groupBy("word").agg(*counts), "toxic-words")
    total, bad = table.agg(F.sum("all"), F.sum("bad")).first()
    if not bad or bad == total:
        return {}
    base = bad / total
    odds: dict[str, float] = {}

    def weigh(chosen: list) -> None:
        for r in chosen:
            p = (r.bad + PRIOR * r.p) / (r.n + PRIOR)
            odds[r.node] = math.log(p / (1 - p)) - math.log(base / (1 - base))

    p0 = F.lit(base)
    left, words = table, []
    for k in BEGINNINGS:
        longer, start = F.length("word") > k, F.substring("word", 1, k)
        most = F.max(F.struct(f"bad{k}", f"all{k}"))  # what a single word shows is its own
        nodes = left.where(longer).groupBy(start.alias("start")).agg((F.sum(f"bad{k}") - most[f"bad{k}"]).alias("bad"), (F.sum(f"all{k}") - most[f"all{k}"]).alias("n"))
        chosen = _unlike(nodes.select(F.concat("start", F.lit("*")).alias("node"), "bad", "n", p0.alias("p")).where("bad > n * p"))
        weigh(chosen)
        here = F.broadcast(spark.createDataFrame([(r.node[:-1], (r.bad + PRIOR * base) / (r.n + PRIOR)) for r in chosen], "known string, p double"))  # as many as were chosen
        words.append(left.where(longer).join(here, start == F.col("known")).select("word", "bad", "all", "p"))
        left = left.join(here, longer & (start == F.col("known")), "left_anti")
    words.append(left.select("word", "bad", "all", p0.alias("p")))
    weigh(_unlike(functools.reduce(DataFrame.unionAll, words).select(F.col("word").alias("node"), "bad", F.col("all").alias("n"), "p")))
    return odds


def _unlike(nodes: DataFrame) -> list:
    """The nodes (node, bad, n, p) whose share of bad ones differs from p, by Benjamini and Hochberg's rule.

    g is -ln of a bound of the tail: Chernoff's, n times the divergence of the share from p; above p, the
    term's by Stirling's formula times the geometric series that bounds the terms beyond it.
    Nodes too small to be chosen whatever their share (Tarone) are no candidates.
    """
    n, bad, good, p = F.col("n"), F.col("bad"), F.col("n") - F.col("bad"), F.col("p")
    part = lambda c, q: F.when(c > 0, c * F.log(c / (n * q))).otherwise(0.0)
    closer = F.when((good > 0) & (bad > n * p), F.greatest(F.log(2 * math.pi * bad * good / n) / 2 + F.log1p(-good / (bad + 1) * p / (1 - p)), F.lit(0.0))).otherwise(0.0)
    tested = nodes.where(n >= LEAST).withColumn("g", part(bad, p) + part(good, 1 - p) + closer).withColumn("most", -n * F.log(p))
    steps, at = 1024, lambda c: F.least(F.floor(F.col(c) * 16), F.lit(1024)).alias(c)
    counts = {"g": np.zeros(steps + 1, np.int64), "most": np.zeros(steps + 1, np.int64)}
    for r in tested.groupBy(at("g"), at("most")).count().collect():  # 1025 * 1025 rows at most
        for c in counts:
            counts[c][r[c]] += r["count"]
    beyond = {c: np.cumsum(n[::-1])[::-1] for c, n in counts.items()}  # nodes at each step or beyond
    possible = [i / 16 for i in range(1, steps + 1) if beyond["g"][i] and i / 16 >= math.log(max(beyond["most"][i], beyond["g"][i]) / (FALSE * beyond["g"][i]))]
    chosen = min(possible, default=None)
    return [] if chosen is None else tested.where(F.col("g") >= chosen).collect()


def _fit_k(clean: list[tuple[int, float | None]]) -> float:
    """The maximum s of n tokens is below s with probability exp(-K n exp(-s)): its likelihood's maximum."""
    mass = sum(n * math.exp(-(s or 0.0)) for n, s in clean)
    return max(1e-4, min(1.0, sum(s is not None for _, s in clean) / max(mass, 1e-9)))


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and middle of a one-dimensional logistic curve, by Newton's method with a weak prior."""
    if not len(x) or y.min() == y.max():
        return 1.0, 4.0
    spread = float(x.std()) or 1.0
    z, a, b = x / spread, 1.0, float(-x.mean() / spread)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * z + b, -30, 30)))
        w = p * (1 - p) + 1e-9
        g = np.array([np.dot(y - p, z) - 0.1 * a, np.sum(y - p) - 0.1 * b])
        h = np.array([[np.dot(w, z * z) + 0.1, np.dot(w, z)], [np.dot(w, z), w.sum() + 0.1]])
        step = np.linalg.solve(h, g)
        a, b = a + float(step[0]), b + float(step[1])
        if np.abs(step).max() < 1e-9:
            break
    a = max(a, 1e-3)
    return a / spread, -b / a * spread


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for at in range(0, b.num_rows, 64):
            words, contexts, firsts, labels = [], [], [], []
            for t, y in zip(b.column(0).slice(at, 64).to_pylist(), b.column(1).slice(at, 64).to_pylist(), strict=True):
                text, seen = tokens(t), set()
                for i, w in enumerate(text):
                    if w in seen:
                        continue
                    seen.add(w)
                    new = 0
                    for bit, k in enumerate(BEGINNINGS):
                        if k < len(w) and (start := w[:k] + "*") not in seen:
                            seen.add(start)
                            new |= 1 << bit
                    words.append(w)
                    contexts.append(xxhash.xxh3_64_intdigest(" ".join(text[max(i - 1, 0) : i + 2])) >> 1)
                    firsts.append(new)
                labels.extend([y] * (len(words) - len(labels)))
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(contexts, pa.int64()), pa.array(firsts, pa.int32()), pa.array(labels, pa.int32())], names=["word", "context", "firsts", "y"])


def _scanned(batches: Iterator[pa.RecordBatch], shared: Broadcast) -> Iterator[pa.RecordBatch]:
    weights = Lookup(shared.value)
    for b in batches:
        n, s = [], []
        for t in b.column(0).to_pylist():
            words = tokens(t)
            n.append(len(words))
            s.append([x[0] for x in segments(weights, words)])
        yield pa.RecordBatch.from_arrays([b.column(1).cast(pa.int32()), pa.array(n, pa.int64()), pa.array(s, pa.list_(pa.float64()))], names=["y", "n", "s"])


def _evidence(batches: Iterator[pa.RecordBatch], k: float) -> Iterator[pa.RecordBatch]:
    for b in batches:
        x = [math.log1p(evidence(k, n, s)) for n, s in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(x, pa.float64())], names=["y", "x"])


def score(docs: DataFrame, model: Model, *, text: str = "text", passages: bool = True) -> DataFrame:
    """Add score, n_passages and, if asked for, passages (word_from, word_to, score, text) to every row."""
    names = [c for c in docs.columns if c not in RESULT]
    used = [*names, text] if text not in names else names
    at = used.index(text)
    kind = pa.list_(pa.struct([("word_from", pa.int64()), ("word_to", pa.int64()), ("score", pa.float64()), ("text", pa.string())]))

    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        weights = Lookup(model.weights)
        for b in batches:
            out: list[tuple] = []
            for t in b.column(at).to_pylist():
                words = tokens(t or "")
                found = segments(weights, words)
                limit = math.log(max(model.k * len(words), 1e-9) / SIGNIFICANT)
                real = [x for x in found if x[0] > limit]
                spans = [{"word_from": i, "word_to": j, "score": s, "text": " ".join(words[i:j])} for s, i, j in real] if passages else None
                out.append((model.score(evidence(model.k, len(words), [x[0] for x in found])), len(real), spans))
            cols = list(zip(*out, strict=True)) if out else [(), (), ()]
            new = [pa.array(cols[0], pa.float64()), pa.array(cols[1], pa.int64())] + ([pa.array(cols[2], kind)] if passages else [])
            yield pa.RecordBatch.from_arrays(b.columns[: len(names)] + new, names=[*names, *RESULT[: 2 + passages]])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*[f"`{c}`" for c in names]).schema.fields]
    fields += ["score double", "n_passages long"] + ["passages array<struct<word_from: long, word_to: long, score: double, text: string>>"] * passages
    return docs.select(*[f"`{c}`" for c in used]).mapInArrow(run, ", ".join(fields))


def held_out(doc_id: Column, modulus: int, remainder: int) -> Column:
    """Whether crc32 of the id as text leaves this remainder: such rows teach nothing."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus == remainder, F.lit(False))
