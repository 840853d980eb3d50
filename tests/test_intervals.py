"""Ranges, anchors, orders, drift and blocks, against plain Python."""

import random
from collections import Counter
from statistics import median

import pytest
from conftest import rows
from pyspark.sql import functions as F
from stemmata.operators import anchoring, diagnostics, intervals, parallels, shapes


def ranges(rng, n, top, longest):
    out = []
    for i in range(n):
        a = rng.randint(-top, top)
        out.append((i, rng.choice("xy"), a, a + rng.randint(-2, longest)))
    return out


@pytest.mark.parametrize("widest", [2, 16])
def test_containing(spark, monkeypatch, widest):
    """Nested, equal, empty and very long ranges; long ones are cut where bins are narrow."""
    monkeypatch.setattr(intervals, "WIDEST", widest)
    rng = random.Random(widest)
    inner = [*ranges(rng, 120, 300, 40), (900, "x", None, 3), (901, "y", 5, 5)]
    outer = [*ranges(rng, 80, 300, 200), (902, "x", -400, 400), (903, "x", 4, None), (904, "y", 5, 5)]
    a = spark.createDataFrame(inner, "i long, k string, f long, l long")
    b = spark.createDataFrame(outer, "j long, k string, g long, m long")
    found = intervals.containing(a, b, ["k"], inner_range=("f", "l"), outer_range=("g", "m"))
    ok = lambda *x: None not in x
    want = sorted((i, j) for i, k, f, m in inner for j, k2, g, h in outer if k == k2 and ok(f, m, g, h) and g <= f <= m <= h)
    assert rows(found.select("i", "j")) == sorted(want, key=repr)
    assert "NestedLoop" not in found._jdf.queryExecution().toString() and "Cartesian" not in found._jdf.queryExecution().toString()
    assert intervals.containing(a, b.limit(0), ["k"], inner_range=("f", "l"), outer_range=("g", "m")).collect() == []


def test_overlapping(spark):
    rng = random.Random(4)
    left, right = ranges(rng, 90, 100, 30), ranges(rng, 90, 100, 10)
    a = spark.createDataFrame(left, "i long, k string, f long, l long")
    b = spark.createDataFrame(right, "j long, k string, g long, m long")
    found = intervals.overlapping(a, b, ["k"], left_range=("f", "l"), right_range=("g", "m"))
    assert rows(found.select("i", "j")) == sorted(((i, j) for i, k, f, x in left for j, k2, g, y in right if k == k2 and f <= x and g <= y and f <= y and g <= x), key=repr)


def test_islands(spark):
    df = spark.createDataFrame([("a", x) for x in (1, 2, 2, 3, 7, 9, 10, None)] + [("b", 5)], "k string, at int")
    assert rows(intervals.islands(df, ["k"], "at")) == [("a", 1, 3, 3), ("a", 7, 7, 1), ("a", 9, 10, 2), ("b", 5, 5, 1)]


# --- trees ----------------------------------------------------------------------------------


def forest(rng, n_versions=6):
    """Versions of random trees: divisions numbered as they open, units after, between or before inner divisions."""
    divs, units, words, slot = [], [], [], 0
    for v in range(n_versions):
        state = {"div": 0, "unit": 0}

        def grow(level, parent, v=v, state=state):
            nonlocal slot
            me = state["div"]
            state["div"] += 1
            divs.append([f"v{v}", me, parent, level, False])
            for _ in range(rng.randint(0, 3)):
                if rng.random() < 0.45 and level < 5:
                    grow(level + 1, me)
                elif rng.random() < 0.6:
                    divs[[d[:2] for d in divs].index([f"v{v}", me])][4] = True
                    units.append((f"v{v}", state["unit"], me))
                    for p in range(rng.randint(1, 2)):
                        slot += 1
                        words.append((f"v{v}", state["unit"], p, slot))
                    state["unit"] += 1

        for _ in range(3):
            grow(1, None)
    return divs, units, words


@pytest.mark.parametrize("seed", range(3))
def test_subtrees_anchors_and_shapes(spark, seed):
    divs, units, words = forest(random.Random(seed))
    d = spark.createDataFrame(divs, "version_id string, div int, parent int, level int, has_units boolean")
    u = spark.createDataFrame(units, "version_id string, unit int, div int")
    w = spark.createDataFrame(words, "version_id string, unit int, position int, slot long")
    parent = {(v, x): p for v, x, p, *_ in divs}

    def above(v, x):
        while x is not None:
            yield x
            x = parent[v, x]

    inside = {(v, x): [y for v2, y, *_ in divs if v2 == v and x in above(v, y)] for v, x, *_ in divs}
    assert rows(intervals.subtrees(d, ["version_id"]).select("version_id", "div", "last_div")) == sorted(((v, x, max(inside[v, x])) for v, x, *_ in divs), key=repr)
    own = {}
    for v, unit, x in units:
        for v2, u2, _, s in words:
            if (v2, u2) == (v, unit):
                own[v, x] = min(own.get((v, x), s), s)
    held = {k: min((own[k[0], y] for y in ys if (k[0], y) in own), default=None) for k, ys in inside.items()}
    want = []
    for v, x, *_ in divs:
        first = min((s for (v2, _), s in own.items() if v2 == v), default=None)
        near = next((y for y in above(v, x) if held[v, y] is not None), None)
        if first is not None:
            want.append((v, x, first if near is None else held[v, near], near))
    assert rows(anchoring.div_anchors(d, anchoring.first_slots(u, w))) == sorted(want, key=repr)
    levels = {(v, x): sum({1 << (lv - 1) for v2, y, _, lv, has in divs if v2 == v and has and y in inside[v, x]}) for v, x, *_ in divs}
    assert rows(shapes.subtree_levels(d).select("version_id", "div", "below")) == sorted(((*k, b) for k, b in levels.items()), key=repr)


def test_shapes_are_told_apart(spark):
    trees = {
        "flat": [(0, None, 1, True), (1, None, 1, True)],
        "deep": [(0, None, 1, False), (1, 0, 2, True), (2, None, 1, False), (3, 2, 2, True)],
        "mixed": [(0, None, 1, True), (1, None, 1, False), (2, 1, 2, True), (3, 1, 2, False)],
        "nested": [(0, None, 1, True), (1, 0, 2, True)],
        "bare": [(0, None, 1, False), (1, 0, 2, False)],
    }
    divs = spark.createDataFrame([(v, *x) for v, xs in trees.items() for x in xs], "version_id string, div int, parent int, level int, has_units boolean")
    named = spark.createDataFrame([(v,) for v in [*trees, "lost"]], "version_id string")
    none = spark.createDataFrame([], "version_id string")
    units = divs.where("has_units").select("version_id")
    tables = {"divs": divs, "versions": named, "units": units, "ellipses": named.where("version_id = 'flat'"), "orphan_readings": none}
    assert rows(shapes.version_shapes(tables)) == [
        ("bare", "no units", 0, 2, 1, False, False), ("deep", "one level", 2, 4, 0, True, False), ("flat", "one level", 1, 2, 0, True, True),
        ("lost", "no divisions", 0, 0, 0, False, False), ("mixed", "mixed", 3, 4, 1, True, False), ("nested", "nested", 3, 2, 0, True, False),
    ]


# --- orders and drift -----------------------------------------------------------------------


def test_order_violations(spark):
    source = [("v", x, i) for i, x in enumerate("abcdefgg")] + [("w", x, i) for i, x in enumerate("abcd")]
    other = [("v", x, i) for i, x in enumerate("acbxefg")] + [("w", x, i) for i, x in enumerate("acd")]
    df = lambda r: spark.createDataFrame(r, "v string, x string, at int")
    found = parallels.order_violations(df(source), df(other), ["v"], ["x"], ["at"])
    assert rows(found) == sorted([
        ("v", "d", "missing", 4, None), ("v", "x", "extra", None, 4), ("v", "g", "repeated", 7, 7), ("v", "c", "swapped", 3, 2), ("v", "b", "shifted", 2, 3),
        ("w", "b", "missing", 2, None), ("w", "c", "shifted", 3, 2), ("w", "d", "shifted", 4, 3),
    ], key=repr)
    assert parallels.order_violations(df(source[8:]), df(source[8:]), ["v"], ["x"], ["at"]).collect() == []
    assert {r.kind for r in parallels.order_violations(df(source[8:]), df(other[7:]), ["v"], ["x"], ["at"], shifts=False).collect()} == {"missing"}


def test_drift_and_totals(spark):
    rng = random.Random(7)
    a = [(f"v{rng.randint(0, 9)}", rng.choice("abc"), i) for i in range(60)]
    b = [(f"v{rng.randint(0, 11)}", rng.choice("abc"), i) for i in range(60)]
    df = lambda r: spark.createDataFrame(r, "v string, x string, at int")
    found = diagnostics.translation_drift(df(a), df(b), ["v"], ["x"], ["at"]).persist()
    for r in found.collect():
        x, y = ([w for v, w, _ in side if v == r.v] for side in (a, b))
        p, q = Counter(x), Counter(y)
        first = next((i for i in range(max(len(x), len(y))) if x[i : i + 1] != y[i : i + 1]), None)
        assert (r.generated_units, r.source_units, r.common, r.missing, r.extra) == (len(x), len(y), (p & q).total(), (q - p).total(), (p - q).total())
        assert (r.multiset_equal, r.sequence_equal, r.first_mismatch) == (p == q, x == y, first)
    parts = found.withColumn("region", F.when(F.col("v") < "v3", F.lit(None)).otherwise("r"))
    sums = diagnostics.totals(parts, ["region", "v"], {"n": F.sum("common")}).collect()
    whole = {r.grouping: 0 for r in sums}
    for r in sums:
        whole[r.grouping] += r.n
    assert set(whole) == {0, 1, 3} and len(set(whole.values())) == 1
    assert len([r for r in sums if r.region is None and r.grouping == 1]) == 1


def test_collisions_and_markers(spark):
    df = spark.createDataFrame([("v", "1", "a"), ("v", "1", "[...]"), ("v", "2", "x"), ("v", "3", " "), ("v", "3", None), ("w", "1", "a")], "v string, x string, t string")
    assert rows(diagnostics.id_collisions(df, ["v"], "x", "t")) == [("v", "1", 2, False, 0, 1), ("v", "3", 2, False, 2, 0)]
    said = spark.createDataFrame([("English", " [...] "), ("English", ""), ("French", " "), ("French", "[...]"), ("Latin", "")], "l string, t string")
    assert [r[0] for r in said.select(diagnostics.is_marker(F.col("l"), F.col("t"))).collect()] == [True, False, True, False, None]


def test_omission_states_and_runs(spark):
    source = spark.createDataFrame([("a", True), ("a", False), ("b", True), ("c", False)], "x string, e boolean")
    made = spark.createDataFrame([("a", False), ("a", True), ("b", False), ("d", True)], "x string, m boolean")
    assert rows(diagnostics.state_mismatches(source, made, ["x"], empty="e", marker="m")) == [("b", 1, 1, 1, 0, False), ("c", 1, 0, 0, 0, False), ("d", 0, 0, 1, 1, False)]
    at = lambda xs: spark.createDataFrame([("v", x) for x in xs], "v string, at int")
    found = diagnostics.omission_runs(at([1, 2, 3, 6, 9]), at([1, 2, 3, 7, 8, 9, 12]), ["v"], "at")
    assert rows(found) == sorted([("v", "exact", 1, 3, 1, 3, 3), ("v", "matched", 9, 9, 7, 9, 1), ("v", "unmarked", 6, 6, None, None, 0), ("v", "unfounded", None, None, 12, 12, 0)], key=repr)


def test_abba_blocks(spark):
    rng = random.Random(1)
    samples, want = [], []
    for s in range(12):
        session = [(s, i, rng.choice("AB") if s % 3 else "ABBA"[i % 4], float(rng.randint(1, 99))) for i in range(rng.randint(3, 22))]
        samples += session
        for k in range(0, len(session) - 3, 4):
            four = session[k : k + 4]
            if "".join(x[2] for x in four) == "ABBA":
                v = [x[3] for x in four]
                want.append((s, k // 4, (v[0] + v[3]) / 2, (v[1] + v[2]) / 2, (v[1] + v[2] - v[0] - v[3]) / 2))
    df = spark.createDataFrame(samples, "s int, i int, variant string, value double")
    blocks = diagnostics.abba_blocks(df, ["s"], ["i"])
    assert rows(blocks) == sorted(want, key=repr) and len(want) > 5
    one = diagnostics.matched_summary(blocks.withColumn("x", F.lit(1)), ["x"]).first()
    assert (one.n_blocks, one.median_difference) == (len(want), round(median(x[4] for x in want), 3))
    none = diagnostics.matched_summary(blocks.withColumn("b", F.lit(0.0)).withColumn("x", F.lit(1)), ["x"]).first()
    assert none.ratio is None
