"""Operators on whole corpora, against plain Python, and the pipeline."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from stemmata.llm import components, line_dedup, mixing, near_dup, packing, topk

from test_text_ops import documents, lines_by_hand, shingles

PATH = public_tokenizers.path("byte_bpe_50k.json")


# --- near duplicates ------------------------------------------------------------------------


def components_by_hand(rows, width, percent=80):
    sets = [(d, shingles(t, width)) for d, t in rows]
    head = list(range(len(sets)))

    def find(i):
        while head[i] != i:
            i = head[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            a, b = sets[i][1], sets[j][1]
            n = len(a & b)
            if n and 100 * n >= percent * (len(a) + len(b) - n):
                head[find(i)] = find(j)
    least = defaultdict(lambda: 10**18)
    for i, (d, _) in enumerate(sets):
        least[find(i)] = min(least[find(i)], d)
    return sorted((d, len(s), least[find(i)], least[find(i)] == d) for i, (d, s) in enumerate(sets))


def near_corpus(seed=2):
    rng = np.random.default_rng(seed)
    vocabulary = [f"v{i}" for i in range(4000)]
    rows = []
    for g in range(25):
        base = list(rng.choice(vocabulary, rng.integers(20, 120)))
        for _ in range(rng.integers(1, 9)):
            t = list(base)
            for _ in range(rng.integers(0, 4)):
                t[rng.integers(0, len(t))] = str(rng.choice(vocabulary))
            rows.append(" ".join(t))
    chain = list(rng.choice(vocabulary, 100))
    for _ in range(12):  # each near the next, the ends far apart
        chain = chain[2:] + list(rng.choice(vocabulary, 2))
        rows.append(" ".join(chain))
    rows += ["Same copy of one text that many have"] * 60 + ["same COPY of one\ttext that many have", "three words only", "THREE words only", "two words", ""]
    order = rng.permutation(len(rows))
    return [(int(1000 - i), rows[j]) for i, j in enumerate(order)]


@pytest.mark.parametrize("width", [4, 5])
def test_near_duplicates_are_the_components_by_hand(spark, width):
    rows = near_corpus()
    got = sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_dup.near_duplicates(documents(spark, rows), width=width).collect())
    assert got == components_by_hand(rows, width)


def test_large_buckets_are_searched_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "BLOCK", 3)
    monkeypatch.setattr(near_dup, "SETS", 2)
    monkeypatch.setattr(near_dup, "GROUP", 2)
    rows = near_corpus(4)
    got = sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_dup.near_duplicates(documents(spark, rows), width=4).collect())
    assert got == components_by_hand(rows, 4)


def test_near_duplicates_of_odd_rows(spark):
    odd = documents(spark, [(None, "a b c d e f"), (7, "a b c d e f"), (3, "a b c d e f"), (3, "a b c d e f"), (7, "other words here now then"), (9, None), (10, ""), (11, " \n")])
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in near_dup.near_duplicates(odd).collect()), key=repr)
    assert got == sorted([(None, None, True), (3, 3, True), (3, 3, True), (7, 3, False), (7, 7, True), (9, 9, True), (10, 10, True), (11, 11, True)], key=repr)
    kept = sorted(((r.doc_id, r.text) for r in near_dup.first_of_each(odd).collect()), key=repr)
    assert (3, "a b c d e f") in kept and len([k for k in kept if k[0] == 3]) == 1 and (None, "a b c d e f") in kept and (9, None) in kept
    assert near_dup.near_duplicates(documents(spark, [])).count() == 0


def test_likelihood_finds_the_similarity():
    rng = np.random.default_rng(0)
    for shared in (0, 400, 800, 1000):
        a = rng.integers(0, 2**64, 1000, dtype=np.uint64)
        b = np.concatenate([a[:shared], rng.integers(0, 2**64, 1000 - shared, dtype=np.uint64)])
        best, ok = near_dup.likely(near_dup.registers(np.sort(a))[None], near_dup.registers(np.sort(b))[None], np.array([1000]), np.array([1000]), 80)
        true = shared / (2000 - shared)
        assert abs(best[0] - true) < 0.2 and ok[0] == (true > 0.5)
    a, b = (rng.integers(0, 2**64, 300, dtype=np.uint64) for _ in range(2))
    assert (np.maximum(near_dup.registers(a), near_dup.registers(b)) == near_dup.registers(np.concatenate([a, b]))).all()


def test_components(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (101, 102), (102, 100), (50, 50), (None, 3)]
    got = dict(components.components(spark.createDataFrame(links, "u long, v long")).collect())
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 100}
    assert components.components(spark.createDataFrame([], "u long, v long")).count() == 0


# --- mixing ---------------------------------------------------------------------------------


def test_mixing_reaches_its_weights(spark):
    docs = spark.range(20000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), (F.col("id") % 7).cast("string"))).alias("source"), F.lit("x").alias("text"), F.lit(5).alias("copies"))
    weights = {"hot": 1.0, "s0": 2.0, "s1": 1.0}
    got = mixing.mix(docs, weights)
    n = {r.source: r["count"] for r in got.groupBy("source").count().collect()}
    total = sum(n.values())
    assert set(n) == set(weights) and abs(total - 20000) < 600
    assert all(abs(n[s] / total - w / 4) < 0.02 for s, w in weights.items())
    again = mixing.mix(docs.orderBy(F.desc("doc_id")), weights)
    key = ["doc_id", "copy", "copies", "mix_key"]
    assert got.select(key).exceptAll(again.select(key)).count() == 0
    counts = Counter(r.copies for r in got.where("source = 's1'").select("doc_id", "copies").distinct().collect())
    rate = 5000 / docs.where("source = 's1'").count()
    size = docs.where("source = 's1'").count()
    for k in (1, 2, 3):
        p = np.exp(-rate) * rate**k / np.prod(np.arange(1, k + 1))
        assert abs(counts[k] / size - p) < 0.05


def test_mixing_edge_rows(spark, monkeypatch):
    docs = spark.createDataFrame([(None, None, None), (1, None, "a"), (2, "s", "b"), (2, "s", "b")], "doc_id long, source string, text string")
    assert mixing.mix(docs.where("false")).count() == 0
    a = sorted(map(str, mixing.mix(docs).collect()))
    monkeypatch.setattr(mixing, "BROADCAST", 0)  # the way for many sources
    assert sorted(map(str, mixing.mix(docs).collect())) == a
    given = [mixing.mix(docs, {"s": 1.0}, seed=seed).collect() for seed in "abcd"]  # a mean of two copies for each of two equal rows
    assert all({r.source for r in g} <= {"s"} and len(g) == 2 * (g[0].copies if g else 0) for g in given) and max(map(len, given)) > 0
    plan = mixing.mix(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


def test_large_rates(spark):
    docs = spark.range(300).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 3, "a").otherwise("b").alias("source"), F.lit("x").alias("text"))
    assert abs(mixing.mix(docs, {"a": 1.0}).count() - 300) < 80


# --- packing --------------------------------------------------------------------------------


def check_packing(rows, got, capacity):
    ids = {}
    encode = packing.encoder(PATH)
    for d, t in rows:
        ids.setdefault(d, []).append(np.concatenate([np.frombuffer(encode(t or ""), "<u4"), [packing.END]]).astype("<u4"))
    n = Counter(d for d, _ in rows)
    for r in got:
        assert any(zlib.crc32(x[r.start : r.start + r.length].tobytes()) == r.ids_crc32 and len(x[r.start : r.start + r.length]) == r.length for x in ids[r.doc_id])
        assert r.piece == 0 or r.length == capacity
    assert sum(r.length for r in got) == sum(len(x) for v in ids.values() for x in v)
    assert Counter(r.doc_id for r in got if r.piece == 0) == n
    by = defaultdict(list)
    for r in got:
        by[r.sequence_id].append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_packing_is_whole_and_close_to_the_bound(spark):
    rng = np.random.default_rng(8)
    rows = [(int(i), "word " * int(rng.integers(0, 150))) for i in range(700)] + [(5, "again"), (5, "again"), (None, "no id"), (9000, None), (9001, "x y z " * 400)]
    got = packing.pack(documents(spark, rows), PATH, capacity=128).collect()
    n = check_packing(rows, got, 128)
    assert n <= 1.02 * sum(r.length for r in got) / 128 + 2
    assert packing.pack(documents(spark, []), PATH).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_plans_hold_each_piece_once(seed):
    rng = np.random.default_rng(seed)
    h = Counter(rng.integers(1, 65, int(10 ** rng.uniform(0, 4))).tolist())
    plan = packing.solve(dict(h), 64, rounds=200)
    held = Counter()
    for config, times in plan:
        assert times > 0 and sum(k * v for k, v in config.items()) <= 64
        for k, v in config.items():
            held[k] += v * times
    assert held == h
    spots = defaultdict(set)
    for r in packing.layout(plan):
        for rank in range(r.first, r.last + 1):
            n, slot = divmod(rank - r.first, r.each)
            spots[r.sequence + n] |= set(range(r.offset + slot * r.length, r.offset + (slot + 1) * r.length))
    assert sum(map(len, spots.values())) == sum(k * v for k, v in h.items())


@pytest.mark.parametrize(("n", "share"), [(300, 0.1), (1500, 0.3), (15000, 0.5)])
def test_the_program_packs_a_share_at_every_size(n, share, monkeypatch):
    h = Counter(np.random.default_rng(n).integers(1, 1025, n).tolist())
    rest, greedy = [], packing._greedy
    monkeypatch.setattr(packing, "_greedy", lambda *a: (rest.append(x[1]) or x for x in greedy(*a)))
    total, bound = sum(times for _, times in packing.solve(dict(h), 1024)), -(-sum(k * v for k, v in h.items()) // 1024)
    assert total - sum(rest) > share * total and bound <= total <= 1.08 * bound


def test_the_program_gives_nearly_all_of_a_large_plan():
    h = {k: 30 * v for k, v in Counter(np.clip(np.random.default_rng(4).lognormal(5.3, 1, 15000), 1, 1023).astype(int).tolist()).items()}
    need = np.zeros(1025, np.int64)
    need[list(h)] = list(h.values())
    got = packing.solution(h, 1024)
    total = sum(times for _, times in got.plan)
    assert got.program + got.rest + got.whole == total and got.program > 0.9 * total
    assert got.bound <= total <= sum(times for _, times in packing._best_fit(need, 1024))
    held = Counter()
    for config, times in got.plan:
        held.update({k: v * times for k, v in config.items()})
    assert held == Counter(h)


def test_plans_of_lengths_that_cannot_fill():
    assert packing.solution({600: 100}, 1024).program == 100
    got = packing.solution({600: 100, 300: 50, 1024: 2}, 1024)
    assert got.whole == 2 and sum(t for _, t in got.plan) == 102 >= got.bound - 1e-6 and packing.solution({}, 1024).plan == []


def test_knapsack_finds_the_best_price():
    rng = np.random.default_rng(3)
    for _ in range(20):
        prices = np.concatenate([[0], rng.random(12)])
        best = [0.0] * 21
        for c in range(1, 21):
            best[c] = max([best[c - 1]] + [best[c - k] + prices[k] for k in range(1, min(c, 12) + 1)])
        got = packing.best_configuration(prices, 20, np.full(13, 99))
        assert sum(k * v for k, v in got.items()) <= 20 and abs(sum(prices[k] * v for k, v in got.items()) - best[20]) < 1e-9


# --- search ---------------------------------------------------------------------------------


def search_by_hand(rows, asked, k):
    whole = [(i, [int(np.floor(float(x) * 1024)) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q in sorted({i for i, _ in whole if asked(i)}):
        for qv in [v for i, v in whole if i == q][:1]:
            found = sorted((-sum(a * b for a, b in zip(qv, v, strict=True)), i) for i, v in whole if i != q and len(v) == len(qv))[:k]
            out += [(q, r, i, -s) for r, (s, i) in enumerate(found, 1)]
    return sorted(out)


def test_search_is_exact(spark, monkeypatch):
    monkeypatch.setattr(topk, "VECTORS", 50)
    monkeypatch.setattr(topk, "QUERIES", 3)
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(0, 0.2, 20).round(1).tolist()) for i in range(400)]
    rows += [(400 + i, rows[7][1]) for i in range(30)] + [(900, [0.5] * 6), (910, [0.25] * 6), (901, None), (902, [None] * 20), (903, [float("nan")] * 20), (904, [float("inf")] * 20), (None, rows[3][1]), (950, [3e9] * 6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(tuple(r) for r in topk.top_k(df, F.col("vec_id") % 10 == 0, 10).collect())
    assert got == search_by_hand(rows, lambda i: i % 10 == 0, 10)
    assert topk.top_k(df.where("false"), F.col("vec_id") % 10 == 0, 10).count() == 0


def test_bounds_leave_vectors_out():
    rng = np.random.default_rng(0)
    centres = rng.normal(0, 400, (8, 64))
    v = (centres[rng.integers(0, 8, 2000)] + rng.normal(0, 5, (2000, 64))).astype(np.int64)
    kept = []
    real = topk._scores
    try:
        topk._scores = lambda a, b: kept.append(len(a)) or real(a, b)
        topk.search_block(np.arange(5), v[:5], np.arange(2000), v, 10)
    finally:
        topk._scores = real
    assert kept[-1] < 5 * 2000 / 3


@pytest.mark.parametrize("spread", [5, 400])
def test_a_task_carries_its_best_on(spread):
    """Blocks of any order, thresholds of a first pass and dropped levels change no result."""
    rng = np.random.default_rng(1)
    v = (rng.normal(0, 300, (6, 24))[rng.integers(0, 6, 900)] + rng.normal(0, spread, (900, 24))).astype(np.int64)
    v[800:] = v[:100]  # ties
    ids = rng.permutation(900)
    scores = v[:40] @ v.T
    want = []
    for i in range(40):
        want += sorted((int(ids[i]), -int(scores[i, j]), int(ids[j])) for j in range(900) if ids[j] != ids[i])[:7]
    for least in (np.full(40, -np.inf), np.array([-want[7 * i + 6][1] for i in range(40)], float)):
        search = topk.Search([(24, ids[:40].astype("<i8").tobytes(), v[:40].astype("<i8").tobytes(), least.astype("<f8").tobytes())], 7)
        for at in range(0, 900, 130):
            search.meet(24, ids[at : at + 130], v[at : at + 130])
        got = [(q, -s, i) for b in search.rows() for q, i, s in zip(*(c.to_pylist() for c in b.columns), strict=True)]
        assert sorted(got) == sorted(want)


def test_search_leaves_vectors_in_place(spark):
    df = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(50)], "vec_id long, embedding array<double>").withColumn("score", F.lit(1))
    plan = topk._found(df.selectExpr("vec_id as id", "embedding as v"), [], 3)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan
    assert topk.top_k(df.unionByName(df), F.col("vec_id") == 7, 3).where("vec_id = 49").count() == 2


# --- the pipeline ---------------------------------------------------------------------------


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline

    rng = np.random.default_rng(6)
    vocabulary = [f"term{i}" for i in range(500)]
    rows, labels = [], []
    for d in range(240):
        words = list(rng.choice(vocabulary, rng.integers(30, 60)))
        toxic = int(d % 6 == 0)
        if toxic:
            for bad in ("foul", "vile", "rotten", "mean"):
                words[int(rng.integers(0, len(words)))] = bad
        rows.append((d, " ".join(words) + "\nThis footer is on every page", "en", f"s{d % 4}", 0))
        labels.append((d, 1, toxic))
    rows += [(1000 + i, rows[i][1].split("\n")[0] + " end", "en", "s9", 0) for i in range(1, 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    now = spark.read.parquet(str(tmp_path / "documents.parquet"))
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, now, str(tmp_path)).write.parquet(str(tmp_path / name.replace(" ", "")))
        after = spark.read.parquet(str(tmp_path / name.replace(" ", "")))
        seen.append((now, after))
        now = after
    for before, after in seen[:-1]:
        assert after.columns == docs.columns and before.columns == docs.columns
    bad = {d for d, _, t in labels if t}
    kept = {r.doc_id for r in seen[0][1].select("doc_id").collect()}
    assert len(bad & kept) <= 2 and len(kept - bad) >= 0.98 * (len(rows) - len(bad) - len([i for i in range(1, 60) if i in bad]))
    want = {d: t for d, _, _, t in lines_by_hand([(r.doc_id, r.text) for r in seen[1][0].collect()])}
    assert {r.doc_id: r.text for r in seen[1][1].collect()} == want and all(r.n_chars == len(r.text) for r in seen[1][1].collect())
    firsts = {d for d, _, c, ok in components_by_hand([(r.doc_id, r.text) for r in seen[2][0].collect()], 5) if ok}
    assert {r.doc_id for r in seen[2][1].collect()} == firsts
    mixed = [(r.doc_id, r.text) for r in seen[3][1].collect()]
    assert {d for d, _ in mixed} <= firsts
    check_packing(mixed, now.collect(), 1024)
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == now.count()


ODD = [(1, "a few words in one line here", "s"), (1, "a few words in one line here", "s"), (2, None, None), (3, "", "s"), (4, "a few words in one line here", "t"), (None, "no id but some words", "s"), (None, None, None), (5, "word " * 3000 + "end", "t"), (6, " \n ", "t")]
CLASH = ["score", "n_passages", "passages", "n_lines", "n_dropped", "copy", "copies", "mix_key", "__doc", "__carried0", "component_id", "kept", "segments", "a`b".replace("`", " ")]


@pytest.fixture(scope="module")
def odd_tables(spark, tmp_path_factory):
    docs = spark.createDataFrame(ODD, "doc_id long, text string, source string")
    docs = docs.select("doc_id", *[F.concat(F.lit(f"{c}-"), F.coalesce(F.col("doc_id").cast("string"), F.lit("x"))).alias(c) for c in CLASH], "text", "source", F.lit(7).alias("n_chars"))
    folders = {}
    for name, rows in (("odd", docs), ("empty", docs.where("false"))):
        folders[name] = str(tmp_path_factory.mktemp(name))
        rows.write.parquet(f"{folders[name]}/documents.parquet")
        spark.createDataFrame([(1, 1, 0), (5, 1, 1), (None, 1, 1), (4, None, None)], "doc_id long, quality int, toxic int").write.parquet(f"{folders[name]}/labels.parquet")
    return folders


@pytest.mark.parametrize("k", range(4))
def test_stages_carry_odd_rows_and_columns(spark, odd_tables, k):
    import corpus_pipeline

    name, stage = corpus_pipeline.STAGES[k]
    docs = spark.read.parquet(odd_tables["odd"] + "/documents.parquet")
    got = stage(spark, docs, odd_tables["odd"])
    assert got.schema.names == docs.schema.names and [f.dataType for f in got.schema] == [f.dataType for f in docs.schema]
    rows = got.collect()
    for r in rows:
        assert all(r[c] == f"{c}-{'x' if r.doc_id is None else r.doc_id}" for c in CLASH)
    have = Counter((r.doc_id, r.text) for r in rows)
    given = Counter((d, t) for d, t, _ in ODD)
    if k == 0:
        assert have == given
    elif k == 1:  # document 4 has nothing that document 1 hasn't
        assert have == given - Counter({(4, ODD[0][1]): 1}) and all(r.n_chars == len(r.text) for r in rows if r.text is not None)
    elif k == 2:
        assert have == Counter({k: v for k, v in given.items() if k[0] != 4}) - Counter({(1, ODD[0][1]): 1})
    else:
        assert set(have) <= set(given)
    empty = spark.read.parquet(odd_tables["empty"] + "/documents.parquet")
    assert stage(spark, empty, odd_tables["empty"]).count() == 0


def test_packing_stage_tells_copies_apart(spark, odd_tables):
    import corpus_pipeline

    docs = spark.read.parquet(odd_tables["odd"] + "/documents.parquet")
    got = corpus_pipeline.pack_sequences(spark, docs, odd_tables["odd"]).collect()
    assert len({(r.row_id, r.piece) for r in got}) == len(got) and len({r.row_id for r in got}) == len(ODD)
    check_packing([(d, t) for d, t, _ in ODD], got, 1024)


def test_near_copies_are_found_by_their_texts_of_before(spark):
    """What line dedup leaves of a near copy no longer shows it."""
    words = [f"w{i}" for i in range(200)]
    whole = [(1, "\n".join(" ".join(words[i : i + 20]) for i in range(0, 200, 20))), (2, "\n".join(" ".join([*words[i : i + 19], "other" if i == 100 else words[i + 19]]) for i in range(0, 200, 20))), (3, "something else altogether is said in here"), (9, whole_text := "a text of a document that went before this")]
    now = [(1, whole[0][1]), (2, "w100 w101 other"), (3, whole[2][1]), (8, whole_text)]
    got = sorted(r.doc_id for r in near_dup.first_of_each(documents(spark, now), before=documents(spark, whole)).collect())
    assert got == [1, 3, 8]


def test_copies_of_hot_classes_do_not_meet(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "HOT", 3)
    rows = [(i, "the same text for all of these documents here") for i in range(40)] + [(100 + i, f"text {i} of its own words x{i} y{i} z{i}") for i in range(20)] + [(300, None)]
    got = {r.doc_id: r.component_id for r in near_dup.near_duplicates(documents(spark, rows)).collect()}
    assert got == {**{i: 0 for i in range(40)}, **{100 + i: 100 + i for i in range(20)}, 300: 300}


def test_texts_reach_the_end_whole(spark):
    t = "line of the text\n" * 3
    got = line_dedup.dedup(documents(spark, [(1, t)])).first()
    assert got.text == t and got.n_dropped == 0


def test_exploded_bands_are_not_sent_whole_to_all_tasks(spark, monkeypatch):
    """A class has 21 bands, and a share of its files for ids and bands tells nothing of that: Spark would gather millions of rows in the driver."""
    plans, write = {}, near_dup.stored

    def noted(df, name):
        plans.setdefault(name, df._jdf.queryExecution().executedPlan().toString())
        return write(df, name)

    monkeypatch.setattr(near_dup, "stored", noted)
    rows = [(i, f"{'the same words stand here again and again ' * 3} {'x' * (i % 3)}") for i in range(30)]
    near_dup.near_duplicates(documents(spark, rows)).collect()
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") != "-1"
    for name in ("buckets", "pairs", "labelled", "needed"):
        assert "Join" in plans[name] and "Broadcast" not in plans[name]
