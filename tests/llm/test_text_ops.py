"""Operators on texts and lines, against plain Python."""

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from stemmata.llm import line_dedup, media, packing, quality, queries, text, token_counts, toxicity, url_filter

PATH = public_tokenizers.path("byte_bpe_50k.json")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def documents(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


# --- text -----------------------------------------------------------------------------------


def shingles(t, k):
    w = WORDS.findall((t or "").translate(UPPER))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="aAbB é \t\n\x0b\x1c ", max_size=60), max_size=6))
def test_shingle_sets_have_the_sizes_of_real_sets(texts):
    got = text.shingle_sets([t.encode() for t in texts], 3)
    want = [shingles(t, 3) for t in texts]
    assert [len(g) for g in got] == [len(w) for w in want]
    for i in range(len(texts)):
        for j in range(i):
            assert len(np.intersect1d(got[i], got[j])) == len(want[i] & want[j])


def test_long_texts_go_in_slices(monkeypatch):
    t = " ".join(f"word{i % 97}" for i in range(3000)).encode()
    whole = text.shingle_sets([t, None, b"x" * 500], 4)
    monkeypatch.setattr(text, "SLICE", 64)
    cut = text.shingle_sets([t, None, b"x" * 500], 4)
    assert all((a == b).all() for a, b in zip(whole, cut, strict=True)) and len(whole[2]) == 1


# --- lines ----------------------------------------------------------------------------------


def lines_by_hand(rows, least=10):
    held = defaultdict(set)
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate(UPPER)
    for d, t in rows:
        for x in (t or "").split("\n"):
            held[key(x)].add(d)
    owner = {k: min(v) for k, v in held.items() if len(k) >= least and len(v) > 1}
    out = []
    for d, t in rows:
        own = (t or "").split("\n")
        kept = [x for x in own if owner.get(key(x), d) == d]
        out.append((d, len(own), len(own) - len(kept), "\n".join(kept)))
    return sorted(out)


def test_line_dedup(spark, monkeypatch):
    rng = np.random.default_rng(3)
    pool = [f"A common line number {i}" for i in range(40)] + ["short", "ééééééééé", "éééééééééé", "", "  A Common LINE number 1\t"]
    rows = [(int(d), "\n".join(pool[j] for j in rng.integers(0, len(pool), rng.integers(1, 12)))) for d in range(120)]
    rows += [(500 + i, "One line that everybody has\nown text number " + str(i)) for i in range(100)] + [(900, None), (901, "")]
    want = lines_by_hand(rows)
    read = lambda: sorted((r.doc_id, r.n_lines, r.n_dropped, r.text or "") for r in line_dedup.dedup(documents(spark, rows)).collect())
    assert read() == want
    monkeypatch.setattr(line_dedup, "HOT", 8)  # most keys go through shards
    assert read() == want
    monkeypatch.setattr(line_dedup, "HOT", 1)  # all do
    assert read() == want


def test_line_dedup_edge_rows(spark):
    odd = spark.createDataFrame([(None, "a line of some length", 1), (1, "a line of some length", 2), (1, "a line of some length", 3), (2, "A line of some length ", 4)], "doc_id long, text string, n_lines int")
    got = sorted((str(r.doc_id), r.n_lines, r.n_dropped) for r in line_dedup.dedup(odd).collect())
    assert got == [("1", 1, 0), ("1", 1, 0), ("2", 1, 1), ("None", 1, 0)]
    assert line_dedup.dedup(documents(spark, [])).count() == 0


def test_perfect_hash_holds_its_keys_only():
    rng = np.random.default_rng(1)
    h1, h2 = rng.integers(-(2**63), 2**63, 5000), rng.integers(-(2**63), 2**63, 5000)
    index = line_dedup.PerfectHash(h1[:4000], h2[:4000], np.arange(4000), np.ones(4000, np.int64))
    got = index.owner(h1, h2, np.full(5000, -1))
    assert (got == np.concatenate([np.arange(4000), np.full(1000, -1)])).all() and sorted(index.owners) == list(range(4000))


# --- toxicity and quality -------------------------------------------------------------------


def best_segments(scores):
    """All maximal scoring segments, by definition: the best one, then left and right of it."""
    def split(lo, hi):
        best = max(((sum(scores[i:j]), -(j - i), -i, i, j) for i in range(lo, hi) for j in range(i + 1, hi + 1)), default=(0, 0, 0, 0, 0))
        if best[0] <= 1e-12:
            return []
        return split(lo, best[3]) + [(round(best[0], 6), best[3], best[4])] + split(best[4], hi)

    return split(0, len(scores))


@settings(max_examples=80, deadline=None)
@given(st.lists(st.sampled_from("abcx"), max_size=14))
def test_segments_are_the_maximal_ones(words):
    weights = {"a": 2.003, "b": -1.307, "c": 0.709}
    scores = [toxicity.DRIFT if i and w == words[i - 1] else weights.get(w, toxicity.DRIFT) for i, w in enumerate(words)]
    got = [(round(s, 6), i, j) for s, i, j in toxicity.segments(weights, words)]
    assert [g[0] for g in got] == [b[0] for b in best_segments(scores)]


def labelled(spark, n=400):
    rng = np.random.default_rng(5)
    common = [f"w{i}" for i in range(300)]
    rows, labels = [], []
    for d in range(n):
        words = list(rng.choice(common, rng.integers(20, 60)))
        toxic, good = int(d % 4 == 0), int(d % 5 > 0)
        if toxic:
            for bad in ("foul", "vile", "rotten"):
                words.insert(int(rng.integers(0, len(words))), bad)
        if not good:
            words = [w.upper() + "!!" for w in words]
        rows.append((d, " ".join(words)))
        labels.append((d, good, toxic))
    return documents(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_toxicity_on_held_out_rows(spark):
    docs, labels = labelled(spark)
    held = toxicity.held_out(F.col("doc_id"), 3, 1)
    model = toxicity.train(docs, labels.where(~held))
    got = toxicity.score(docs.unionByName(documents(spark, [(None, "foul vile rotten"), (9001, None), (9002, ""), (9003, "w1 " * 30000)])), model)
    found = got.join(labels, "doc_id").where(held).select(((F.col("score") >= 0.7).cast("int") == F.col("toxic")).cast("int").alias("ok"))
    assert found.agg(F.avg("ok")).first()[0] > 0.95
    by = {r.doc_id: r for r in got.where("doc_id is null or doc_id > 9000").collect()}
    assert by[None].score > 0.7 and by[None].passages[0].text == "foul vile rotten"
    assert all(by[d].score < 0.5 and by[d].n_passages == 0 for d in (9001, 9002, 9003))
    for empty in (labels.where("false"), labels.where("toxic = 0")):
        none = toxicity.train(docs, empty)
        assert toxicity.score(docs, none).agg(F.max("score")).first()[0] < 0.01


def test_words_share_the_evidence_of_their_beginning(spark):
    rng = np.random.default_rng(8)
    ends = ["".join(rng.choice(list("abcdefgh"), 4)) for _ in range(400)]
    rows = []
    for d in range(600):
        words = list(rng.choice([f"w{i}" for i in range(300)], 30)) + ([f"vilex{rng.choice(ends)}"] if d % 5 == 0 else [])
        rows.append((d, " ".join(rng.permutation(words))))
    labels = spark.createDataFrame([(d, int(d % 5 == 0)) for d in range(600)], "doc_id long, toxic int")
    model = toxicity.train(documents(spark, rows), labels)
    assert model.weights["vilex*"] > 2 and toxicity.Lookup(model.weights)["vilexnever"] == model.weights["vilex*"]
    got = toxicity.score(documents(spark, [(1, "w1 w2 vilexnever w3"), (2, "w1 w2 never w3")]), model).orderBy("doc_id").collect()
    assert got[0].score > 0.7 > got[1].score


def test_copies_teach_once(spark):
    docs, labels = labelled(spark, 200)
    copies = [(10000 + i, "once upon a time there was a strange beast") for i in range(60)]
    marks = spark.createDataFrame([(d, 1, 1) for d, _ in copies], labels.schema)
    both = docs.unionByName(documents(spark, copies)), labels.unionByName(marks)
    assert not {"strange", "beast", "once", "upon"} & set(toxicity.train(*both).weights)
    assert toxicity.train(docs, labels).weights == toxicity.train(docs.unionByName(docs), labels).weights


def test_choice_of_words_is_that_of_the_rule(spark):
    """Against the rule by hand: the least g that all chosen reach, by exact tails where all contexts are toxic."""
    rng = np.random.default_rng(2)
    rows = [(f"n{i}", int(b), n, 0.1) for i, (b, n) in enumerate((rng.binomial(n, 0.1), n) for n in map(int, rng.integers(3, 60, 500)))] + [(f"t{n}", n, n, 0.1) for n in range(3, 30)] + [("rare", 2, 2, 0.1)]
    got = {r.node for r in toxicity._unlike(spark.createDataFrame(rows, "node string, bad long, n long, p double"))}

    def tail(bad, n):  # the greater tail, exactly
        from math import comb

        return sum(comb(n, k) * 0.1**k * 0.9 ** (n - k) for k in range(bad, n + 1))

    exact = sorted((tail(b, n), node) for node, b, n, _ in rows if n >= toxicity.LEAST and b > 0.1 * n)
    m = len([r for r in rows if r[2] >= toxicity.LEAST])
    strict = {node for i, (p, node) in enumerate(exact, 1) if p <= toxicity.FALSE / 16 * i / m}
    assert strict <= got and "rare" not in got
    assert sum(node.startswith("n") for node in got) <= 3 and {f"t{n}" for n in range(6, 30)} <= got


def test_toxicity_of_edge_rows(spark):
    docs, labels = labelled(spark, 200)
    model = toxicity.train(docs, labels.unionByName(labels))
    assert toxicity.score(docs.where("false"), model).count() == 0
    assert toxicity.train(docs.where("false"), labels).weights == {}
    clash = docs.selectExpr("doc_id", "text", "'mine' as score", "1 as passages", "'x' as other")
    got = toxicity.score(clash.unionByName(clash), model)
    assert got.columns == ["doc_id", "text", "other", "score", "n_passages", "passages"] and got.count() == 400
    assert got.groupBy("doc_id").agg(F.countDistinct("score").alias("k")).where("k <> 1").count() == 0


def test_labels_of_held_out_rows_do_not_matter(spark):
    docs, labels = labelled(spark, 150)
    held = toxicity.held_out(F.col("doc_id"), 3, 1)
    assert labels.where(held).select("doc_id").first()[0] is not None and zlib.crc32(str(labels.where(held).first().doc_id).encode()) % 3 == 1
    other = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = toxicity.train(docs, labels.where(~held)), toxicity.train(docs, other.where(~held))
    assert a == b


def test_quality_on_held_out_rows(spark):
    docs, labels = labelled(spark)
    held = toxicity.held_out(F.col("doc_id"), 5, 0)
    model = quality.train(docs, labels.where(~held))
    got = quality.score(docs.unionByName(documents(spark, [(9001, None), (9002, "")])).withColumn("score", F.lit("old")), model)
    found = got.join(labels, "doc_id").where(held).select(((F.col("score") >= 0.3).cast("int") == F.col("quality")).cast("int").alias("ok"))
    assert found.agg(F.avg("ok")).first()[0] > 0.95
    assert {r.score for r in got.where("doc_id > 9000").collect()} == {model.prior}
    assert quality.score(docs, quality.train(docs, labels.where("false"))).agg(F.min("score"), F.max("score")).first() == (0.5, 0.5)


def test_votes_are_the_exact_cosines(spark):
    docs, labels = labelled(spark, 120)
    m = quality.train(docs, labels)
    x = np.stack([quality.features(r.text.encode()) for r in docs.limit(20).collect()])
    for row, got in zip(x, quality.vote(m, x), strict=True):
        v = quality._unit(quality._weighted(row[None], m.idf) @ m.projection)[0]
        c = m.vectors @ v
        near = np.argsort(-c)[: quality.NEIGHBOURS]
        w = np.exp(quality.SHARPNESS * (c[near].astype(float) - 1))
        assert abs(got - (w * m.labels[near]).sum() / w.sum()) < 1e-3


# --- URLs -----------------------------------------------------------------------------------


def rule_by_hand(url):
    rest = url.partition("://")[2] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest).group().translate(UPPER)
    path = re.match(r"[^?#]*", rest[len(host) :]).group()
    fits = [(len(h) + len(p), v, h + p) for v, h, p in queries.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, max(fits)[2], max(fits)[1]) if fits else (host, path, None, "allow")


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.none(), st.builds(lambda s, h, p, t: s + h + p + t, st.sampled_from(["http://", "", "x://y://", "HTTP://"]), st.sampled_from(["com", "a.COM", "example.com", "badexample.com", "b.example.com", "example.net", "net", "org", "", ".org", "org.", "u@example.com:80"]), st.sampled_from(["", "/", "/en", "/en/", "/en/7", "/en/71/x", "/de/8", "/de/81", "/de//8", "/es/?q", "/EN/7"]), st.sampled_from(["", "?a=/en/", "#x", "?#"]))))
def test_trie_finds_the_longest_rule(url):
    host, path = url_filter.split_url(url)
    verdict, rule = url_filter.Trie(queries.RULES).find(host, path) or ("allow", None)
    assert (host, path, rule, verdict) == rule_by_hand(url)


def test_url_filter_rows(spark):
    pages = spark.createDataFrame([(1, "http://a.com/en/x", "own"), (1, "http://a.com/en/x", "own"), (2, None, "own")], "page_id long, url string, rule string")
    got = [tuple(r) for r in url_filter.judge(pages, queries.RULES).select("page_id", "rule", "verdict").orderBy("page_id").collect()]
    assert got == [(1, "com/en/", "block"), (1, "com/en/", "block"), (2, None, "allow")]
    with pytest.raises(ValueError):
        url_filter.Trie([("allow", "a", "/"), ("block", "a", "/")])


# --- media ----------------------------------------------------------------------------------


@settings(max_examples=40, deadline=None)
@given(st.binary(max_size=2000))
def test_images_lose_nothing(data):
    p = media.padded(data)
    assert len(p) % media.ROW == 0 and len(p) >= media.ROW and p[: len(data)] == data and set(p[len(data) :]) <= {255}
    assert media.samples(media.image(p)).tobytes() == p


def test_damaged_images_are_noticed():
    m = media.image(media.padded(b"hello"))
    for bad in (m[:-20] + b"\0" + m[-19:], b"x" + m, b""):
        with pytest.raises(ValueError):
            media.samples(bad)


def test_pages_are_interleaved_in_order():
    html = "<p>one <b>two</b></p><figure><img src='sha256:%s' alt='a'><figcaption>cap <i>tion</i></figcaption></figure>tail<img src='x.png' alt=' al  t '><script>no</script><img alt='none'><p>end" % ("AB" * 32)
    got = media.segments(html)
    assert [(s["position"], s["kind"], s["text"], s["ref"]) for s in got] == [(0, "text", "one two", None), (1, "media", "cap tion", "sha256:" + "AB" * 32), (2, "text", "tail", None), (3, "media", "al t", "x.png"), (4, "text", "end", None)]
    assert got[1]["digest"] == "ab" * 32 and got[3]["digest"] is None
    assert media.digest_of("data:,hi") == hashlib.sha256(b"hi").hexdigest() == media.digest_of("data:text/plain;base64,aGk=") and media.digest_of("data:;base64,*") is None
    assert media.segments(None) == [] == media.segments("")


def test_payloads_are_resolved(spark):
    store = media.stored(documents(spark, [(1, "same"), (2, "same"), (3, None), (4, "x" * 5000), (None, "n")]))
    got = {r.doc_id: r for r in media.resolve(media.interleave(store.select("doc_id", "n_bytes", "html")), media.described(store)).collect()}
    p = media.padded(b"same")
    assert got[1].payload_sha256 == hashlib.sha256(p).hexdigest() == got[2].payload_sha256 and got[1].feature == got[2].feature and got[1].media_sha256 == got[1].digest
    assert (got[3].n_bytes, got[3].payload_bytes, got[4].payload_bytes, got[4].caption) == (0, 576, 5184, "document 4")
    assert got[1].tail_crc32 == zlib.crc32(p[-32:]) and got[None].n_bytes == 1
    missing = media.resolve(media.interleave(spark.createDataFrame([(1, "<img src='sha256:%s'>" % ("0" * 64))], "page_id int, html string")), media.described(store))
    assert [r.feature for r in missing.collect()] == [None]


# --- tokens ---------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return t


TEXTS = st.text(alphabet=st.sampled_from(list("ab cd  \n\té'sll.,7+@!ñ日 ")), max_size=80)


@settings(max_examples=80, deadline=None)
@given(TEXTS)
def test_ids_are_those_of_the_library(tokenizer, t):
    assert np.frombuffer(packing.encoder(PATH)(t), "<u4").tolist() == tokenizer.encode(t, add_special_tokens=False).ids


def test_names_of_special_tokens():
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(PATH)
    for x in ("a <|endoftext|> b", "<|endoftext|><|endoftext|>", " <|endoftext|", "a\n <|endoftext|>\n"):
        ids = np.frombuffer(packing.encoder(PATH, special=True)(x), "<u4").tolist()
        assert ids == plain.encode(x, add_special_tokens=False).ids
    assert 50256 not in np.frombuffer(packing.encoder(PATH)("<|endoftext|>"), "<u4")


@settings(max_examples=80, deadline=None)
@given(TEXTS, st.lists(st.tuples(st.integers(0, 80), st.integers(0, 6), st.sampled_from(["", " ", "x", "<email>", " a b ", "\n"])), max_size=5))
def test_counts_follow_edits(t, changes):
    count = lambda x: len(packing.encoder(PATH)(x)) // 4 if x else 0
    edits, last = [], 0
    for at, n, new in sorted(changes):
        if last <= at <= len(t):
            edits.append((at, min(at + n, len(t)), new))
            last = edits[-1][1]
    tree = token_counts.TokenTree(t, count, leaf=6)
    assert tree.total == count(t)
    tree.apply(edits)
    for a, b, new in reversed(edits):
        t = t[:a] + new + t[b:]
    assert tree.text == t and tree.total == count(t)


def test_kept_trees_follow_later_edits(spark):
    rng = np.random.default_rng(3)
    texts = {i: " ".join(rng.choice(["one", "two's", "3,4", "five  six", "\n", "ñandú"], int(rng.integers(1, 600)))) for i in range(12)} | {20: "", 21: None}
    docs = documents(spark, [*texts.items(), (None, "no id")])
    leaves = token_counts.kept(docs, PATH, leaf=32)
    count = lambda x: len(packing.encoder(PATH)(x)) // 4 if x else 0
    assert {r.doc_id: r.n_tokens for r in token_counts.totals(leaves).collect()} == {i: count(t) for i, t in texts.items()}
    rows, want = [], dict(texts)
    for _ in range(2):  # one batch of edits after another, each on what is stored
        rows = []
        for i in range(0, 12, 2):
            t = want[i]
            a, b = sorted(map(int, rng.integers(0, len(t) + 1, 2)))
            b = min(b, a + 9)
            rows.append((i, a, b, str(rng.choice(["", " new words ", "x"]))))
            want[i] = t[:a] + rows[-1][3] + t[b:]
        rows.append((20, 0, 0, "text at last"))
        want[20] = "text at last" + (want[20] or "")
        rows.append((99, 0, 0, "nobody"))
        leaves = token_counts.edited(leaves, spark.createDataFrame(rows, "doc_id long, at long, end long, new string"), PATH)
        stored = leaves.collect()
        leaves = spark.createDataFrame(stored, token_counts.LEAVES)
        assert {r.doc_id: r.n_tokens for r in token_counts.totals(leaves).collect()} == {i: count(t) for i, t in want.items()}
        for i, t in want.items():
            assert "".join(r.text for r in sorted((r for r in stored if r.doc_id == i), key=lambda r: r.leaf)) == (t or "")
    assert token_counts.kept(docs.where("false"), PATH).count() == 0
    with pytest.raises(Exception, match="two trees"):
        token_counts.edited(leaves.unionAll(leaves), spark.createDataFrame([(2, 0, 0, "x")], "doc_id long, at long, end long, new string"), PATH).collect()


def test_edits_encode_a_small_part_again():
    t = "word " * 20000 + "me@example.com tail"
    tree = token_counts.TokenTree(t, lambda x: len(packing.encoder(PATH)(x)) // 4)
    assert tree.apply(token_counts.redactions(t)) < 1000
    with pytest.raises(ValueError):
        tree.apply([(5, 9, ""), (3, 4, "")])
    with pytest.raises(ValueError):
        tree.edit(0, 10**9, "")


def test_counted_rows(spark):
    rows = documents(spark, [(1, "a  b"), (2, None), (3, ""), (None, "x@y.org")])
    got = {r.doc_id: (r.n_tokens, r.n_edits, r.n_tokens_after) for r in token_counts.counted(rows, PATH).collect()}
    assert got[2] == got[3] == (0, 0, 0) and got[1][1] == 1 and got[None][1] == 1


def test_payloads_of_shared_digests_reach_every_reference(spark):
    kind = "id long, segments array<struct<position: int, kind: string, text: string, ref: string, digest: string>>"
    ref = lambda i, d: (0, "media", f"caption {i}", "x", d)
    digests = [None if i % 10 == 0 else "hot" if i % 3 else f"d{i}" for i in range(600)]
    sequences = spark.createDataFrame([(i, [ref(i, d)]) for i, d in enumerate(digests)], kind).repartition(3)
    payloads = spark.createDataFrame([("hot", 1), ("hot", 1), (None, 9)] + [(d, 2) for d in digests if d and d != "hot" and d != "d3"], "digest string, size int")
    found = {r.id: (r.caption, r.digest, r["size"]) for r in media.resolve(sequences, payloads).collect()}
    want = {i: (f"caption {i}", d, None if d in (None, "d3") else 1 if d == "hot" else 2) for i, d in enumerate(digests)}
    assert found == want and media.resolve(sequences, payloads).count() == 600
    assert media.resolve(sequences.limit(0), payloads).count() == 0
