"""Token files, repaired conversations and fill-in-middle, against plain Python."""

import glob
import hashlib
import heapq
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from stemmata.llm import conversations as cv
from stemmata.llm import fill_middle as fm
from stemmata.llm import token_files as tf
from tokenizers import Tokenizer

WORDS = public_tokenizers.path("word_bpe_49k.json")
ODD = [None, "", "  \n\t", "a\0b \0 c", "<|endoftext|> x<|startoftext|>y", "J̌ ́x é", "İstanbul ΣΑΣ ǅ", "it's 12,5 %—né", "日本語 text with spaces", "😀" * 5, "." * 40]


def texts(seed=0, n=60):
    rng = random.Random(seed)
    parts = ["the", "Cat,", "sat.", "été", "x1y2", "\n", "<|endoftext|>", "\0", "<P>", "Ω", "😀", "won't", "  "]
    return [" ".join(rng.choices(parts, k=rng.randint(0, 60))) if rng.random() < 0.5 else "".join(rng.choices(parts, k=rng.randint(0, 60))) for _ in range(n)]


# --- token files ----------------------------------------------------------------------------


@pytest.mark.parametrize("block", [8, 64, 256])
@pytest.mark.parametrize("percentile", [0, 50, 95, 100])
def test_blocks_come_back(block, percentile):
    rng = np.random.default_rng(block)
    for n in (0, 1, block - 1, block, block + 1, 7 * block + 3):
        for high in (1, 2, 50_000, 2**32):
            ids = rng.integers(0, high, n, dtype=np.uint64).astype(np.uint32)
            ids[rng.random(n) < 0.05] = 2**32 - 1
            found = tf.pack(ids, block, percentile)
            assert (tf.unpack(found, block)[:n] == ids).all()
            assert len(found.payload) == int(found.starts[-1])
    with pytest.raises(ValueError, match="multiple of 8"):
        tf.pack(np.zeros(3, np.uint32), 12)


def test_outliers_stand_in_lists():
    ids = np.arange(256, dtype=np.uint32) % 16
    ids[[3, 99]] = 40_000
    found = tf.pack(ids)
    assert found.width.tolist() == [4] and found.n_exceptions.tolist() == [2] and len(found.payload) == 4 * 32 + 2 * 6


def test_ranges_read_their_own_blocks():
    ids = np.random.default_rng(1).integers(0, 50_000, 10_000).astype(np.uint32)
    data = tf.file_bytes([1, None, 3], np.array([10, 9_000, 990]), ids)
    f = tf.TokenFile(pa.BufferReader(data))
    assert f.doc_ids.to_pylist() == [1, None, 3] and f.n_ids == 10_000
    for a, b in ((0, 0), (0, 1), (255, 257), (300, 9_999), (9_999, 10_000)):
        assert (f.ids(a, b) == ids[a:b]).all()
    with pytest.raises(ValueError, match="ids"):
        f.ids(5, 10_001)
    with pytest.raises(ValueError, match="not a file"):
        tf.TokenFile(pa.BufferReader(data[:-56] + b"x" * 56))


def test_words_give_the_ids_of_whole_texts():
    encoder, plain = tf.Encoder(WORDS), Tokenizer.from_file(WORDS)
    assert encoder.by_words and not tf.Encoder(public_tokenizers.path("byte_bpe_50k.json")).by_words
    for some in (ODD, texts(1, 300), ["q" * 5_000 + " z"] * 3):
        ids, n = encoder.encode(pa.array(some, pa.string()))
        want = [plain.encode(t or "", add_special_tokens=False).ids for t in some]
        assert n.tolist() == list(map(len, want)) and ids.tolist() == [x for w in want for x in w]


@pytest.mark.parametrize("tokenizer", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_files_hold_all_ids(spark, tmp_path, tokenizer):
    path = public_tokenizers.path(tokenizer)
    some = [*ODD, *texts(2, 80), "long word " * 20_000]
    rows = [(d, t, "x") for d, t in zip(random.Random(1).sample(range(-50, 900), len(some)), some, strict=True)]
    rows += [(None, "no id", "x"), (7_000, "same", "x"), (7_000, "same", "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string").repartition(5)
    folder = tf.write(docs, path, f"file://{tmp_path}/ids", file_ids=2_000)
    found = tf.read(spark, folder).orderBy(F.col("doc_id").asc_nulls_first(), "start").collect()
    plain = Tokenizer.from_file(path)
    want = {d: np.array([*plain.encode(t or "", add_special_tokens=False).ids, 2], "<u4").tobytes() for d, t, _ in rows}
    assert [r.doc_id for r in found] == sorted((r[0] for r in rows), key=lambda d: (d is not None, d or 0))
    at = 0
    for r in found:
        assert r.start == at and r.n_tokens == len(r.ids) // 4 and bytes(r.ids) == want[r.doc_id]
        at += r.n_tokens
    assert len(glob.glob(f"{tmp_path}/ids/part-*")) > 3


def test_token_files_of_nothing(spark, tmp_path):
    folder = tf.write(spark.createDataFrame([], "doc_id long, text string"), WORDS, f"file://{tmp_path}/none")
    assert tf.read(spark, folder).collect() == []


# --- conversations --------------------------------------------------------------------------


def by_hand(rows):
    """Sums, audit and repaired rows by a search over all edits in order of cost and edits."""
    rows = sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2]))
    seen, faults = set(), []
    for _, role, text in rows:
        body = re.sub(r"[\x20\x09-\x0D]", "", text)
        faults.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    heap, done = [(0, "", 0, 0, ())], set()
    while True:
        cost, audit, i, s, out = heapq.heappop(heap)
        if i == len(rows) and s in (0, 3):
            break
        if (i, s) in done:
            continue
        done.add((i, s))
        role, to = {0: ("user", 2), 1: ("user", 2), 2: ("assistant", 3), 3: ("user", 2)}[s]
        heapq.heappush(heap, (cost + 5, audit + "I", i, to, (*out, (role, ""))))
        if i == len(rows):
            continue
        heapq.heappush(heap, (cost + 2, audit + "D", i + 1, s, out))
        if faults[i] in ("", "truncated"):
            more = 5 * (faults[i] == "truncated")
            heapq.heappush(heap, (cost + 1 + more, audit + "R", i + 1, to, (*out, (role, rows[i][2]))))
            kept = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}.get((s, rows[i][1][:1]))
            if kept:
                heapq.heappush(heap, (cost + more, audit + "K", i + 1, kept, (*out, rows[i][1:])))
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
    turns = [x[0] for x in rows if x[0] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    return (gaps, *map(faults.count, ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256("\n".join(f"{a}:{b}" for a, b in out).encode()).hexdigest())


def talks(seed, n=120, longest=14):
    rng = random.Random(seed)
    said = ["Yes.", "no", " ", "", "What?", "Go!\n", "etc", "Well. ", None]
    rows = []
    for c in [*range(n), None]:
        for t in range(rng.randint(1, longest)):
            rows.append((c, rng.choice([t, t, t, t + 2, None]), rng.choice(["user", "assistant", "system", "tool", "", None, "user", "assistant"]), rng.choice(said), 0))
    return rows


def check_talks(spark, rows):
    docs = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, pos int")
    found = cv.repair(docs)
    digest = cv.digests(found.turns).withColumnRenamed("conv_id", "c")
    both = found.conversations.join(digest, F.col("conv_id").eqNullSafe(F.col("c")), "left").drop("c").collect()
    groups = {}
    for c, t, role, text, _ in rows:
        groups.setdefault(c, []).append((t, " " if role is None else role, " " if text is None else text))
    assert len(both) == len(groups)
    empty = hashlib.sha256(b"").hexdigest()
    for r in both:
        assert (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256 or empty) == by_hand(groups[r.conv_id]), r.conv_id


@pytest.mark.parametrize("seed", range(2))
def test_repair(spark, seed):
    check_talks(spark, talks(seed))


def test_repair_across_segments(spark, monkeypatch):
    """Conversations much longer than a segment, one of them most of the table."""
    monkeypatch.setattr(cv, "SEGMENT_BITS", 2)
    check_talks(spark, [*talks(5, 15, 40), *[(3, t, ("user", "assistant")[t % 2], f"Turn {t}.", 0) for t in range(300)], *[(3, 400, "user", "Same.", 0)] * 50])


def test_tables_chain_to_the_whole():
    rng = random.Random(3)
    for _ in range(300):
        codes = "".join(rng.choices("suaxSUAX1278", k=rng.randint(1, 24)))
        cut = sorted(rng.sample(range(len(codes) + 1), 2))
        layer = cv.started()
        for part in (codes[: cut[0]], codes[cut[0] : cut[1]], codes[cut[1] :]):
            layer = cv.chained(layer, [cv.ways(part, e) for e in range(4)])[0]
        assert layer == cv.ways(codes, None)


def test_edits_and_rows(spark):
    found = cv.repair(spark.createDataFrame([(1, 0, "user", "Hi."), (1, 1, "user", "There!"), (2, 0, "assistant", "Alone."), (3, 0, "user", "")], "conv_id int, turn int, role string, text string"))
    assert sorted((r.conv_id, r.cost, r.audit) for r in found.conversations.collect()) == [(1, 1, "KR"), (2, 2, "D"), (3, 2, "D")]
    assert [tuple(r) for r in found.turns.orderBy("conv_id", "pos", "k").select("conv_id", "edit", "role", "text").collect()] == [(1, "K", "user", "Hi."), (1, "R", "assistant", "There!")]


def test_damage(spark):
    rows = [(c, t, "assistant", "Ends. So? Yes!") for c in range(30) for t in range(4)]
    want = []
    for c, t, role, text in rows:
        k = zlib.crc32(f"{c}:{t}".encode()) % 20
        row = (c, t, "user" if k == 4 else role, "" if k == 1 else "Ends So Yes" if k == 2 else text)
        want += [row] * (0 if k == 0 else 2 if k == 3 else 1)
    assert sorted(map(tuple, cv.damaged(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect())) == sorted(want)
    assert [tuple(r) for r in cv.damaged(spark.createDataFrame([(None, None, None, None)], "conv_id long, turn long, role string, text string")).collect()] in ([], [(None, None, " ", " ")], [(None, None, " ", " ")] * 2, [(None, None, "user", " ")], [(None, None, " ", "")])


def test_no_conversations(spark):
    found = cv.repair(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))
    assert found.conversations.collect() == [] and found.turns.collect() == [] and cv.digests(found.turns).collect() == []


# --- fill in middle -------------------------------------------------------------------------

UNITS = re.compile(r"[A-Za-z]+|[^A-Za-z]")


def test_places_of_units():
    rng = random.Random(2)
    for _ in range(200):
        t = "".join(rng.choices(["ab", "c", "é", " ", "\n", "Ω", "😀", "1", "xyz" * rng.randint(1, 400)], k=rng.randint(0, 1500)))
        starts = [m.start() for m in UNITS.finditer(t)]
        index = fm.Checkpoints.of(t.encode(), rng.choice([1, 3, 64, 512]))
        assert (index.n_units, index.n_points) == (len(starts), len(t))
        for k in {0, len(starts), *(rng.randint(0, len(starts)) for _ in range(6))}:
            point = starts[k] if k < len(starts) else len(t)
            assert index.place(k) == (len(t[:point].encode()), point)


def test_cuts_scan_little(monkeypatch):
    monkeypatch.setattr(fm, "SLICE", 1 << 12)
    data = ("word, né 12\n" * 200_000).encode()
    index = fm.Checkpoints.of(data)
    index.place(index.n_units // 2 + 17)
    assert index.scanned <= 8 * fm.EVERY and len(index.units) == -(-index.n_units // fm.EVERY)
    with pytest.raises(ValueError, match="unit"):
        index.place(index.n_units + 1)


def test_fill_in_middle(spark):
    some = [None, "", "<P> here", "a<S", "<S>x", *texts(4, 400), "x" * 300_000, "é1 " * 60_000]
    rows = [(d, t, "old", 5) for d, t in enumerate(some)] + [(7, "twice here", "o", 1)] * 2 + [(None, "no id given", "o", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, form string, keep int").repartition(3)
    found = fm.transformed(docs).withColumn("back", fm.restored(F.col("output"), F.col("form"))).collect()
    assert len(found) == len(rows) and all(r.keep in (1, 5) for r in found)
    forms = set()
    for r in found:
        t = r.text or ""
        digest = hashlib.sha256(f"1:{'' if r.doc_id is None else r.doc_id}".encode()).hexdigest()
        h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
        u = UNITS.findall(t)
        i, j = sorted((h[0] % (len(u) + 1), h[1] % (len(u) + 1)))
        p, m, s = "".join(u[:i]), "".join(u[i:j]), "".join(u[j:])
        if not t or any(x in t for x in fm.MARKS) or h[2] % 100 >= 90:
            want = ("plain", None, None, t)
        elif h[3] % 100 < 20:
            want = ("spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}")
        else:
            want = ("psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}")
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.back) == (len(u), *want, t)
        forms.add(r.form)
    assert forms == {"plain", "psm", "spm"}
    assert fm.transformed(spark.createDataFrame([], "doc_id long, text string")).collect() == []
