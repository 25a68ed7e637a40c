"""Operators 11 to 13 against brute force."""

import hashlib
import itertools
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from runlens.llm import filter_audit, minhash, resample
from runlens.llm.common import join_classes
from runlens.llm.queries import QUERIES, audited_filters
from tests.llm.fixtures import DOCS, awkward_docs, save, with_clashes

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{x}" for x in rng.integers(0, vocabulary, n))


@pytest.fixture(scope="module")
def docs(spark):
    return awkward_docs(spark).cache()


@pytest.fixture(scope="module")
def folder(spark, docs, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("round"))
    save(with_clashes(docs), path, "documents")
    save(spark.createDataFrame([(1, "the of w1é w2é w3é"), (2, None), (None, "")], "item_id long, text string"), path, "benchmark")
    save(spark.createDataFrame([(0, 1, 0), (3, 0, 1), (9, 1, 1), (9, 0, 0), (12, None, 1), (None, 1, 1), (5000, 1, 1)],
                               "doc_id long, quality int, toxic int"), path, "labels")
    return path


@pytest.fixture(scope="module")
def nothing(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("nothing"))
    save(spark.createDataFrame([], DOCS), path, "documents")
    save(spark.createDataFrame([], "item_id long, text string"), path, "benchmark")
    save(spark.createDataFrame([], "doc_id long, quality int, toxic int"), path, "labels")
    return path


@pytest.mark.parametrize("name", ["op11_resample", "op12_minhash", "op13_filter_audit"])
def test_empty_tables(spark, nothing, name):
    assert QUERIES[name](spark, nothing).count() == 0


# ---- 11 resampling

def brute_features(text, n=3):
    ws = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    grams = [" ".join(ws[i:i + k]) for k in range(1, n + 1) for i in range(len(ws) - k + 1)]
    return len(ws), sorted(zlib.crc32(g.encode("utf-8", "surrogatepass")) % 10000 for g in grams)


ODD = ["", None, "a", "a b", "A-B c.D", "é x 你好 Z9", "x" * 200 + " y " + "z" * 70 + "!" * 9, "...", " lead and trail ", "a\0b\0\0c", "ﬀ İ ß"]


@pytest.mark.parametrize("at_once", [1 << 16, 4, 50, 1000])
def test_scanned_buckets_match_brute_force(monkeypatch, at_once):
    monkeypatch.setattr(resample, "AT_ONCE", at_once)
    rng = np.random.default_rng(0)
    texts = ODD + [prose(rng, n) for n in (5, 40, 300, 3)] + ODD
    for n in (1, 2, 3, 4):
        got = list(resample.packed_buckets(texts, n, 10000, resample.scanner(n)))
        assert len(got) == len(texts)
        for t, (words, features, packed) in zip(texts, got):
            assert (words, resample.unpack(packed).tolist()) == brute_features(t, n) and features == len(resample.unpack(packed))


def test_resample_matches_brute_force(spark, docs, folder):
    rows = docs.collect()
    features = [brute_features(r.text) for r in rows]
    source, target = np.zeros(10000), np.zeros(10000)
    for _, ids in features:
        np.add.at(source, ids, 1)
    np.add.at(target, brute_features("the of w1é w2é w3é")[1], 1)
    gain = [math.floor(1000 * math.log((t + 1) * (source.sum() + 10000) / ((s + 1) * (target.sum() + 10000)))) for s, t in zip(source, target)]
    want = []
    for r, (n_words, ids) in zip(rows, features):
        h = int(hashlib.sha256(f"42:{'' if r.doc_id is None else r.doc_id}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[i] for i in ids)
        want.append((r.doc_id, len(ids), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n_words))
    got = QUERIES["op11_resample"](spark, folder).collect()
    assert Counter(tuple(r)[:4] for r in got) == Counter(w[:4] for w in want)
    eligible = sorted((w for w in want if w[4] >= 20), key=lambda w: (-w[3], w[0] is None, w[0] or 0, -w[2], -w[1]))
    half = resample.resample(with_clashes(docs), "doc_id", "text", spark.read.parquet(f"{folder}/benchmark.parquet"), "text", percent=50)
    for out, percent in ((got, 5), (half.collect(), 50)):
        drawn = eligible[: percent * len(eligible) // 100]
        assert [(r["doc_id"], r["score"]) for r in sorted((r for r in out if r["rank"]), key=lambda r: r["rank"])] == [(w[0], w[3]) for w in drawn]


def test_ranks_of_equal_rows_are_gapless(spark):
    """A third of the rows ties throughout; every rank is given once."""
    rows = [(1, 7)] * 400 + [(i, i % 90) for i in range(2, 800)]
    df = spark.createDataFrame(rows, "doc_id long, score long").select("*", F.lit(30).alias("n_words"), F.lit(1).alias("n_features"), F.lit(1).alias("weight"))
    out = resample._ranked(df.repartition(6), "doc_id", F.col("n_words") >= 20, 1000).collect()
    ranked = sorted((r for r in out if r["rank"]), key=lambda r: r["rank"])
    assert [r["rank"] for r in ranked] == list(range(1, 1001)) and len(out) == len(rows)
    assert [r.score for r in ranked] == sorted((s for _, s in rows), reverse=True)[:1000]


# ---- 12 MinHash

def brute_groups(rows, percent=85, width=5):
    """rows: (key, text); (key, shingles, component, kept) of each."""
    sets = []
    for _, t in rows:
        ws = WORD.findall((t or "").translate(LOWER))
        sets.append({tuple(ws[i:i + width]) for i in range(max(1, len(ws) - width + 1))} if ws else set())
    label = list(range(len(rows)))
    for i, j in itertools.combinations(range(len(rows)), 2):
        both = len(sets[i] & sets[j])
        if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
            a, b = label[i], label[j]
            label = [min(a, b) if x in (a, b) else x for x in label]
    least = {}
    for (k, _), x in zip(rows, label):
        if k is not None:
            least[x] = min(least.get(x, k), k)
    return Counter((k, len(s), least.get(x), k == least.get(x)) for (k, _), s, x in zip(rows, sets, label))


def test_minhash_query_matches_brute_force(spark, docs, folder):
    got = QUERIES["op12_minhash"](spark, folder).collect()
    assert Counter(tuple(r) for r in got) == brute_groups([(r.doc_id, r.text) for r in docs.collect()])


@pytest.mark.parametrize(("turns", "block"), [(2, 2048), (0, 512), (0, 8), (1, 3)])
def test_groups_near_the_threshold(spark, turns, block):
    """Copies with few changed words (similarities on both sides of 0.85), a common passage, sets of one to forty shingles."""
    rng = np.random.default_rng(turns * 10 + block)
    passage, texts = prose(rng, 25), []
    for n in (3, 9, 11, 12, 20, 40, 44, 120):
        base = prose(rng, n).split()
        for _ in range(9):
            ws = list(base)
            for _ in range(int(rng.integers(0, max(2, n // 20)))):
                ws[int(rng.integers(0, n))] = f"x{rng.integers(0, 9)}"
            texts.append(" ".join(ws[: n - int(rng.integers(0, 2))]))
            texts.append(f"{prose(rng, 8)} {passage}")
    texts += [texts[0].upper(), texts[3].replace(" ", "\n"), None, "", "\t", texts[5], texts[5]]
    rows = [(int(k), t) for k, t in zip(rng.permutation(len(texts)), texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = minhash.near_duplicates(with_clashes(df), "doc_id", "text", turns=turns, block=block).collect()
    assert Counter(tuple(r) for r in got) == brute_groups(rows)


@pytest.mark.parametrize("size", [6, 7, 10, 30, 48, 110, 240, 700, 3000])
def test_linked_sets_share_a_key_and_pass_the_estimate(size):
    rng = np.random.default_rng(size)
    sizes = minhash.Sizes(85)
    for _ in range(40):
        union = rng.integers(0, 2**63, math.ceil(size / 0.85)).astype(np.uint64)
        common = math.ceil(0.85 * len(union))
        cut = common + int(rng.integers(0, len(union) - common + 1))
        one, other = np.unique(union[:cut]), np.unique(np.concatenate([union[:common], union[cut:]]))
        assert set(minhash.band_keys(one, sizes)) & set(minhash.band_keys(other, sizes))
        for c in set(sizes.of(len(one))) & set(sizes.of(len(other))):
            x, y = (minhash.registers(s, sizes.bands[c]) for s in (one, other))
            assert minhash.likely(x[None], y[None], np.array([len(one)]), 85)[0]


def test_registers_keep_zeros_and_mantissa():
    values = np.array([1 << 52, (1 << 52) + (1 << 51), 1, 0, (1 << 40) + (1 << 39)], np.uint64)
    seen = []
    for v in values:
        s = np.array([v], np.uint64)
        original = minhash._mix
        minhash._mix = lambda x, v=v: np.array([int(v) << 11], np.uint64)
        try:
            seen.append(int(minhash.registers(s, 1).max()))
        finally:
            minhash._mix = original
    assert seen == [1 << 10, 1 << 10 | 1 << 9, 53 << 10, 54 << 10, 13 << 10 | 1 << 9]


def test_collision_rate_is_that_of_disjoint_sets():
    rng = np.random.default_rng(2)
    m, equal, both = 12 * minhash.ROWS, 0, 0
    for _ in range(300):
        x, y = (minhash.registers(rng.integers(0, 2**63, n).astype(np.uint64), 12) & ~np.uint16(1023 & ~960) for n in (400, 300))
        both += int(((x > 0) & (y > 0)).sum())
        equal += int(((x == y) & (x > 0)).sum())
    # With 4 mantissa bits left (registers masked), 64 times as many collide as with 10.
    want = 64 * minhash.collision_rate(np.array([400.0]), np.array([300.0]), m)[0]
    assert equal / both == pytest.approx(want, rel=0.2)


def test_many_near_copies_and_hot_classes(spark):
    """Near copies of one text and copies of another hold a third of the rows each."""
    rng = np.random.default_rng(4)
    base = prose(rng, 200).split()
    rows = []
    for i in range(120):
        ws = list(base)
        ws[i] = f"q{i}"
        rows += [(3 * i, " ".join(ws)), (3 * i + 1, "one text for all"), (3 * i + 2, prose(rng, 30))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(df, "doc_id", "text", block=16).collect()}
    assert got == {k: k % 3 if k % 3 < 2 else k for k, _ in rows}


def test_join_classes_gives_each_row_its_class(spark):
    rows = spark.createDataFrame([(i, i % 5000 if i % 3 else -1) for i in range(9000)], "r long, c long")
    classes = rows.groupBy("c").agg(F.count("*").alias("copies")).withColumn("name", F.concat(F.lit("n"), "c"))
    out = join_classes(rows, classes, "c", "copies").collect()
    assert Counter((r.r, r.name) for r in out) == Counter((i, f"n{i % 5000 if i % 3 else -1}") for i in range(9000))


# ---- 13 filter audit

def brute_fails(rows):
    least = {}
    for r in rows:
        if r.doc_id is not None:
            least[r.text or ""] = min(least.get(r.text or "", r.doc_id), r.doc_id)
    for r in rows:
        t = r.text or ""
        ws = WORD.findall(t)
        yield {x for x, failed in {
            "A": len(ws) < 100, "B": 100 * len(set(ws)) < 80 * len(ws), "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
            "D": bool(re.search(r"[#$%&*|]", t)), "E": r.doc_id is not None and least[t] < r.doc_id}.items() if failed}


def test_audit_matches_brute_force(spark, docs, folder):
    rows = docs.collect()
    good, toxic = {0, 9}, {3, 9, 12}
    want = Counter()
    for r, fails in zip(rows, brute_fails(rows)):
        part = r.lang or ""
        for order in itertools.permutations("ABCDE"):
            gone = False
            for step, x in enumerate(order, 1):
                at = (part, "".join(order), step)
                want[at, "kept"] += not gone and x not in fails
                want[at, "removed"] += x in fails and not gone
                want[at, "redundant"] += x in fails and gone
                want[at, "unique_fails"] += fails == {x}
                want[at, "good_lost"] += x in fails and not gone and r.doc_id in good
                want[at, "toxic_lost"] += x in fails and not gone and r.doc_id in toxic
                want[part, x] += x in fails and not gone
                gone = gone or x in fails
    out = QUERIES["op13_filter_audit"](spark, folder).collect()
    assert len(out) == 600 * len({r.lang or "" for r in rows})
    for r in out:
        at = (r.part, r.filter_order, r.step)
        for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"):
            assert r[c] == want[at, c]
        assert r.shapley == want[r.part, r.filter_order[r.step - 1]]


def test_duplicate_keys_of_hot_and_null_texts(spark):
    rows = [(i, None if i % 2 else "") for i in range(200)] + [(5, "x"), (5, "x"), (None, "x"), (None, "x"), (7, "x"), (1, "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("lang", F.lit(None).cast("string"))
    failed = filter_audit.failures(df.repartition(4), "doc_id", "text", "lang", {"A": F.length("text") > 5}, "E")
    by_key = Counter()
    for r in failed.where("bits != 0").collect():
        by_key[r.key] += r.n
    assert by_key == Counter({**{i: 1 for i in range(1, 200)}, 7: 2})
    assert failed.agg({"n": "sum"}).first()[0] == len(rows)
    assert filter_audit.letters(audited_filters(), "E") == list("ABCDE")


# ---- same results on every run

def test_scores_do_not_depend_on_the_hash_seed(tmp_path):
    import os
    import subprocess
    import sys

    code = ("import sys; sys.path.insert(0, %r)\n"
            "import numpy as np\n"
            "from runlens.llm.linear import Scorer\n"
            "from runlens.llm.toxicity import HASH_BITS, distinct_words, ngrams\n"
            "w = np.random.default_rng(0).normal(size=1 << HASH_BITS).astype(np.float32)\n"
            "texts = [' '.join(f'wort{(i * j) %% 97}' for i in range(60)) for j in range(1, 30)]\n"
            "print(Scorer(w, 0.1, ngrams).scores(texts, distinct_words).tobytes().hex() if hasattr(Scorer(w, 0.1, ngrams).scores(texts, distinct_words), 'tobytes')"
            " else list(Scorer(w, 0.1, ngrams).scores(texts, distinct_words)))") % os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    seen = {subprocess.run([sys.executable, "-c", code], env={**os.environ, "PYTHONHASHSEED": s}, capture_output=True, text=True, check=True).stdout for s in ("1", "2")}
    assert len(seen) == 1 and seen.pop().strip()


def test_mixing_of_null_and_equal_keys_is_the_same_on_every_run(spark):
    from runlens.llm import mixing

    rng = np.random.default_rng(8)
    rows = [(None if i % 3 == 0 else i % 5, prose(rng, int(rng.integers(3, 8))), f"s{i % 2}") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = [Counter(tuple(r) for r in mixing.mix(df.repartition(n), "doc_id", "text", "source").select("doc_id", "text", "source", "copies").collect()) for n in (1, 5)]
    assert kept[0] == kept[1] and len({c for *_, c in kept[0]}) > 1


def test_op12_only_sets_of_open_groups_are_shuffled(spark):
    """Members of key groups of one component send no set through the shuffle of the comparison."""
    from runlens.llm import minhash as mh

    sizes = mh.Sizes(85)
    docs = {i: " ".join(f"w{i}-{j}" for j in range(40)) for i in range(6)}
    ids = {i: bytes([i]) for i in docs}
    made = [(ids[i], len(s), s.tobytes(), [(c, mh.registers(s, sizes.bands[c]).tobytes()) for c in sizes.of(len(s))])
            for i, s in ((i, mh.shingle_set(t, 5)) for i, t in docs.items())]
    sets = spark.createDataFrame(made, "id binary, n long, shingles binary, sketches array<struct<size_class:int,registers:binary>>")
    bucket = sizes.of(36)[0]
    rows = spark.createDataFrame([(bucket, ids[0], 36, b"a"), (bucket, ids[1], 36, b"b"), (bucket + 1024, ids[0], 36, b"a"),
                                  (bucket + 1024, ids[2], 36, b"a"), (bucket + 2048, ids[3], 36, b"c")], "bucket long, id binary, n long, label binary")
    cells = mh._cells(rows, sets, 2048, "shingles")
    assert sorted((bytes(r["id"]), bytes(r["shingles"])) for r in cells.collect()) == [(ids[i], made[i][2]) for i in (0, 1)]
    plan = cells._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan
    assert sorted(bytes(r["id"]) for r in mh.wanted_sets(sets, rows.select("id")).collect()) == [ids[i] for i in range(4)]
