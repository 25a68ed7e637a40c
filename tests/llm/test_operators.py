"""Operators against brute force on small tables with awkward rows."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from runlens.llm import decontaminate, html_extract, linear, mixing, quality_rules, sharding, simhash, substring_dedup, token_files
from runlens.llm import toxicity, weak_quality
from runlens.llm.queries import GROWN, SHARDS, QUERIES
from tests.llm.fixtures import DOCS, awkward_docs, rows, save, with_clashes

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def docs(spark):
    return awkward_docs(spark).cache()


@pytest.fixture(scope="module")
def folder(spark, docs, tmp_path_factory):
    where = str(tmp_path_factory.mktemp("sf"))
    save(with_clashes(docs), where, "documents")
    save(spark.createDataFrame([(1, "x y z"), (2, None), (None, "some words that are long enough to count as an item")],
                               "item_id long, text string"), where, "benchmark")
    save(spark.createDataFrame([(i, i % 2, int(i % 3 == 0)) for i in range(0, 25, 2)] + [(None, 1, 1), (4, None, None)],
                               "doc_id long, quality int, toxic int"), where, "labels")
    save(spark.createDataFrame([(1, "http://a.b/c", "<p>x</p>"), (2, None, None), (None, "", "")],
                               "page_id long, url string, html string"), where, "pages")
    return where


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    where = str(tmp_path_factory.mktemp("empty"))
    for table, schema in (("documents", DOCS), ("benchmark", "item_id long, text string"),
                          ("labels", "doc_id long, quality int, toxic int"), ("pages", "page_id long, url string, html string")):
        save(spark.createDataFrame([], schema), where, table)
    return where


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"op13_filter_audit"}))
def test_awkward_rows_give_one_row_each(spark, folder, docs, name):
    out = QUERIES[name](spark, folder)
    assert out.count() == (3 if name.startswith("op10_") else docs.count())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables(spark, empty, name):
    assert QUERIES[name](spark, empty).count() == 0


# ---- 1 sharding

def test_sharding_law_and_slots(spark, docs):
    out = sharding.assign_shards(with_clashes(docs), "doc_id", SHARDS, GROWN).collect()
    assert len(out) == docs.count()
    by_key = defaultdict(set)
    for r in out:
        by_key[r.doc_id].add(r.shard)
        assert r.grown_shard in (r.shard, 16)
    assert all(len(s) == 1 for s in by_key.values())
    for s in range(16):
        own = sorted(r.slot for r in out if r.shard == s)
        assert own == list(range(len(own)))


def test_sharding_is_rendezvous(spark):
    out = spark.range(400).withColumn("s", sharding.rendezvous(sharding.F.col("id"), {0: 1.0, 1: 3.0})).collect()

    def best(key):
        def score(s, w):
            u = (int(hashlib.md5(f"{key}/{s}".encode()).hexdigest()[:13], 16) + 0.5) / 16**13
            return -math.log(u) / w, s
        return min(score(0, 1.0), score(1, 3.0))[1]

    assert all(r.s == best(r.id) for r in out)
    assert 0.65 < sum(r.s for r in out) / 400 < 0.85
    with pytest.raises(ValueError):
        sharding.rendezvous(sharding.F.col("id"), {})


# ---- 2 token files

def test_token_files_are_the_ids_in_order(spark, docs, folder):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    found = {(r.doc_id, r.start): r for r in QUERIES["op2_token_files"](spark, folder).collect()}
    spans = sorted((r.start, r.n_tokens) for r in found.values())
    assert [s for s, _ in spans] == [sum(n for _, n in spans[:i]) for i in range(len(spans))]
    ids = [k for k, _ in sorted(found, key=lambda k: k[1])]
    assert ids == sorted(ids, key=lambda k: (k is not None, k or 0))
    expected = Counter()
    for r in docs.collect():
        own = t.encode(r.text or "", add_special_tokens=False).ids + [2]
        expected[(r.doc_id, len(own), zlib.crc32(np.array(own, "<u4").tobytes()))] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in found.values()) == expected


def test_token_files_of_several_parts(spark, docs):
    where = token_files.token_folder(spark)
    files = token_files.write_tokens(docs, "doc_id", "text", where, public_tokenizers.path("byte_bpe_50k.json"), 2, file_bytes=4000)
    assert files.count() > 3
    out = token_files.read_documents(files, where).collect()
    starts = sorted((r.start, r.n_tokens) for r in out)
    assert all(a + n == b for (a, n), (b, _) in itertools.pairwise(starts)) and len(out) == docs.count()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300), max_size=1500), max_size=5))
def test_direct_access(parts):
    ids = np.array([x for p in parts for x in p], np.uint32)
    f = token_files.TokenFile(token_files.to_bytes(list(range(len(parts))), np.array([len(p) for p in parts], np.int64), ids))
    assert f.tokens(0, len(ids)).tolist() == ids.tolist()
    for k, p in enumerate(parts):
        assert f.document(k).tolist() == p
    for i in range(0, len(ids), 97):
        assert f.token(i) == ids[i]
        assert f.tokens(i, min(i + 5, len(ids))).tolist() == ids[i:i + 5].tolist()


@settings(max_examples=150, deadline=None)
@given(st.text(st.sampled_from("aZé9 \n\t'!.sñt…— \x1c你²ª") | st.characters(codec="utf-8"), max_size=40))
def test_pieces_encode_like_the_whole(text):
    e = _encoder()
    assert np.frombuffer(e.ids(text), "<u4").tolist() == e.tokenizer.encode(text, add_special_tokens=False).ids


_HELD = []


def _encoder():
    if not _HELD:
        _HELD.append(token_files.Encoder(public_tokenizers.path("byte_bpe_50k.json")))
    return _HELD[0]


# ---- 3 substring dedup

def brute_repeats(texts, width):
    """texts: (place, text); the kept words of each."""
    split = [WORD.findall(t or "") for _, t in texts]
    first, seen = {}, []
    for (place, _), ws in zip(texts, split):
        for i in range(len(ws) - width + 1):
            win = tuple(ws[i:i + width])
            first[win] = min(first.get(win, place), place)
    for (place, _), ws in zip(texts, split):
        own, gone = set(), [False] * len(ws)
        for i in range(len(ws) - width + 1):
            win = tuple(ws[i:i + width])
            if first[win] < place or win in own:
                gone[i:i + width] = [True] * width
            own.add(win)
        seen.append([w for w, g in zip(ws, gone) if not g])
    return seen


@pytest.mark.parametrize(("width", "gram", "vocabulary"), [(20, 5, 40), (6, 2, 2), (6, 3, 3), (4, 4, 2), (20, 5, 1)])
def test_repeats_match_brute_force(spark, width, gram, vocabulary):
    rng = np.random.default_rng(width * 10 + vocabulary)
    texts = []
    for i in range(60):
        ws = [f"v{x}" for x in rng.integers(0, vocabulary, rng.integers(0, 60))]
        if i > 5 and i % 3 == 0:  # passages of earlier texts, cut at random
            src = texts[rng.integers(0, i)][1].split()
            lo = rng.integers(0, max(1, len(src)))
            ws = ws[:10] + src[lo:lo + 45] + ws[10:20]
        texts.append((int(rng.permutation(1000)[0]) * 100 + i, " ".join(ws)))
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(4)
    out = {r.doc_id: r for r in substring_dedup.remove_repeats(df, "doc_id", "text", width, gram).collect()}
    for (place, text), kept in zip(texts, brute_repeats(texts, width)):
        r = out[place]
        assert r.kept_text == " ".join(kept) and r.n_removed == r.n_words - len(kept)
        assert sum(x["end"] - x["start"] for x in r.removed) == r.n_removed
        assert all(a["end"] < b["start"] for a, b in itertools.pairwise(r.removed))


def test_repeats_awkward_rows(spark, docs):
    got = Counter((r.doc_id, r.n_words, r.kept_text) for r in substring_dedup.remove_repeats(with_clashes(docs), "doc_id", "text").collect())
    texts = [(r.doc_id if r.doc_id is not None else substring_dedup.LAST, r.text) for r in docs.collect()]
    want = Counter((None if p == substring_dedup.LAST else p, len(WORD.findall(t or "")), " ".join(k))
                   for (p, t), k in zip(texts, brute_repeats(texts, 20)))
    assert got == want


# ---- 4 quality rules

def test_quality_counts_match_brute_force(spark, docs):
    out = quality_rules.apply_rules(with_clashes(docs), "text").collect()
    assert len(out) == docs.count()
    for r in out:
        t = r.text or ""
        ws = WORD.findall(t)
        lines = [x for x in t.split("\n") if WORD.search(x)]
        grams = [tuple(ws[i:i + 3]) for i in range(len(ws) - 2)]
        often = Counter(grams)
        covered = {i + j for i, g in enumerate(grams) if often[g] > 1 for j in range(3)}
        assert (r.n_words, r.word_chars, r.n_symbols) == (len(ws), sum(map(len, ws)), sum(c in "#*$%&|<>" for c in t))
        assert (r.n_dup_lines, r.n_repeat_words) == (len(lines) - len(set(lines)), len(covered))
        failed = len(ws) < 50 or 100 * len(covered) > 50 * len(ws)
        oks = [r[f"ok_{x.name}"] for x in quality_rules.RULES]
        assert r.base_failed == failed and r.kept == (not failed and all(oks))


# ---- 6 decontamination

def brute_edits(item, text):
    """Fewest edits of the whole item against any part of the text."""
    cost = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(cost[j] + 1, new[-1] + 1, cost[j - 1] + (c != d)))
        cost = new
    return min(cost)


@settings(max_examples=60, deadline=None)
@given(st.data())
def test_filter_and_alignment_lose_nothing(data):
    rng = np.random.default_rng(data.draw(st.integers(0, 10**6)))
    letters = list("abcd é"[: data.draw(st.integers(2, 6))])
    item = decontaminate.normalise("".join(rng.choice(letters, 90)))
    text = list("".join(rng.choice(letters, 60)) + item + "".join(rng.choice(letters, 60)))
    for _ in range(data.draw(st.integers(0, 7))):
        at = int(rng.integers(0, len(text)))
        kind = rng.integers(0, 3)
        text[at:at + (kind != 0)] = [] if kind == 1 else [str(rng.choice(letters))]
    text = decontaminate.normalise("".join(text))
    index = decontaminate.ItemIndex([(5, item)], 0.06, 10)
    if not index.ids:
        return
    found = index.matches(text)
    edits = brute_edits(item, text)
    assert (edits <= index.k[0]) == bool(found)
    if found:
        _, start, end, got = found[0]
        assert got == edits == brute_edits_whole(item, text[start:end])


def brute_edits_whole(a, b):
    cost = list(range(len(b) + 1))
    for i, c in enumerate(a, 1):
        new = [i]
        for j, d in enumerate(b, 1):
            new.append(min(cost[j] + 1, new[-1] + 1, cost[j - 1] + (c != d)))
        cost = new
    return cost[-1]


def test_decontamination_cases(spark):
    item = "That and onesen erblest it hein ti inenan eranenes whou therouou thon the."
    bench = spark.createDataFrame([(7, item), (3, item), (1, "short"), (2, None), (None, "x" * 40)], "item_id long, text string")
    texts = [f"before {item.upper()} after", "b " + item.replace(" ", "\n  ") + " a", item[:40] + "X" + item[41:], item[:60], None, "",
             "y " * 5000 + item, "x" * 40, "nothing like it"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for block in (10**6, 20):  # one block of items, or several
        out = {r.doc_id: r for r in decontaminate.find_matches(with_clashes(df), "text", bench, block_chars=block).collect()}
        assert {d: sorted((m["item_id"] is not None, m["item_id"] or 0) for m in r.matches) for d, r in out.items() if r.contaminated} == {
            0: [(True, 3), (True, 7)], 1: [(True, 3), (True, 7)], 2: [(True, 3), (True, 7)], 6: [(True, 3), (True, 7)], 7: [(False, 0)]}
        assert out[2].matches[0]["edits"] == 1


def test_short_items_match_verbatim(spark):
    bench = spark.createDataFrame([(1, "What is the capital of France?"), (2, "Pi is"), (3, ""), (4, "é")], "item_id long, text string")
    texts = ["Asked: what is the\nCAPITAL of France? Paris.", "What is the capital of Frence?", "the api is and pi island", "so pi is", "É", "pi is"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = {r.doc_id: [tuple(m) for m in r.matches] for r in decontaminate.find_matches(df, "text", bench).collect()}
    assert out == {0: [(1, 7, 37, 0)], 1: [], 2: [], 3: [(2, 3, 8, 0)], 4: [(4, 0, 1, 0)], 5: [(2, 0, 5, 0)]}


def test_every_occurrence_is_reported():
    item = "That and onesen erblest it hein ti inenan eranenes whou therouou thon the."
    index = decontaminate.ItemIndex([(7, item), (8, "ab cd")], 0.05, 32)
    n, changed = len(item), item[:40].lower() + "#" + item[41:].lower()
    text = f"{changed} ab cd {item} {item}ab cd"
    found = index.matches(text)
    assert found == [(7, n + 7, 2 * n + 7, 0), (7, 2 * n + 8, 3 * n + 8, 0), (7, 0, n, 1), (8, n + 1, n + 6, 0), (8, 3 * n + 8, 3 * n + 13, 0)]


# ---- 7 SimHash

def brute_fingerprint(text):
    ws = [w.translate({c: c + 32 for c in range(65, 91)}) for w in WORD.findall(text or "")]
    sh = [" ".join(ws[i:i + 3]) for i in range(len(ws) - 2)] if len(ws) >= 3 else ([" ".join(ws)] if ws else [])
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(fps, max_bits=3):
    label = list(range(len(fps)))
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= max_bits:
                a, b = label[i], label[j]
                label = [min(a, b) if x in (a, b) else x for x in label]
    return label


def test_simhash_query_matches_brute_force(spark, docs, folder):
    own = docs.collect()
    fps = [brute_fingerprint(r.text) for r in own]
    label = brute_components(fps)
    least = {}
    for r, x in zip(own, label):
        if r.doc_id is not None:
            least[x] = min(least.get(x, r.doc_id), r.doc_id)
    want = Counter((r.doc_id, f"{f:016x}", least.get(x)) for r, f, x in zip(own, fps, label))
    got = QUERIES["op7_simhash"](spark, folder)
    assert Counter((r.doc_id, r.fingerprint, r.component_id) for r in got.collect()) == want


@pytest.mark.parametrize("bucket_rows", [4096, 16])
def test_links_connect_what_is_linked(spark, bucket_rows):
    rng = np.random.default_rng(3)
    fps = {int(x) for x in rng.integers(0, 2**63, 40)}
    for c in list(fps)[:6]:  # balls of near fingerprints: the small bucket size has to refine them
        for _ in range(60):
            f = c
            for b in rng.integers(0, 63, rng.integers(1, 5)):
                f ^= 1 << int(b)
            fps.add(f)
    fps = sorted(fps)
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    edges = simhash.links(df, 3, bucket_rows)
    assert all((r.a ^ r.b).bit_count() <= 3 for r in edges.collect())
    got = {r.v: r.label for r in simhash.components(edges).collect()}
    label = brute_components(fps)
    want = {f: fps[x] for f, x in zip(fps, label)}
    assert all(got.get(f, f) == want[f] for f in fps)


def test_components_of_long_chains(spark):
    order = np.random.default_rng(0).permutation(300).tolist()
    df = spark.createDataFrame([(a, b) for a, b in itertools.pairwise(order)], "a long, b long")
    assert {r.label for r in simhash.components(df).collect()} == {0}


def test_keep_one_of_each_group(spark, docs):
    own = docs.collect()
    label = brute_components([brute_fingerprint(r.text) for r in own])
    kept = simhash.keep_one(with_clashes(docs), "doc_id", "text").collect()
    assert len(kept) == len(set(label))
    groups = defaultdict(list)
    for r, x in zip(own, label):
        groups[x].append(r.doc_id)
    want = Counter(min(g, key=lambda k: (k is None, k or 0)) for g in groups.values())
    assert Counter(r.doc_id for r in kept) == want


# ---- 8 mixing

def brute_targets(sizes, weights=(5, 2, 1)):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    capped, total = set(), 1.5 * sum(sizes.values())
    while True:
        rest = total - sum(2 * sizes[s] for s in capped)
        open_w = sum(w[s] for s in names if s not in capped)
        new = {s for s in names if s not in capped and rest * w[s] / open_w > 2 * sizes[s]}
        if not new:
            return {s: 2 * sizes[s] if s in capped else rest * w[s] / open_w for s in names}
        capped |= new


@pytest.mark.parametrize("seed", range(3))
def test_mixing(spark, seed):
    rng = np.random.default_rng(seed)
    names = [None, "", "a", "B", "é", "\U00010000", "￿", "z"][: 3 + 2 * seed + 1]
    table = [(i, " ".join(["w"] * int(rng.lognormal(3, 1))), names[int(rng.integers(0, len(names)) ** 2 / len(names))]) for i in range(500)]
    df = spark.createDataFrame(table, "doc_id long, text string, source string").repartition(5)
    out = mixing.mix(with_clashes(df), "doc_id", "text", "source").collect()
    again = mixing.mix(df.repartition(2), "doc_id", "text", "source").collect()
    assert {r.doc_id: r.copies for r in out} == {r.doc_id: r.copies for r in again}
    sizes, taken = Counter(), Counter()
    for r in out:
        sizes[r.source] += r.size
        taken[r.source] += r.size * r.copies
        assert 0 <= r.copies <= 2 and r.size == len(WORD.findall(r.text or ""))
    want = brute_targets(sizes)
    for r in out:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        # The rate is exponential in the size, up to the cap, with one multiplier for the source.
    for s in sizes:
        # What is left is smaller than the smallest words that could still be moved, or the documents allow no better.
        assert abs(taken[s] - want[s]) <= max(3, 0.02 * want[s])
        tilts = {round(math.log(r.rate) / r.size, 9) for r in out if r.source == s and r.size and r.rate < 2}
        assert len(tilts) <= 1 or max(tilts) - min(tilts) < 1e-6
        got = sum(r.rate * r.size for r in out if r.source == s)
        assert got == pytest.approx(want[s], rel=1e-6)


def test_mixing_awkward_rows(spark, docs):
    out = mixing.mix(docs, "doc_id", "text", "source")
    assert out.count() == docs.count()
    repeated = mixing.repeat_copies(out, ["doc_id", "text"])
    assert repeated.count() == out.agg({"copies": "sum"}).first()[0]


# ---- 5, 9 classifiers

def test_toxicity_learns_marked_words(spark):
    rng = np.random.default_rng(5)
    common = [f"wort{i}" for i in range(200)]
    texts, labels = [], []
    for i in range(600):
        ws = list(rng.choice(common, 40))
        toxic = int(i % 7 == 0)
        if toxic:
            ws.insert(10, str(rng.choice(["grobian", "Grobiane", "grobianes"])))
        texts.append((i, " ".join(ws)))
        labels.append((i, toxic))
    df = spark.createDataFrame(texts + [(700, None), (701, "")], "doc_id long, text string")
    lab = spark.createDataFrame(labels + [(702, 1), (3, None)], "doc_id long, toxic int")
    out = {r.doc_id: r for r in toxicity.classify(df, "doc_id", "text", lab, "toxic", lambda k: k % 5 != 0).collect()}
    held = [(r.predicted, dict(labels)[d]) for d, r in out.items() if d % 5 == 0 and d < 600]
    assert np.mean([a == b for a, b in held]) > 0.97
    assert out[700].score == out[701].score and 0 <= out[700].score <= 1
    nothing = toxicity.classify(df, "doc_id", "text", lab.limit(0), "toxic", lambda k: k % 5 != 0).collect()
    assert {r.score for r in nothing} == {0.5}


def test_em_finds_accuracies():
    rng = np.random.default_rng(1)
    y = rng.random(20000) < 0.7
    right = [0.95, 0.8, 0.6, 0.9]
    votes = np.stack([np.where(rng.random(len(y)) < a, y, ~y) for a in right], 1).astype(int)
    votes[rng.random(votes.shape) < 0.2] = weak_quality.ABSTAIN
    patterns, at, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    prior, table, posterior = weak_quality.em(patterns, counts.astype(float))
    assert prior == pytest.approx(0.7, abs=0.03)
    for k, a in enumerate(right):
        assert table[k, 1, 2] / table[k, 1, 1:].sum() == pytest.approx(a, abs=0.04)
    assert np.mean((posterior[at.reshape(-1)] > 0.5) == y) > 0.93


def test_weak_quality_on_labelled_documents(spark):
    sf = "/root/testdata/sf0.01"
    out = QUERIES["op9_weak_quality"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    good = [r.kept for r in out if r.quality == 1]
    assert np.mean(good) > 0.97
    assert np.mean([not r.kept for r in out if r.quality == 0]) > 0.7


@pytest.mark.parametrize("module", [toxicity, weak_quality])
def test_long_documents_do_not_empty_the_sample(spark, monkeypatch, module):
    seen = []
    monkeypatch.setattr(module, "SAMPLE_WORDS", 2000)
    monkeypatch.setattr(module, "DOCUMENT_WORDS", 100, raising=False)
    monkeypatch.setattr(module, "train", lambda sample, labels, weights, **_: seen.append((list(sample.lengths), list(labels))))
    texts = [(i, " ".join(f"w{i}n{j}" for j in range(1500 if i < 3 else 20)), int(i < 3)) for i in range(12)]
    if module is toxicity:
        toxicity.fit(spark.createDataFrame(texts, "key long, words string, label int"))
    else:
        df = spark.createDataFrame(texts, "key long, t string, posterior int")
        weak_quality._fit(df, "key", "t", df.selectExpr("key", "xxhash64(t) AS digest", "double(posterior) AS posterior"))
    lengths, labels = seen[0]
    assert sorted(zip(labels, lengths)) == [(0, 20)] * 9 + [(1, 100)] * 3


def test_lbfgs_reaches_the_minimum():
    a = np.diag(np.arange(1.0, 9.0))
    x = linear.lbfgs(lambda v: (0.5 * v @ a @ v - v.sum(), a @ v - 1), np.zeros(8), 100)
    assert np.allclose(x, 1 / np.arange(1.0, 9.0), atol=1e-3)


# ---- 10 HTML

PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style><script>var t="</p><b>";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href="/x">Menu</a><li>Two</ul></nav><!-- ad --><div class="ad">Buy</div>
<div role="alert">Notice</div><article><header><h1>Head &amp; line</h1></header><p><b>One<br>two<p>Three &lt;tags&gt; &#233;&nbsp;x
<aside>Side</aside><ul><li>item a<li>item <i>b</i></ul><table><tr><td>c1<td>c2</table><form>Your name <input></form>
<section id="comments"><p>Reader says</section></article><div id="sidebar_2" class="side-bar">Side</div><footer>&copy; End</footer>"""


def test_main_text_of_a_page():
    assert html_extract.main_text(PAGE) == "Head & line\nOne two\nThree <tags> é x\nitem a\nitem b\nc1\nc2"
    for odd in (None, "", "plain", "<", "<p", "</p></div>", "<div " * 50, "<div>" * 3000 + "x", "&#xD800;&bogus;", "<!-- open"):
        assert isinstance(html_extract.main_text(odd), str)
    assert html_extract.main_text("<div><p>a</div>b") == "a\nb"
    assert html_extract.main_text("<div><b><p>one</b> two</p><p>three</p></div>") == "one two\nthree"
    assert html_extract.main_text("<p>x</p><noscript><p>no</noscript> y<span class='ad'><p>no</span> z") == "x\ny\nz"
    assert html_extract.main_text("<p>a <script>var b;</script><button>no</button>c<span class='ad'>no</span></p>"
                                  "<script>d</script><style>e</style>") == "a c"
    assert html_extract.main_text("<article class='has-comments'><div class='with-sidebar'>a</div><div id='reader_comments'>no</div>"
                                  "<div class='x ad-slot'>no</div><div class='article-header'>b</div></article>") == "a\nb"


def test_style_tree_removes_what_repeats(spark):
    pages = [(i, f"http://h.example/{i}", f"<body><div class='x'>Same {'words here'}</div><div class='y{i}'><p>Text {i} of its own</p></div></body>")
             for i in range(20)]
    pages += [(99, "https://other.example/", "<body><div class='x'>Same words here</div></body>"), (98, "http://h.example/e", None),
              (97, "http://h.example/only", "<body><div class='x'>Same words here</div></body>")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    out = {r.page_id: r.text for r in html_extract.extract(with_clashes(df), "url", "html").collect()}
    assert out[3] == "Text 3 of its own" and out[99] == "Same words here" and out[98] == "" and out[97] == "Same words here"


def test_marked_parts_are_judged_by_role_and_text():
    text = html_extract.main_text
    assert text("<body><div><p>Body one</p></div><article class='advert'><p>Buy now</p></article>") == "Body one"
    assert text("<div><p>The story is told here at length</p></div><ul><li><article>Teaser</article><li><article>Second</article></ul>") == \
        "The story is told here at length"
    assert text("<article><p>Main</p></article><article class='comment'><p>Nice, and longer than what it is about</p></article>") == "Main"
    assert text("<body><form><nav>Menu</nav><label>Name</label><div><p>All of the page</p></div><select><option>x</select></form>") == "All of the page"
    assert text("<article><p>Story of the day</p><form>Your name <input></form></article>") == "Story of the day"
    assert text("<main hidden><p>Gone</p></main><div role='main'><p>Here</p></div><p>Out</p>") == "Here"
    assert text("<div>" * 20000 + "deep") == "deep" and len(text("<article>" + "<p>long text</p>" * 50000)) == 10 * 50000 - 1


def brute_extract(pages, gamma, threshold):
    """pages: (host, html); every node's importance from all distinct pages of its host, by definition."""
    parsed = {}
    for host, html in pages:
        p = html_extract.Page(html)
        kept = [b for b in p.blocks if not b[1]]
        parsed.setdefault(host, {})["\n".join(b[3] for b in [x for x in kept if x[2]] or kept or p.blocks)] = p
    out = []
    for host, html in pages:
        members = [p for p in parsed[host].values() if p.blocks]
        paths = {p[:i] for page in members for p, *_ in page.styles for i in range(1, len(p) + 1)}
        low, common = set(), set()
        for path in paths:
            holders = [m for m in members if any(p == path for p, _ in m.styles)]
            styles = Counter(c for m in holders for c in {c for p, c in m.styles if p == path})
            inside = {p for p in paths if p[:len(path)] == path}
            texts = [Counter(t for m in members for t in {t for p, _, _, t in m.blocks if p == q}) for q in inside]
            logs = [math.log(n) for c in texts for n in c.values()]
            base = math.log(len(members)) if members else 0
            if len(holders) > 1 and base > 0:
                content = 1 - sum(logs) / len(logs) / base if logs else 0.0
                if (1 - gamma) * html_extract.entropy(list(styles.values()), len(members)) + gamma * content < threshold:
                    low.add(path)
                    if len(holders) >= html_extract.COMMON_PAGES and 2 * len(holders) >= len(members):
                        common.add(path)
        blocks = [b for b in html_extract.Page(html).blocks if not b[1]]
        left = [b for b in blocks if not any(b[0][:i] in (common if b[2] else low) for i in range(1, len(b[0]) + 1))] or blocks
        size = Counter()
        for b in left:
            size[b[2]] += len(b[3]) * (2 if b[2] and {x[2] for x in left} == {0, b[2]} else 1)
        best = max(size, key=lambda k: (size[k], k > 0, -k)) if size else 0
        out.append("\n".join(b[3] for b in left if b[2] == best))
    return out


def test_style_tree_matches_brute_force_page_by_page(spark):
    rng = random.Random(11)
    pages = []
    for host, n in (("a.example", 24), ("b.example", 9), ("c.example", 3), ("d.example", 1)):
        boxes = [f"<div class='box{i}'><p>Share this on {host} {i}</p><ul class='l'><li>one<li>two</ul></div>" for i in range(4)]
        for i in range(n):
            inner = "".join(rng.sample(boxes, rng.randint(0, 2))) + boxes[3]
            own = f"<section class='s'><p>Own words {i} of {host}</p>" + ("<table class='t'><tr><td>quoted by some</table>" if i % 4 == 0 else "") + "</section>"
            tag = rng.choice(["main"] * 8 + ["article", "div"])
            pages.append((host, f"<body><div class='top'>Shop of the town</div><{tag}>{own}{inner}</{tag}>{rng.choice(boxes)}"))
    pages += [pages[0], pages[1], ("a.example", None), ("a.example", "")]
    df = spark.createDataFrame([(i, f"http://{h}/{i}", t) for i, (h, t) in enumerate(pages)], "page_id long, url string, html string").repartition(4)
    got = {r.page_id: r.text for r in html_extract.extract(df, "url", "html").collect()}
    want = brute_extract(pages, html_extract.GAMMA, html_extract.THRESHOLD)
    assert [got[i] for i in range(len(pages))] == want
    # The tree decides inside marked parts: the box that every page repeats goes from them, the table of few pages stays.
    marked = [i for i, (h, t) in enumerate(pages) if h == "a.example" and t and "<main>" in t]
    assert marked and all("on a.example 3" not in got[i] for i in marked)
    assert any("quoted by some" in got[i] for i in marked)
    assert any(got[i] != html_extract.main_text(t) for i, (_, t) in enumerate(pages))


def test_style_tree_importance(spark):
    m = 8
    df = spark.createDataFrame([("h", f"<div class='a'>same</div><div class='b'>own {i}</div>"
                                      f"<div class='c'>half {i % 4}</div>") for i in range(m)], "host string, html string")
    tree = {r.path: r for r in html_extract.style_tree(df).collect()}
    g = html_extract.GAMMA
    assert tree["div.a"].importance == pytest.approx(0, abs=1e-9)
    assert tree["div.b"].importance == pytest.approx(g)
    assert tree["div.c"].importance == pytest.approx(g * (1 - math.log(2) / math.log(m)))
    assert html_extract.entropy([m], m) == 0 and html_extract.entropy([1] * m, m) == pytest.approx(1)


def test_marked_main_part_and_copies_stay_whole(spark):
    def shop(i):
        return f"<div class='top'>Shop of the town</div><div class='x'><p>Offer {i}</p></div>"

    article = "<div class='top'>Shop of the town</div><article><p>Told here</p><table class='prices'><tr><td>7 pence</table></article>"
    guide = "<div class='guide'><p>How to</p><ul class='steps'><li>Cut<li>Bind</ul></div>"
    near = "<div class='tour'><p>Seen {}</p><ul class='stops'><li>Mill<li>Weir</ul></div>"
    news = [f"<article><p>News {i}</p></article>" for i in "ijklmn"]
    htmls = [shop(i) for i in "abcdefgh"] + [article, article, article.replace("Told", "Now told"), guide + "<p>In full</p>",
                                             f"<nav>Print</nav>{guide}<p>In full</p>", near.format("first"), near.format("again"), *news]
    df = spark.createDataFrame([(i, f"http://h.example/{i}", h) for i, h in enumerate(htmls)], "page_id long, url string, html string")
    out = {r.page_id: r.text for r in html_extract.extract(df, "url", "html").collect()}
    assert [out[i] for i in range(8)] == [f"Offer {i}" for i in "abcdefgh"]
    assert out[8] == out[9] == "Told here\n7 pence" and out[10] == "Now told here\n7 pence"
    assert out[11] == out[12] == "How to\nCut\nBind\nIn full"
    assert [out[13], out[14]] == ["Seen first\nMill\nWeir", "Seen again\nMill\nWeir"]


def test_registered_row_shape(spark, folder):
    first = rows(QUERIES["op1_sharding"](spark, folder))
    assert first == rows(QUERIES["op1_sharding"](spark, folder))


@pytest.mark.parametrize("bits", [24, 62, 2])
def test_repeated_windows_with_few_hash_or_start_bits(spark, monkeypatch, bits):
    """Colliding hashes and texts with more words than start bits give the same count."""
    monkeypatch.setattr(quality_rules, "START_BITS", bits)
    r = random.Random(bits)
    texts = [" ".join(r.choice("abcd") for _ in range(n)) for n in (0, 1, 2, 3, 4, 5, 8, 13, 40, 200)] + ["a b c " * 5, None]

    def count(text):
        w = (text or "").split()
        grams = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
        hit = {i + j for i, g in enumerate(grams) if grams.count(g) > 1 for j in range(3)}
        return len(hit)

    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {x["doc_id"]: x["n_repeat_words"] for x in quality_rules.apply_rules(df, "text").collect()}
    assert got == {i: count(t) for i, t in enumerate(texts)}
