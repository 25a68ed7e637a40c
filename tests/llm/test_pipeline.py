"""The corpus pipeline stage by stage against brute force."""

from collections import Counter, defaultdict

import corpus_pipeline as cp
from runlens.llm.common import cut
from tests.llm.fixtures import DOCS, awkward_docs, save, with_clashes
from tests.llm.test_operators import brute_components, brute_fingerprint, brute_targets

CLEAN = ("the river of the old town and its bridge was for many years the way to the market and it is still "
         "in use by people from both sides who walk on it with their goods in the early morning").split()


def _prose(i, n=80):
    return " ".join(f"{w}{(i * 7 + j) % 13}" if j % 3 == 0 else w for j, w in ((j, CLEAN[(i * 5 + j) % len(CLEAN)]) for j in range(n)))


def test_stages_match_brute_force(spark, tmp_path):
    item = "A question of the benchmark that nobody should train on, with its answer in full."
    clean = [(100 + i, _prose(i, 60 + i), "en", f"s{i % 3}", 1) for i in range(40)]
    planted = [(200, clean[0][1], "en", "s0", 1), (201, clean[1][1].upper(), "en", "s1", 1), (202, _prose(77) + " " + item, "en", "s2", 1)]
    docs = awkward_docs(spark, [*clean, *planted, clean[2]])
    save(with_clashes(docs), str(tmp_path), "documents")
    save(spark.createDataFrame([(1, item)], "item_id long, text string"), str(tmp_path), "benchmark")
    sf, at = str(tmp_path), spark.read.parquet(f"{tmp_path}/documents.parquet")
    seen = {}
    for name, stage in cp.STAGES:
        at = cut(stage(spark, at, sf), "test-stage")
        seen[name] = at.collect()
        assert at.columns[:5] == cp.COLUMNS
    kept = seen["quality_rules"]
    assert {c[0] for c in clean} <= {r.doc_id for r in kept}
    label = brute_components([brute_fingerprint(r.text) for r in kept])
    groups = defaultdict(list)
    for r, x in zip(kept, label):
        groups[x].append(r.doc_id)
    want = Counter(min(g, key=lambda k: (k is None, k or 0)) for g in groups.values())
    assert Counter(r.doc_id for r in seen["simhash_near_dedup"]) == want
    assert not {200, 201} & set(want)
    clean_ids = [r.doc_id for r in seen["decontamination"]]
    assert Counter(clean_ids) == want - Counter([202])
    sizes, taken, reach = Counter(), Counter(), defaultdict(lambda: {0})
    for r in seen["decontamination"]:
        n = len(r.text.split())
        sizes[r.source] += n
        reach[r.source] = {x + k * n for x in reach[r.source] for k in range(3)}
    for r in seen["mixing"]:
        taken[r.source] += len(r.text.split())
    for s, t in brute_targets(sizes).items():
        # Whole copies of these documents come no nearer than the best sum of theirs.
        assert abs(taken[s] - t) <= min(abs(x - t) for x in reach[s]) + 60
    final = seen["sharding"]
    assert Counter(r.doc_id for r in final) == Counter(r.doc_id for r in seen["mixing"])
    for s in {r.shard for r in final}:
        slots = sorted(r.slot for r in final if r.shard == s)
        assert slots == list(range(len(slots)))
    assert sorted((r.doc_id, r.shard) for r in cp.run(spark, sf).collect()) == sorted((r.doc_id, r.shard) for r in final)


def test_empty_tables(spark, tmp_path):
    save(spark.createDataFrame([], DOCS), str(tmp_path), "documents")
    save(spark.createDataFrame([], "item_id long, text string"), str(tmp_path), "benchmark")
    assert cp.run(spark, str(tmp_path)).count() == 0
