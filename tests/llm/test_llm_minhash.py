import itertools
import random

import numpy as np
import pyarrow as pa

from thermoweave.llm import components as graph
from thermoweave.llm import minhash
from thermoweave.llm.common import SLICE_ROWS, sliced
from thermoweave.llm.components import components


def brute(rows, words, percent):
    sets = {}
    for i, t in rows:
        parts = (t or "").lower().split()
        sets[i] = {tuple(parts[k : k + words]) for k in range(max(len(parts) - words + 1, 1))} if parts else set()
    found = {i: i for i in sets}
    for a, b in itertools.combinations(sets, 2):
        shared = len(sets[a] & sets[b])
        if shared and 100 * shared >= percent * len(sets[a] | sets[b]):
            x, y = found[a], found[b]
            found = {k: min(x, y) if v in (x, y) else v for k, v in found.items()}
    return found


def edited(text, changes, seed):
    chance, parts = random.Random(seed), text.split()
    for _ in range(changes):
        parts[chance.randrange(len(parts))] = f"new{chance.randrange(10**6)}"
    return " ".join(parts)


def test_groups_equal_brute_force(frame, prose):
    rows = [(i, prose(i)) for i in range(10)]
    rows += [(100 + i, edited(rows[i % 3][1], 1 + i % 7, i)) for i in range(60)]  # on both sides of the limit
    for words, percent in ((3, 85), (5, 80)):
        got = {r.doc_id: r.component_id for r in minhash.near_duplicates(frame(rows), words, percent).collect()}
        assert got == brute(rows, words, percent)


def test_odd_rows(frame, odd_rows):
    got = {r.doc_id: r for r in minhash.near_duplicate_report(frame(odd_rows)).collect()}
    assert [got[i].n_shingles for i in (1, 2, 3, 4)] == [0, 0, 0, 1]
    assert got[1].kept and got[2].component_id == 2
    assert (got[6].component_id, got[6].kept) == (5, False)
    assert got[8].component_id == 7
    assert got[None].component_id is None
    kept = minhash.keep_one(frame(odd_rows))
    assert kept.columns == frame(odd_rows).columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 1, 2, 3, 4, 5, 7, 9]
    assert minhash.near_duplicate_report(frame([])).count() == 0


def test_densified_signatures_estimate_similarity():
    chance = np.random.default_rng(0)
    base = chance.integers(0, 2**63, 90, dtype=np.uint64)
    other = np.concatenate([base[:80], chance.integers(0, 2**63, 10, dtype=np.uint64)])
    signatures = minhash.one_permutation([np.unique(base), np.unique(other), base[:1]])
    assert 0.6 < (signatures[0] == signatures[1]).mean() < 0.95  # truly 0.8
    assert (signatures[2] == base[0]).all()


def test_components(spark):
    edges = [(i, i + 1) for i in range(20, 60)] + [(5, 60), (7, 8), (9, 9), (None, 3)]
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert set(got) == {*range(20, 61), 5, 7, 8, 9}
    assert {got[i] for i in range(20, 61)} == {5} and got[8] == 7 and got[9] == 9


def test_small_graphs_need_no_rounds_and_larger_ones_agree(spark, monkeypatch):
    chance = random.Random(5)
    rows = [(chance.randrange(300), chance.randrange(300)) for _ in range(250)] + [(7, 7), (None, 3), (900, None)]
    edges = spark.createDataFrame([*rows, *((k + 1000, k + 1001) for k in range(60))], "a long, b long")
    monkeypatch.setattr(graph, "FEW_EDGES", 0)
    by_rounds = {tuple(r) for r in components(edges).collect()}
    monkeypatch.undo()
    monkeypatch.setattr(graph, "_large_star", None)
    small = components(edges).collect()
    assert {tuple(r) for r in small} == by_rounds and len(small) == len(by_rounds)
    assert components(edges.limit(0)).collect() == []


def test_an_id_with_several_texts_joins_their_classes(frame, prose):
    one, two = prose(1), prose(2)
    rows = [(1, one), (2, two), (5, two), (5, one), (6, prose(3)), (7, edited(two, 1, 4))]
    got = {(r.doc_id, r.component_id) for r in minhash.near_duplicates(frame(rows)).collect()}
    assert got == {(1, 1), (2, 1), (5, 1), (6, 6), (7, 1)}


def test_a_worker_holds_slices_of_a_batch(frame, prose, monkeypatch):
    asked = []
    monkeypatch.setattr(minhash, "map_batches", lambda df, f, schema, rows=None: asked.append(rows))
    minhash.sketches(frame([(1, prose(1))]), 5, "text", "doc_id")
    assert asked == [SLICE_ROWS]
    batch = pa.RecordBatch.from_pydict({"x": list(range(2 * SLICE_ROWS + 5))})
    parts = list(sliced([batch, batch.slice(0, 0), batch.slice(7, 3)]))
    assert [p.num_rows for p in parts] == [SLICE_ROWS, SLICE_ROWS, 5, 3]
    assert [x for p in parts for x in p.column(0).to_pylist()] == [*range(2 * SLICE_ROWS + 5), 7, 8, 9]
