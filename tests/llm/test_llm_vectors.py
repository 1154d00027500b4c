import numpy as np
import pytest

from thermoweave.llm import egojoin, multiindex

SCHEMA = "vec_id long, embedding array<float>, label int, center string, level string, node string, rank string, v string"


@pytest.fixture(scope="module")
def vectors(spark):
    def build(rows):
        return spark.createDataFrame([(i, v, lab, *["x"] * 5) for i, v, lab in rows], SCHEMA)

    return build


def clustered(seed, n, size=12):
    """Vectors in tight and loose groups, some of one label, one dense group."""
    chance = np.random.default_rng(seed)
    centers = chance.normal(size=(6, size))
    out = []
    for i in range(n):
        k = i % 6
        spread = 0.002 if k == 0 else 0.05
        v = centers[k] + chance.normal(size=size) * spread * np.linalg.norm(centers[k])
        out.append((i, [float(np.float32(x)) for x in v * (1 + i % 3)], k % 2))
    return out


def brute_links(rows, least):
    ids = [r[0] for r in rows]
    u = np.array([r[1] for r in rows])
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    labels = np.array([r[2] for r in rows])
    hit = (u @ u.T >= least) & (labels[:, None] == labels[None])
    np.fill_diagonal(hit, False)
    low = np.array(ids)
    for _ in ids:
        low = np.minimum(low, np.where(hit, low[None], max(ids)).min(axis=1))
    return {i: (int(n), int(c)) for i, n, c in zip(ids, hit.sum(axis=1), low, strict=True)}


@pytest.mark.parametrize("block", [3, 40, 256])
def test_links_equal_brute_force_at_every_block_size(vectors, block):
    rows = clustered(1, 300)
    got = egojoin.linked_vectors(vectors(rows), 0.98, block=block).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == brute_links(rows, 0.98)


def of_three_lengths():
    """Vectors of 5, 6 and 12 components under shared labels, and some of a single component."""
    rows = [(3 * i + k, v, lab) for k, size in enumerate((12, 6, 5)) for i, v, lab in clustered(3 + k, 120, size)]
    return rows, [(1000 + i, [float(i - 5)], 0) for i in range(10)]


def test_every_length_links_within_itself(vectors):
    rows, single = of_three_lengths()
    got = {r.vec_id: (r.n_links, r.component_id) for r in egojoin.linked_vectors(vectors(rows + single), 0.98).collect()}
    true = {}
    for size in (12, 6, 5):
        true |= brute_links([r for r in rows if len(r[1]) == size], 0.98)
    true |= {1000 + i: (4, 1000) for i in range(5)} | {1005: (0, 1005)} | {1006 + i: (3, 1006) for i in range(4)}
    assert got == true
    few = [(1, [1.0, 2.0], 0), (2, [1.0, 2.0], 0), (3, [1.0, 2.0, 3.0], 0), (4, [1.0, 2.0, 3.0], 0), (5, [1.0, 2.0, 0.0], 0)]
    got = {r.vec_id: (r.n_links, r.component_id) for r in egojoin.linked_vectors(vectors(few)).collect()}
    assert got == {1: (1, 1), 2: (1, 1), 3: (1, 3), 4: (1, 3), 5: (0, 5)}


def test_every_length_has_neighbours(vectors):
    rows, single = of_three_lengths()
    frame = vectors(rows + single)
    got = {}
    for r in multiindex.nearest(frame, frame.where("vec_id % 20 < 3 or vec_id >= 1000"), 3).orderBy("rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    hits = total = 0
    for size in (12, 6, 5, 1):
        own = [r for r in rows + single if len(r[1]) == size and r[1][0]]
        asked = [i for i, _, _ in own if i % 20 < 3 or i >= 1000]
        for q, true in exact(own, asked, 3).items():
            assert len(got[q]) == 3 and {i for i, _ in got[q]} <= {r[0] for r in own}
            hits, total = hits + len(set(true) & set(got[q])), total + 3
    assert hits / total >= 0.9 and 1005 not in got


ODD = [
    (1, None, 1), (2, [0.0, 0.0], 1), (3, [1.0, None], 1), (4, [float("nan"), 1.0], 1), (5, [float("inf"), 1.0], 1),
    (6, [1.0, 2.0], None), (7, [1.0, 2.0], 1), (8, [2.0, 4.0], 1), (8, [2.0, 4.0], 1), (9, [1.0, 2.0], 2),
    (10, [1.0, 2.0, 3.0], 1), (11, [], 1), (None, [1.0, 2.0], 1), (100, [1.0, 2.5], 1), (200, [1.0, 2.5], 1),
]


def test_odd_vectors_link_with_nothing(vectors):
    got = {r.vec_id: r for r in egojoin.near_vector_report(vectors(ODD)).collect()}
    linked = {i: (r.n_links, r.component_id) for i, r in got.items() if r.n_links}
    assert linked == {7: (3, 7), 8: (3, 7), 100: (3, 7), 200: (3, 7)}
    assert got[9].kept and got[1].component_id == 1 and not got[None].kept
    assert egojoin.near_vector_report(vectors([])).count() == 0
    assert [r.n_links for r in egojoin.near_vector_report(vectors(ODD[:3])).collect()] == [0, 0, 0]


def exact(rows, queries, k):
    ids, v = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    out = {}
    for q in queries:
        d = np.sqrt(((v - v[ids == q][0]) ** 2).sum(axis=1))
        order = [i for i in np.lexsort((ids, d)) if ids[i] != q][:k]
        out[q] = [(int(ids[i]), float(d[i])) for i in order]
    return out


def test_nearest_recall_and_exact_scores(vectors):
    rows = clustered(2, 1500, 16)
    frame = vectors(rows)
    got = multiindex.nearest(frame, frame.where("vec_id % 50 = 0")).collect()
    true = exact(rows, range(0, 1500, 50), 10)
    scores = {(q, i): s for q, found in exact(rows, range(0, 1500, 50), 1499).items() for i, s in found}
    assert all(scores[r.query_id, r.vec_id] == r.score for r in got)
    hits = sum(r.vec_id in {i for i, _ in true[r.query_id]} for r in got)
    assert len(got) == 300 and hits / 300 >= 0.9


def test_nearest_ties_copies_and_odd_vectors(vectors):
    got = multiindex.neighbour_report(vectors(ODD)).orderBy("query_id", "rank").collect()
    rows = [(r.query_id, r["rank"], r.vec_id) for r in got]
    assert rows == [
        (100, 1, 200), (100, 2, 6), (100, 3, 7), (100, 4, 9), (100, 5, 8),
        (200, 1, 100), (200, 2, 6), (200, 3, 7), (200, 4, 9), (200, 5, 8),
    ]
    same = [(i, [1.0, 1.0], 0) for i in range(1, 401)]
    found = [(r["rank"], r.vec_id) for r in multiindex.neighbour_report(vectors(same)).where("query_id = 300").collect()]
    assert sorted(found) == [(i, i) for i in range(1, 11)]
    assert multiindex.neighbour_report(vectors([])).count() == 0
