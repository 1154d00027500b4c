import hashlib

import numpy as np
import pytest

from thermoweave.llm import orchard

SCHEMA = "vec_id long, embedding array<double>, label int, code string, error string, d string, part string, v string"


@pytest.fixture(scope="module")
def vectors(spark):
    def build(rows):
        return spark.createDataFrame([(i, v, lab, *["x"] * 5) for i, v, lab in rows], SCHEMA)

    return build


def brute(rows, parts, entries, rounds, scale):
    """Plain rounds over vectors of one length, in Python's whole numbers."""
    whole = []
    for i, v, lab in rows:
        width = -(-len(v) // parts)
        x = [int(np.floor(c * scale)) for c in v] + [0] * (width * parts - len(v))
        whole.append((i, lab, [x[p * width : (p + 1) * width] for p in range(parts)]))
    ids = sorted({w[0] for w in whole})[:entries]
    books = [[min(w[2] for w in whole if w[0] == i)[p] for i in ids] for p in range(parts)]

    def place(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            own = [(place(w[2][p], books[p])[1], w[2][p]) for w in whole]
            for k in range(len(books[p])):
                mine = [x for e, x in own if e == k]
                if mine:
                    books[p][k] = [sum(c) // len(mine) for c in zip(*mine, strict=True)]
    found = [(w[0], [place(w[2][p], books[p]) for p in range(parts)]) for w in whole]
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return sorted((i, "".join(f"{k:02x}" for _, k in f), sum(d for d, _ in f)) for i, f in found), digest


@pytest.mark.parametrize(("seed", "n", "size", "entries"), [(1, 200, 16, 16), (2, 90, 24, 5), (3, 40, 10, 16), (4, 7, 8, 16)])
def test_codes_equal_plain_rounds(vectors, seed, n, size, entries):
    chance = np.random.default_rng(seed)
    rows = [(int(i), np.round(chance.normal(size=size), 2).tolist(), int(i % 3)) for i in chance.permutation(n)]
    rows += rows[:5]  # repeated rows
    df = vectors(rows)
    got = orchard.encode(df, orchard.fit(df, entries=entries)).collect()
    want, digest = brute(rows, orchard.PARTS, entries, orchard.ROUNDS, orchard.SCALE)
    assert sorted((r.vec_id, r.code, r.error) for r in got) == want
    assert {r.codebooks_sha256 for r in got} == {digest}


def test_search_finds_the_lowest_of_equal_entries_everywhere():
    chance = np.random.default_rng(5)
    for size in (1, 2, 5):
        entries = chance.integers(-3, 4, (16, size))  # many ties and equal entries
        x = chance.integers(-5, 6, (500, size))
        at, best = orchard.Codebook.of(entries).nearest(x)
        d = ((x[:, None] - entries[None]) ** 2).sum(axis=2)
        assert (at == d.argmin(axis=1)).all() and (best == d.min(axis=1)).all()


def test_the_search_leaves_far_entries_out():
    entries = np.array([[0], [1], [100], [101], [102]])
    book = orchard.Codebook.of(entries)
    looked = []

    class Counted(np.ndarray):
        def __getitem__(self, key):
            if isinstance(key, np.ndarray) and key.dtype != bool:
                looked.extend(np.atleast_1d(key).tolist())
            return super().__getitem__(key)

    book.entries = entries.view(Counted)
    assert book.nearest(np.array([[0]]))[0].tolist() == [0]
    assert 2 not in looked and 3 not in looked and 4 not in looked


def test_odd_vectors(vectors):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, None, 1), (2, [0.0] * 8, 1), (3, [1.0, None] * 4, 1), (4, [nan] * 8, 1), (5, [inf] * 8, 1), (6, [1.0] * 8, None),
        (7, [2.0] * 8, None), (7, [2.0] * 8, None), (None, [1.0] * 8, 2), (8, [], 2), (9, [1.0, 2.0, 3.0], 2), (10, [1e300] * 8, 3),
    ]
    got = orchard.code_report(vectors(rows)).collect()
    found = {r.vec_id: r for r in got}
    assert len(got) == 8 and set(found) == {2, 6, 7, None, 8, 9, 10}
    assert found[2].error == 0 and found[8].code == "00" * 8 and found[9].error == 0
    assert found[6].label_error == found[7].label_error  # labels that are null count together
    assert found[2].codebooks_sha256 != found[9].codebooks_sha256  # a codebook for each length
    assert orchard.code_report(vectors([])).collect() == []
    assert orchard.code_report(vectors([(1, None, 1)])).collect() == []


def test_an_error_that_passes_a_long_is_null(vectors):
    rows = [(1, [0.0] * 8, 1)] + [(i, [s * 1e18] * 8, 1) for i, s in ((2, 1), (3, -1))]
    df = vectors(rows)
    got = {r.vec_id: r for r in orchard.encode(df, orchard.fit(df, entries=1)).collect()}
    assert got[2].error is None and got[3].error is None and got[1].error == 0
