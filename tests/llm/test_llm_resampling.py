import hashlib
import math
import re
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from thermoweave.llm import resampling

WORDS = re.compile(resampling.WORD)
UPPER = {c: c + 32 for c in range(65, 91)}


def features(text, run, buckets):
    words = WORDS.findall((text or "").translate(UPPER))
    runs = [" ".join(words[i : i + n]) for n in range(1, run + 1) for i in range(len(words) - n + 1)]
    return len(words), [zlib.crc32(f.encode()) % buckets for f in runs]


def brute(docs, target, run=1, buckets=10_000, least=20, percent=10, seed=2024):
    own = [(i, *features(t, run, buckets)) for i, t in docs]
    s, t = Counter(b for _, _, f in own for b in f), Counter(b for x in target for b in features(x, run, buckets)[1])
    gain = lambda b: math.floor(
        1000 * math.log((t[b] + 1.0) * (s.total() + buckets) / ((s[b] + 1.0) * (t.total() + buckets)))
    )
    out = []
    for i, n, f in own:
        weight = sum(map(gain, f)) // len(f) if f else 0
        score = None
        if i is not None:
            h = int(hashlib.sha256(f"{seed}:{i}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, len(f), weight, score, None, n])
    able = sorted((r for r in out if r[5] >= least and r[0] is not None), key=lambda r: (-r[3], r[0]))
    for k, r in enumerate(able[: len(able) * percent // 100], 1):
        r[4] = k
    return sorted((tuple(r[:5]) for r in out), key=str)


def found(df, rows, target, **options):
    items = df.sparkSession.createDataFrame([(k, t, "x") for k, t in enumerate(target)], "item_id long, text string, rank string")
    got = resampling.resample(df, items, **options).collect()
    return sorted((tuple(r) for r in got), key=str)


@pytest.mark.parametrize("options", [{}, {"run": 2}, {"run": 3, "buckets": 70_000, "percent": 50}, {"least": 5, "percent": 100}])
def test_equals_brute_force(frame, odd_rows, prose, options):
    rows = [*odd_rows, *[(100 + k, prose(k, 5 + 3 * k).title()) for k in range(40)], (200, "Ünï çode ÀÉ 中文 x1 don't 1.5 \x7f \x80z" * 9)]
    target = [prose(k, 60) for k in (3, 5, 7)] + [None, ""]
    named = {"least_words" if k == "least" else k: v for k, v in options.items()}
    assert found(frame(rows), rows, target, **named) == brute(rows, target, **options)


def test_empty_tables(frame, prose):
    assert found(frame([]), [], ["some text"]) == []
    rows = [(k, prose(k, 30)) for k in range(20)]
    assert found(frame(rows), rows, []) == brute(rows, [])


def test_repeated_rows_share_their_score_and_are_ranked_apart(frame, prose):
    rows = [(1, prose(1, 30))] * 30 + [(2, prose(2, 30))] * 10
    got = found(frame(rows), rows, [prose(1, 50)], percent=50)
    assert sorted(r[4] for r in got if r[4]) == list(range(1, 21)) and len({r[1:4] for r in got if r[0] == 1}) == 1


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="aB9 é.\n\x7f中", max_size=80), st.integers(1, 12), st.integers(1, 3))
def test_chunks_change_nothing(text, chunk, run):
    whole = resampling.Features(run, 1000)
    before = resampling.CHUNK
    try:
        resampling.CHUNK = chunk
        n, raw = whole(text)
    finally:
        resampling.CHUNK = before
    import numpy as np

    assert (n, sorted(np.frombuffer(raw, "<u2").tolist())) == (lambda f: (f[0], sorted(f[1])))(features(text, run, 1000))
