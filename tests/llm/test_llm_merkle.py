import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from thermoweave.llm import merkle


def split_leaves(paragraph):
    """Leaves by hand: up to eight words, ending early with a sentence; spaces go with the word before them."""
    import re

    return re.findall(merkle.LEAF, paragraph)


def brute(text):
    """Root, fingerprint and leaf set of a text."""
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    sections, shown, known = [], [], set()
    for section in text.split("\n\n"):
        paragraphs, inner = [], []
        for paragraph in section.split("\n"):
            leaves = [sha(x) for x in split_leaves(paragraph)]
            paragraphs.append(sha(",".join(leaves)))
            short = [x[: merkle.SHORT] for x in leaves]
            inner.append(paragraphs[-1][: merkle.SHORT] + "/" + ",".join(short))
            known |= set(short)
        sections.append(sha(",".join(paragraphs)))
        shown.append(sections[-1][: merkle.SHORT] + "/" + ";".join(inner))
    root = sha(",".join(sections))
    return root, root + ":" + "|".join(shown), known


def like(a, b):
    if a[0] == b[0]:
        return 1.0
    both = len(a[2]) + len(b[2])
    return min(2 * len(a[2] & b[2]), both - 1) / max(both, 1)


def expected(rows):
    """The report of (doc_id, text) rows."""
    full = [(i, t or "") for i, t in rows]
    full.sort(key=lambda r: (r[0] is None, r[0] or 0, hashlib.sha256(r[1].encode()).digest()))
    out = []
    for (i, t), (_, n) in zip(full, full[1:] + full[:1], strict=True):
        k = len(t) // 4
        edited = t[: len(t) - k] + n[:k]
        own, new, other = brute(t), brute(edited), brute(n)
        digest = hashlib.sha256(edited.encode()).hexdigest()
        out.append((i, len(t), digest, own[1], new[1], like(own, new), like(own, other)))
    return out


def report(df):
    rows = merkle.fingerprint_report(df).collect()
    return [
        (r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, r.near_edited, r.near_next) for r in rows
    ]


def by_text(rows):
    return sorted(rows, key=str)


def test_report_equals_brute_force_on_odd_rows(frame, odd_rows, prose):
    rows = [*odd_rows, (20, prose(1, 300)), (21, "One. Two.\n\nThree!\n\n\n four  five \n"), (22, " "), (4, "another text of document 4")]
    assert by_text(report(frame(rows))) == by_text(expected(rows))


def test_repeated_rows_follow_each_other(frame):
    rows = [(1, "first text here")] * 4 + [(2, "second text there")] * 3 + [(None, "none")] * 2
    assert by_text(report(frame(rows))) == by_text(expected(rows))


def test_one_row_follows_itself_and_no_rows_give_none(frame):
    assert by_text(report(frame([(5, "alone in the table")]))) == by_text(expected([(5, "alone in the table")]))
    assert report(frame([])) == []


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab .!?\n\té", max_size=60))
def test_leaves_cover_every_character(text):
    for paragraph in text.split("\n"):
        assert "".join(split_leaves(paragraph)) == paragraph


@pytest.fixture(scope="module")
def trees(spark):
    def build(*texts):
        df = spark.createDataFrame([tuple(texts)], ", ".join(f"t{i} string" for i in range(len(texts))))
        return df.select(*[merkle.tree(F.col(c)).alias(c) for c in df.columns])

    return build


def test_edits_name_the_paragraphs_that_differ(trees):
    a = "one one.\ntwo two.\n\nthree three.\nfour four.\nfive\n\nsix"
    b = "one one.\ntwo two.\n\nthree three.\nchanged.\nfive\n\nsix six"
    df = trees(a, b, a, None)
    found = df.select(
        merkle.edits(F.col("t0"), F.col("t1")).alias("there"), merkle.edits(F.col("t1"), F.col("t0")).alias("back"),
        merkle.edits(F.col("t0"), F.col("t2")).alias("none"), merkle.edits(F.col("t3"), F.col("t3")).alias("empty"),
    ).first()
    assert [tuple(x) for x in found.there] == [(1, 1), (2, 0)]
    assert [tuple(x) for x in found.back] == [(1, 1), (2, 0)]
    assert found.none == [] and found.empty == []


def test_texts_that_differ_have_other_roots_and_stay_below_one(trees):
    pairs = [("a. b. ", "b. a. "), ("a\nb", "a\n\nb"), ("a ", "a"), ("", "\n"), ("x y", "x  y")]
    for one, other in pairs:
        near = merkle.likeness(
            F.col("t0.root"), merkle.leaves(F.col("t0")), F.col("t1.root"), merkle.leaves(F.col("t1"))
        )
        got = trees(one, other).select((F.col("t0.root") == F.col("t1.root")).alias("same"), near.alias("near")).first()
        assert not got.same and got.near < 1, (one, other)


def test_texts_are_shuffled_once_and_no_python_runs(spark, frame, prose):
    df = merkle.fingerprint_report(frame([(i, prose(i, 40)) for i in range(50)]))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InArrow" not in plan and "WindowGroupLimit" not in plan
    df.collect()
    done = df._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in done.split("== Initial Plan ==")[0]
