"""Toxicity, personal data, mixing and the pipeline."""

import random
import re

import numpy as np
import oracle
import pytest

import corpus_pipeline
from thermoweave.llm import mixing, pii, toxicity
from thermoweave.llm.common import table
from thermoweave.llm.queries import registered

SF = f"{oracle.TESTDATA}/sf0.001"
LARGER = f"{oracle.TESTDATA}/sf0.1"


@pytest.fixture(scope="module")
def model(spark):
    return toxicity.fit(table(spark, LARGER, "documents"), table(spark, LARGER, "labels"))


def test_held_out_documents(spark, model):
    labels = table(spark, LARGER, "labels")
    docs = table(spark, LARGER, "documents").join(labels, "doc_id").where(toxicity.held_out("doc_id"))
    rows = [(r.score, r.toxic) for r in toxicity.score_texts(docs.select("text", "toxic"), model).collect()]
    hit = sum(s >= toxicity.THRESHOLD and y for s, y in rows)
    assert hit / sum(s >= toxicity.THRESHOLD for s, _ in rows) > 0.93
    assert hit / sum(y for _, y in rows) > 0.85


@pytest.mark.parametrize(
    "written, meant",
    [("m0r0n", "moron"), ("1d10t", "idiot"), ("stuuupid", "stupid"), ("tr@sh", "trash"), ("l-o-s-e-r", "loser"),
     ("$cum", "scum"), ("i.d.i.o.t", "idiot"), ("cl0wn", "clown")],
)
def test_restoration(model, written, meant):
    assert toxicity.disguised(written)
    assert toxicity.restore(written, model.trigrams) == meant


def test_disguise_raises_the_score(model):
    reader = toxicity.Reader(model)
    clean, plain, hidden = "the house is on the hill", "you idiot and moron scum", "you 1d10t and m 0 r o n, sc*um"
    assert reader.score(clean) < 0.3 and reader.score(plain) > 0.9 and reader.score(hidden) > 0.9


@pytest.mark.parametrize("written", ["$cum", "$tupid", "|oser", "!diot", "($cum!!)", "$tupid!", "idiot###", "idiot!!", "(idiot)"])
def test_signs_at_the_ends_of_words(model, written):
    reader, plain = toxicity.Reader(model), "the house on the hill is for the scum stupid loser idiot"
    word = max((w for w in plain.split()[8:]), key=lambda w: w[1:4] in written)
    assert reader.score(f"the house is {written} on the hill") >= reader.score(f"the house is {word} on the hill") > 0.3
    assert reader.score("the house! (is) on $500 the hill!!") < 0.3


@pytest.mark.parametrize(
    "written", ["st" + "u" * 24 + "pid", "such a l o s e r", "you are a m o r o n", "s t u p ! d", "$ c u m", "a s c u m i s",
                "i.d.i.o.t.a.n.d.a.m.o.r.o.n", "you-are-such-a-st*pid-l0ser-and-m0r0n"],
)
def test_long_and_spaced_words(model, written):
    reader = toxicity.Reader(model)
    assert reader.score(f"the house {written} on the hill") > reader.score("the house on the hill") + 0.3
    assert reader.score("| a | b | - | - | and $ 1 0 0 . 5 0, tel 1 2 3 4 5 6 7 on the well-known hill") < 0.3


def test_odd_toxicity(spark, frame, labels, odd_rows):
    got = toxicity.toxicity_report(frame(odd_rows), labels).collect()
    assert len(got) == len(odd_rows) and all(0 <= r.score <= 1 for r in got)
    assert toxicity.toxicity_report(frame([]), labels).count() == 0
    assert toxicity.toxicity_report(frame(odd_rows), labels.limit(0)).count() == len(odd_rows)
    assert toxicity.drop_toxic(frame(odd_rows), labels).columns == frame([]).columns


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_base(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            double = [int(c) * (1 + i % 2) for i, c in enumerate(digits[::-1])]
            good = {
                "email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                "card": 14 <= len(digits) <= 19 and sum(d // 10 + d % 10 for d in double) % 10 == 0,
                "phone": 10 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append((kind, m.start(), m.end()))
    return sorted(out, key=lambda s: (s[1], pii.ORDER[s[0]], s[2]))


def test_base_spans_equal_plain_patterns():
    chance = random.Random(5)
    parts = [*"0123456789..@@+-( ) ab", "a@b.c", "1.2.3.4", "+1 (636) 555-7248", "4111 1111 1111 1111", "300.1.1.1"]
    for _ in range(5000):
        text = "".join(chance.choice(parts) for _ in range(chance.randint(0, 25)))
        assert pii.base_spans(text) == plain_base(text), text
    for long in ("a." * 60_000, "1" * 60_000, "@" * 60_000, "+1 " * 30_000, "a@" * 30_000):
        pii.base_spans(long)


DISGUISED = [
    ("call me at (636) 555-7248 now", [("phone", 11, 25)]), ("bob (at) mail (dot) com", [("email", 0, 23)]),
    ("write to bob @ mail . com please", [("email", 9, 25)]), ("bob at a.b.c.d.e.f.g.com", [("email", 0, 24)]),
    ("the host 192[.]0[.]2[.]1 was", [("ip", 9, 24)]), ("see 192 dot 0 dot 2 dot 1 again", [("ip", 4, 25)]),
    ("card 4111.1111.1111.1111 ok", [("card", 5, 24)]), ("pay 4111/1111/1111/1111 now", [("card", 4, 23)]),
    ("phone 06 12 34 56 78 today", [("phone", 6, 20)]),
]
PLAIN = ("on 2024-01-15 order 12345678", "he looked at home. Then", "a@b.example.com is known", "", "list 1 . 2 . 3 . 4 . 5 of")


def test_trees_add_disguised_forms_and_leave_numbers(spark):
    docs = table(spark, LARGER, "documents")
    for detector in (pii.fit(docs), pii.fit(docs.limit(1)), pii.fit(docs.limit(0))):
        for text, spans in [*DISGUISED, *((t, []) for t in PLAIN)]:
            assert detector.added([text], [pii.base_spans(text)])[0] == spans, text
    assert pii.redacted("x a@b.c y", pii.base_spans("x a@b.c y")) == "x <email> y"


def plain_numbers(text):
    """Every stretch of digit groups, tried one by one."""
    groups = [m.span() for m in re.finditer("[0-9]+", text)]
    gaps = [text[a[1] : b[0]] for a, b in zip(groups, groups[1:])]
    joined = [re.fullmatch(r"[ ./()_\u00a0-]{1,3}", g) is not None for g in gaps]
    edge = [True] + [not j or re.search(r"\s", g) is not None for g, j in zip(gaps, joined)] + [True]
    out = []
    for i in range(len(groups)):
        for k in range(i, len(groups)):
            digits = re.sub("[^0-9]", "", text[groups[i][0] : groups[k][1]])
            if all(joined[i:k]) and edge[i] and edge[k + 1] and 7 <= len(digits) <= 19:
                out.append((groups[i][0], groups[k][1], digits))
    return out


def test_numbers_equal_plain_search():
    chance = random.Random(8)
    for _ in range(3000):
        text = "".join(chance.choice([*"0123456789", "12", "345", " ", ".", "-", "/", "  ", " - ", "x", "....", "_"])
                       for _ in range(chance.randint(0, 40)))
        assert list(pii.numbers(text)) == plain_numbers(text), text
    assert list(pii.numbers("(636) 555-7248"))[0][:2] == (0, 14)


def test_added_spans_never_overlap(spark):
    detector = pii.fit(table(spark, SF, "documents"))
    chance = random.Random(9)
    parts = [t for t, _ in DISGUISED] + ["a@b.co", "1.2.3.4", " at ", " . ", " ", "555 123 4567", "+1 (636) 555-7248"]
    for _ in range(300):
        text = "".join(chance.choice(parts) for _ in range(6))
        base = pii.base_spans(text)
        more = detector.added([text], [base])[0]
        assert detector.added([text, text], [base, base]) == [more, more]
        for n, (_, start, end) in enumerate(more):
            assert all(e <= start or end <= s for _, s, e in base + more[n + 1 :]), text
    for long in ("a at " * 40_000, "a dot " * 40_000, "(" * 60_000, "12-" * 40_000, "a" * 100_000 + " at b.co"):
        pii.candidates(long)


def test_odd_pii(frame, odd_rows):
    rows = [*odd_rows, (50, "x" * 70_000 + " a@b.co")]
    got = {r.doc_id: r for r in pii.pii_report(frame(rows)).collect()}
    assert got[50].spans == "email:70001:70007" and got[1].spans == "" and got[50].n_email == 1
    assert pii.pii_report(frame([])).count() == 0


def test_mixing_meets_targets(spark):
    docs, labels = table(spark, LARGER, "documents"), table(spark, LARGER, "labels")
    labelled = mixing.quality_domains(docs, labels)
    names, members = mixing.memberships(docs, labelled)
    members = members.cache()
    frame = members.toPandas()
    mass = (frame.tokens * frame.copies).to_numpy()[:, None] * frame[[f"p{k}" for k in range(len(names))]].to_numpy()
    for targets in (mass.sum(0) * 1.5, mass.sum(0) * np.linspace(0.4, 1.6, len(names))):
        rate = mixing.fit_rates(members, len(names), targets, 0.0).toPandas().rate.to_numpy()
        assert (rate >= 0).all() and np.allclose((rate[:, None] * mass).sum(0), targets, rtol=1e-4)
    best = frame.copy()
    best["domain"] = np.array(names)[mass.argmax(1)]
    known = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    assert np.mean([known[d] == x[:2] for d, x in zip(best["__d"], best.domain, strict=True)]) > 0.95


def test_mixing_by_given_targets(spark, frame, prose):
    rows = [(i, ("aa bb cc " if i % 4 else "xx yy zz ") * 40) for i in range(80)]
    labelled = spark.createDataFrame([(i, "a" if i % 4 else "x") for i in range(40)], "doc_id long, domain string")
    got = mixing.mix(frame(rows), labelled, targets={"a": 1, "x": 1}, budget=80 * 120).collect()
    assert {(r.domain, round(r.rate, 3)) for r in got} == {("a", 0.667), ("x", 2.0)}
    repeated = mixing.repeat_by_rate(frame(rows), labelled, targets={"a": 1, "x": 1}, budget=80 * 120)
    assert repeated.columns == frame(rows).columns
    assert repeated.where("doc_id % 4 = 0").count() == 40


def test_mixing_of_many_domains(spark, frame):
    size = mixing.DENSE_DOMAINS + 6
    rows = [(i, f"w{i % size} v{i % size} " * 20) for i in range(3 * size)]
    labelled = spark.createDataFrame([(i, f"d{i:03}") for i in range(size)], "doc_id long, domain string")
    targets = {f"d{i:03}": 1 + i % 2 for i in range(size)}
    got = mixing.mix(frame(rows), labelled, targets=targets, budget=120 * size * 1.5).collect()
    assert len(got) == 3 * size and {r.domain for r in got} == set(targets)
    tokens = dict.fromkeys(targets, 0.0)
    for r in got:
        tokens[r.domain] += r.rate * r.n_tokens
    assert all(abs(tokens[d] / (120 * t) - 1) < 0.01 for d, t in targets.items())


def test_odd_mixing(frame, labels, odd_rows):
    got = mixing.mixing_report(frame(odd_rows), labels).collect()
    assert len(got) == len(odd_rows) and all(r.rate >= 0 for r in got)
    assert mixing.mixing_report(frame([]), labels).count() == 0
    assert {r.rate for r in mixing.mixing_report(frame(odd_rows), labels.limit(0)).collect()} == {1.0}


def test_pipeline_keeps_and_drops_what_it_should(spark):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "line dedup", "near-duplicates", "mixing", "packing"]
    docs = table(spark, SF, "documents")
    texts = {r.doc_id: r.text for r in docs.collect()}
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        before = {r.doc_id for r in docs.collect()}
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and {r.doc_id for r in out.collect()} <= before
        if number in (1, 3):
            assert {r.doc_id for r in out.collect()} == before
        docs = out.cache()
    pieces = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in pieces} == {r.doc_id for r in docs.collect()} <= set(texts)


def test_pipeline_of_odd_rows(spark, frame, odd_rows):
    for rows in (odd_rows, []):
        docs = frame(rows)
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF).cache()
        assert (docs.count() > 0) == bool(rows)


@pytest.mark.parametrize("name", ["op5_pii", "op7_mixing", "op8_multi_index", "op9_main_text", "op10_toxicity"])
def test_queries_run(spark, name):
    assert registered()[name](spark, SF).count() > 0
