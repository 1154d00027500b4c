"""Personal data: fixed patterns, and spans that boosted trees choose among wide candidates."""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from thermoweave.llm.boosting import Trees, boost, calibrate
from thermoweave.llm.common import map_batches

TRAINING_DOCUMENTS = 4_000  # texts that the trees are fitted on, those of the smallest hashes
LESSONS = 100_000  # candidates of these texts that the trees are fitted on, those of the smallest hashes
MADE_UP = 1_200  # sentences with made-up base spans that teach beside the table, at every size of it
REWRITTEN = 4  # disguised forms of each base span
PRECISION = 0.98  # that a kind's threshold must reach on held-out candidates
LEAST_FOUND = 20  # held-out candidates above a threshold that are needed to trust it; the made-up ones are more

KINDS = ("email", "ip", "card", "phone")
ORDER = {kind: i for i, kind in enumerate(KINDS)}
Span = tuple[str, int, int]

# The patterns of the base, written so that long runs cost linear time.
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NOT_DIGIT = re.compile(r"[^0-9]+")

# Wide candidates. No scan goes back over what it has read, so lengths need no bounds.
OPEN, CLOSE = r"[\(\[\{<]", r"[\)\]\}>]"
AT = re.compile(rf"\s?{OPEN}\s?(?:at|AT|@)\s?{CLOSE}\s?|\s(?:at|AT)\s|\s?@\s?")
DOT = rf"(?:\.|\s?{OPEN}\s?(?:dot|DOT|\.)\s?{CLOSE}\s?|\s(?:dot|DOT)\s|\s\.\s)"
HOST = re.compile(rf"[A-Za-z0-9-]++(?:{DOT}[A-Za-z0-9-]++)++")
EMAN = re.compile(  # a name, read backwards
    rf"(?:[A-Za-z0-9_%+.-]|\s?{CLOSE}\s?(?:tod|TOD|\.)\s?{OPEN}\s?|\s(?:tod|TOD)\s)*+"
)
QUAD = re.compile(rf"(?<![0-9])(?=([0-9]{{1,3}}(?:{DOT}[0-9]{{1,3}}){{3}})(?![0-9]))")
DIGITS = re.compile(r"[0-9]+")
BETWEEN = frozenset(" ./()-_\u00a0")  # what may stand between the digit groups of one number, up to three of them
FORMS = re.compile(
    r"\(?[0-9]{3}\)?[ .-]{1,2}[0-9]{3}[ .-][0-9]{4}|0[0-9]([ .-][0-9]{2}){4}|0[0-9]{2,4}[ /-][0-9]{5,8}"
    r"|00[0-9]{2}[ .-][0-9]{2,3}([ .-][0-9]{2,4}){2,3}"
)
CUES = frozenset(
    "call tel telephone phone mobile cell fax contact reach whatsapp sms text mail email e-mail write address".split()
)


def luhn(digits: str) -> bool:
    total = sum(int(c) for c in digits[-1::-2])
    return (total + sum(sum(divmod(2 * int(c), 10)) for c in digits[-2::-2])) % 10 == 0


def base_spans(text: str) -> list[Span]:
    """The fixed patterns' matches, leftmost and not overlapping within a kind, by start and kind."""
    out: list[Span] = []
    end, at = 0, text.find("@")
    while at >= 0:
        before = text[end:at]
        start = end + len(before.rstrip(LOCAL))
        host = DOMAIN.match(text, at + 1) if start < at else None
        if host:
            out.append(("email", start, host.end()))
        end = host.end() if host else at + 1
        at = text.find("@", end)
    for kind, pattern in (("ip", IP), ("card", CARD), ("phone", PHONE)):
        for found in pattern.finditer(text):
            if kind == "ip":
                good = all(len(p) <= 3 and int(p) <= 255 for p in (q.lstrip("0") or "0" for q in found[0].split(".")))
            else:
                digits = NOT_DIGIT.sub("", found[0])
                good = 14 <= len(digits) <= 19 and luhn(digits) if kind == "card" else 10 <= len(digits) <= 15
            if good:
                out.append((kind, found.start(), found.end()))
    return sorted(out, key=lambda s: (s[1], ORDER[s[0]], s[2]))


def numbers(text: str) -> Iterator[tuple[int, int, str]]:
    """(start, end, digits) of neighbouring digit groups with 7 to 19 digits in all.

    A number starts and ends where its run of groups does, or at white space; so there are at most as many as
    groups of 19 digits begin at each start, and a row of numbers is read once for each.
    """
    run: list[tuple[int, int]] = []

    def cuts(run: list[tuple[int, int]]) -> Iterator[tuple[int, int, str]]:
        free = [True] + [any(c.isspace() for c in text[x[1] : y[0]]) for x, y in zip(run, run[1:], strict=False)] + [True]
        for i in range(len(run)):
            if not free[i]:
                continue
            held = 0
            for k in range(i, len(run)):
                held += run[k][1] - run[k][0]
                if held > 19:
                    break
                if held >= 7 and free[k + 1]:
                    start, end = run[i][0], run[k][1]
                    own = text[start:end]
                    if own.count(")") > own.count("(") and text[start - 1 : start] == "(":
                        start -= 1
                    elif own.count("(") > own.count(")") and text[end : end + 1] == ")":
                        end += 1
                    yield start, end, NOT_DIGIT.sub("", own)

    for found in DIGITS.finditer(text):
        if run and not (found.start() - run[-1][1] <= 3 and BETWEEN.issuperset(text[run[-1][1] : found.start()])):
            yield from cuts(run)
            run = []
        run.append(found.span())
    yield from cuts(run)


def candidates(text: str) -> list[Span]:
    """Spans that may be personal in a form the fixed patterns do not know; they overlap each other and the base."""
    out: list[Span] = []
    end = 0
    for at in AT.finditer(text):
        before = EMAN.match(text[end : at.start()][::-1])[0][::-1].lstrip("._%+-()[]{}<> \t\r\n")
        host = HOST.match(text, at.end())
        if before and host:
            out.append(("email", at.start() - len(before), host.end()))
        end = at.end()
    for found in QUAD.finditer(text):
        if all(int(part) <= 255 for part in DIGITS.findall(found[1])):
            out.append(("ip", *found.span(1)))
    for start, end, digits in numbers(text):
        if text[start - 1 : start] in ("_", "@", "+") or text[max(0, start - 1) : start].isalnum():
            continue
        if len(digits) <= 15:
            out.append(("phone", start, end))
        if len(digits) >= 14 and luhn(digits):
            out.append(("card", start, end))
    return out


def describe(text: str, span: Span) -> list[float]:
    """Format and context of a span as numbers."""
    kind, start, end = span
    own = text[start:end]
    groups = [len(g) for g in re.findall(r"[0-9]+", own)]
    before, after = text[max(0, start - 24) : start], text[end : end + 2]
    words = before.lower().replace(":", " ").split()
    tail = re.findall(r"[A-Za-z]+", own)
    digits = "".join(re.findall(r"[0-9]", own))
    return [
        ORDER[kind], len(own), len(digits), len(groups), groups[0] if groups else 0, groups[-1] if groups else 0,
        max(groups, default=0), min(groups, default=0), own.count("-"), own.count("."), own.count(" "),
        own.count("/"), own.count("(") + own.count("["), own.count("@"), len(tail), len(tail[-1]) if tail else 0,
        len(set(digits)), float(digits[:1] == "0"), float("dot" in own.lower()), float(" at " in own.lower()),
        float(bool(words) and words[-1].strip(".,;()") in CUES), float(not CUES.isdisjoint(words)),
        float(before[-1:].isspace() or not before), float(not after or after[0].isspace() or after[0] in ",.;:!?)"),
        float(before.rstrip()[-1:] in ("$", "€", "#", "=")),
        own.count("_"), float(luhn(digits)) if digits else 0.0, float(len(set(groups)) == 1),
        float(any(c.isspace() for c in own)), float(FORMS.fullmatch(own) is not None), float(own.count(" . ")),
        float(bool(tail) and tail[-1][:1].isupper()),
    ]


def rewritten(kind: str, span: str, chance: random.Random) -> str:
    """A base span as people write it to escape patterns."""
    if kind == "email":
        name, host = span.split("@", 1)
        at = chance.choice([" at ", " (at) ", "(at)", "[at]", " [at] ", " AT ", " @ "])
        dots = [" . ", "."] if at == " @ " else [" dot ", "(dot)", "[dot]", " (dot) ", " . ", ".", "."]
        dot = chance.choice(dots)
        return name.replace(".", chance.choice([".", dot if dot != " . " else "."])) + at + host.replace(".", dot)
    if kind == "ip":
        dots = chance.choice(["[.]", "(.)", " dot ", "[dot]", "(dot)", " [.] ", " . "])
        parts = span.split(".")
        return parts[0] + "".join(chance.choice([dots, dots, "."]) + p for p in parts[1:-1]) + dots + parts[-1]
    digits = NOT_DIGIT.sub("", span)
    if kind == "card":
        between = chance.choice([".", "/", "_", "  ", " - ", "--", " / ", "\u00a0"])
        return between.join(digits[i : i + 4] for i in range(0, len(digits), 4))
    digits = digits[-10:]
    a, b, c, d = digits[:3], digits[3:6], digits[6:], digits[1:]
    between = chance.choice([" ", ".", "-"])
    return chance.choice([
        f"({a}) {b}-{c}", f"({a}) {b} {c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"{a} {b} {c}",
        between.join([f"0{d[0]}", d[1:3], d[3:5], d[5:7], d[7:9]]), f"0{d[:3]}{chance.choice('/ -')}{d[3:9]}",
        between.join([f"00{chance.randint(20, 98)}", d[:2], d[2:5], d[5:9]]),
    ])


def decoy(digits: str, chance: random.Random) -> str:
    """A number that is none of a person's, from random digits."""
    d = digits.ljust(12, "7")
    twos, whole = [d[i : i + 2] for i in range(0, 12, 2)], checked(d + d[:3])
    return chance.choice([
        f"20{d[:2]}-0{int(d[2]) % 9 + 1}-1{d[3]}", f"1{d[0]}/0{int(d[1]) % 9 + 1}/20{d[2:4]}", f"{d[:3]},{d[3:6]}",
        f"{d[0]}.{d[1]}.{d[2:4]}", f"{d[:4]}-{d[4:8]}", f"{d[:4]} {d[4:8]}", f"{d[:8]}", f"{d[:10]}", f"{d[:12]}",
        f"{d[:5]}-{d[5:9]}", f"{d[:2]}.{d[2:7]}", f"978-{d[0]}-{d[1:5]}-{d[5:9]}-{d[9]}", f"{d[:4]} {d[4:8]} {d[8:12]}",
        " . ".join(d[:4]), " ".join(twos), "/".join(twos), ".".join([whole[:2], whole[2:9], whole[9:]]),
        " ".join(whole[i : i + 2] for i in range(0, 16, 2)), f"{whole[:7]}/{whole[7:]}", ".".join(whole),
    ])


def no_address(digits: str, chance: random.Random) -> str:
    """Words around "at" or an at sign that are no address."""
    word = lambda: "".join(chance.choices("abcdeghilmnoprstu", k=chance.randint(2, 8)))
    return chance.choice([
        f"{word()} at {word()}.{word().title()}", f"{word()} at {digits[0]}.{digits[1:3]}", f"{word()} @ {digits[0]}.{digits[1:3]}",
        f"{digits[:2]} @ {digits[2]}.{digits[3:5]}", f"{word()} at {digits[:2]}.{digits[2]}.{digits[3:5]}", f"{word()} at {word()} . {word().title()}",
    ])


def checked(digits: str) -> str:
    """The digits and the one that makes them pass Luhn."""
    return next(digits + c for c in "0123456789" if luhn(digits + c))


def made_up(count: int = MADE_UP) -> Iterator[str]:
    """Sentences with one base span each, the same at every call."""
    chance = random.Random(5)
    word = lambda least: "".join(chance.choices("abcdeghilmnoprstu", k=chance.randint(least, 9)))
    number = lambda n: "".join(chance.choices("0123456789", k=n))
    for i in range(count):
        span = [
            f"{word(2)}{chance.choice(['', '.', number(2)])}{word(2)}@{word(3)}.{chance.choice(['', 'a.', word(2) + '.'])}{word(2)[:3]}",
            ".".join(str(chance.randint(0, 255)) for _ in range(4)),
            checked(chance.choice("3456") + number(14)),
            f"+{chance.randint(1, 98)} ({number(3)}) {number(3)}-{number(4)}",
        ][i % 4]
        before = " ".join(word(1) for _ in range(chance.randint(0, 6)))
        cue = chance.choice(["", "", "", chance.choice(sorted(CUES)) + chance.choice([" ", ": "])])
        after = chance.choice(["", ".", ", ", " "]) + " ".join(word(1) for _ in range(chance.randint(0, 3)))
        yield f"{before} {cue}{span}{after}"


def looks_personal(text: str, span: Span) -> bool:
    """Whether a candidate that nothing confirms is better not taught as clean."""
    kind, start, end = span
    own, words = text[start:end], text[max(0, start - 24) : start].lower().replace(":", " ").split()
    if kind in ("ip", "card") or not CUES.isdisjoint(words):
        return True
    return FORMS.fullmatch(own) is not None if kind == "phone" else "@" in own or re.search(rf"{OPEN}\s?(?:at|AT)", own) is not None


class Free:
    """Which positions of a text no span covers yet."""

    def __init__(self, text: str, spans: list[Span]) -> None:
        self.covered = bytearray(len(text))
        for span in spans:
            self.take(span)

    def take(self, span: Span) -> None:
        self.covered[span[1] : span[2]] = b"\1" * (span[2] - span[1])

    def is_free(self, span: Span) -> bool:
        return self.covered.find(1, span[1], span[2]) < 0


def examples(text: str) -> Iterator[tuple[list[float], int]]:
    """Candidates of a text with labels: rewritten base spans are personal, decoys and plain others are not.

    Each base span is rewritten in its place, ``REWRITTEN`` times, and decoys are put there once. Candidates outside the base that look
    personal are left out, as nobody knows what they are.
    """
    base = base_spans(text)
    free = Free(text, base)
    for span in candidates(text):
        if free.is_free(span) and not looks_personal(text, span):
            yield describe(text, span), 0
    chance = random.Random(xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")))
    for kind, start, end in base:
        around = text[max(0, start - 40) : start], text[end : end + 40]
        forms = [(rewritten(kind, text[start:end], chance), 1) for _ in range(REWRITTEN)]
        digits = "".join(chance.choices("0123456789", k=12))
        forms += [(decoy(digits, chance), 0), (no_address(digits, chance), 0)][: 2 if kind == "email" else 1]
        for form, label in forms:
            changed = around[0] + form + around[1]
            inside = len(around[0]), len(around[0]) + len(form)
            for span in candidates(changed):
                if span[1] < inside[1] and inside[0] < span[2]:
                    whole = span == (kind, *inside)
                    yield describe(changed, span), int(label and whole)


@dataclass
class Detector:
    """For each kind its trees and the least probability at which a candidate is taken."""

    trees: dict[str, Trees] = field(default_factory=dict)
    thresholds: dict[str, float] = field(default_factory=dict)

    def added(self, texts: list[str], bases: list[list[Span]]) -> list[list[Span]]:
        """For each text the chosen candidates: likeliest first, none over another or over a base span."""
        out: list[list[Span]] = [[] for _ in texts]
        found: list[tuple[int, Span]] = []
        free: dict[int, Free] = {}
        for i, text in enumerate(texts):
            some = candidates(text)
            if some:
                free[i] = Free(text, bases[i])
                found += [(i, span) for span in some if span[0] in self.thresholds and free[i].is_free(span)]
        chance = np.zeros(len(found))
        for kind, trees in self.trees.items():
            own = [k for k, (_, span) in enumerate(found) if span[0] == kind]
            if own:
                described = [describe(texts[found[k][0]], found[k][1]) for k in own]
                chance[own] = trees.probabilities(np.array(described, float))
        for k in np.argsort(-chance, kind="stable"):
            i, span = found[k]
            if chance[k] >= self.thresholds[span[0]] and free[i].is_free(span):
                free[i].take(span)
                out[i].append(span)
        return out


def fit(
    docs: DataFrame, documents: int = TRAINING_DOCUMENTS, text: str = "text", doc_id: str = "doc_id", lessons: int = LESSONS
) -> Detector:
    """Trees of each kind from at most ``lessons`` candidates of at most ``documents`` texts that hold a digit or an at sign.

    There are no labels of personal data, so the base teaches: its spans, rewritten in place the way
    people disguise them, are positive, decoy numbers and candidates that do not look personal are negative. The same is done
    with ``MADE_UP`` sentences, so a small or empty table finds these forms too. A third of the examples is kept
    for calibration and for the thresholds. A kind whose held-out candidates never reach ``PRECISION`` adds nothing.
    """
    order = F.xxhash64(F.col(doc_id).cast("string"), F.col(text))
    some = docs.where(F.col(text).rlike("[0-9@]")).select(order.alias("h"), F.col(text).alias("text"))
    last = some.select("h").orderBy("h").limit(documents).agg(F.max("h")).first()[0]
    taught = [(i, x, y) for i, t in enumerate(made_up()) for x, y in examples(t)]

    def teach(rows: dict) -> dict:
        found = [(h, x, y) for h, t in zip(rows["h"], rows["text"], strict=True) for x, y in examples(t)]
        return {"h": [r[0] for r in found], "x": [r[1] for r in found], "y": [r[2] for r in found]}

    if last is not None:
        own = map_batches(some.where(F.col("h") <= last), teach, "h long, x array<double>, y int")
        own = own.withColumn("k", F.xxhash64("h", "x")).orderBy("k", "h", "x", "y").limit(lessons)
        taught += sorted(tuple(r)[:3] for r in own.collect())
    h, x, y = (np.array([r[k] for r in taught]) for k in range(3))
    found = Detector()
    for kind in KINDS:
        own, kept = x[:, 0] == ORDER[kind], h % 3 == 0
        trees = boost(x[own & ~kept], y[own & ~kept].astype(float))
        calibrate(trees, x[own & kept], y[own & kept].astype(float))
        p, right = trees.probabilities(x[own & kept]), y[own & kept]
        falling = np.argsort(-p, kind="stable")
        precise = np.cumsum(right[falling]) / np.arange(1, len(p) + 1)
        good = np.flatnonzero((precise >= PRECISION) & (np.arange(len(p)) + 1 >= LEAST_FOUND))
        found.trees[kind] = trees
        if len(good):
            lowest = p[falling][good[-1] : good[-1] + 2]  # halfway to the candidate that would spoil it
            found.thresholds[kind] = max(0.5, float(lowest.mean()) if len(lowest) == 2 else 0.5)
    return found


def written(spans: list[Span]) -> str:
    """kind:start:end by start, then kind, comma-joined."""
    ordered = sorted(spans, key=lambda s: (s[1], ORDER[s[0]], s[2]))
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in ordered)


def redacted(text: str, spans: list[Span]) -> str:
    """The text with every span replaced by its kind in angle brackets; overlapping spans give one mark."""
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2], ORDER[s[0]])):
        if start >= at:
            out += [text[at:start], f"<{kind}>"]
        at = max(at, end)
    return "".join(out) + text[at:]


def find(docs: DataFrame, detector: Detector, text: str = "text", redact: bool = True) -> DataFrame:
    """``docs`` plus n_email, n_ip, n_card, n_phone and base_sha256 of the base, ``spans`` of all.

    Positions are code points of the whole text, ends exclusive. A null text has none. With
    ``redact`` the text itself comes back without its personal data. Rows are read one by one, so repeated rows
    give equal results. Added spans never overlap: the likeliest stays, of equally likely ones the one proposed first
    (addresses, then hosts, then numbers from left to right), and none over a span of the base.
    """
    new = [*(f"n_{k}" for k in KINDS), "base_sha256", "spans"]
    kept = docs.drop(*new)
    shared = docs.sparkSession.sparkContext.broadcast(detector)

    def run(batches):
        for batch in batches:
            at = batch.schema.get_field_index(text)
            texts = batch.column(at).to_pylist()
            plain = [t or "" for t in texts]
            bases = [base_spans(t) for t in plain]
            more = shared.value.added(plain, bases)
            columns = list(batch.columns)
            if redact:
                clean = [t and redacted(t, b + m) for t, b, m in zip(texts, bases, more, strict=True)]
                columns[at] = pa.array(clean, pa.string())
            for kind in KINDS:
                columns.append(pa.array([sum(s[0] == kind for s in b) for b in bases], pa.int64()))
            columns.append(pa.array([hashlib.sha256(written(b).encode()).hexdigest() for b in bases]))
            columns.append(pa.array([written(b + m) for b, m in zip(bases, more, strict=True)]))
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, *new])

    fields = [T.StructField(n, T.LongType() if n.startswith("n_") else T.StringType()) for n in new]
    return kept.mapInArrow(run, T.StructType([*kept.schema, *fields]))


def pii_report(docs: DataFrame) -> DataFrame:
    """Per document: base counts and digest, and all spans."""
    return find(docs.select("doc_id", "text"), fit(docs), redact=False).drop("text")
