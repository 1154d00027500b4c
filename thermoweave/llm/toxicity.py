"""Toxicity scores of texts whose words are first restored from disguise.

A noisy channel: someone meant a word, and wrote it with digits and signs for letters, with repeated
letters, or with spaces and points between letters. Viterbi decoding over the lattice of what each
character may stand for finds the word, under a character trigram model of the whole corpus and
of the words that mark toxic texts. The restored words are scored by a classifier.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from thermoweave.llm.common import map_batches, sliced, unused, written

TRAINING_ROWS = 20_000  # labelled rows that the classifier is fitted on, those of the smallest hashes
THRESHOLD = 0.7
PREFIXES = (4, 5, 6)
BEAM = 48
CACHED_WORDS = 300_000

# The letters of the model, and what signs may stand for.
LETTERS = "abcdefghijklmnopqrstuvwxyzàáâãäåæçèéêëìíîïñòóôõöøùúûüýßœ"
STANDS_FOR = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¡": "i", "§": "s",
}
SIZE = len(LETTERS) + 2  # 0: no letter, last: any other letter
CODE = np.zeros(0x250, np.int64)
for _i, _c in enumerate(LETTERS):
    CODE[ord(_c)] = CODE[ord(_c.upper()[0])] = _i + 1
OTHER = SIZE - 1

# Costs of the channel, in nats.
SWAP, DROP, WASTE, REPEAT = 1.0, 0.7, 20.0, 0.3

EDGES = "".join(c for c in map(chr, range(0x21, 0x7F)) if not c.isalnum()) + "…«»“”„’‘"
SIGNS = "".join(c for c in STANDS_FOR if not c.isalnum())
_ONE = rf"(?:[^\W_]|[{regex.escape(SIGNS)}])"
SPACED = regex.compile(rf"(?<![^\W_])(?:{_ONE}[ .\-_*]{{1,2}}){{2,}}{_ONE}(?![^\W_])")
FIRM = "".join(c for c in EDGES if c not in SIGNS)  # ends that stand for no letter
PLAIN = regex.compile(r"\p{L}*")
STRETCHED = regex.compile(r"(\p{L})\1\1")
REPEATED = regex.compile(r"(.)\1{2,}", regex.S)
JOINERS = " .-_*"
JOINER = regex.compile(r"[ .\-_*]+")


def trigram_counts(texts: Iterable[str | None]) -> np.ndarray:
    """Counts of letter trigrams; every run of other characters is one boundary."""
    counts = np.zeros(SIZE**3, np.int64)
    for text in texts:
        points = np.frombuffer((" " + (text or "") + " ").encode("utf-32-le", "surrogatepass"), np.uint32)
        codes = CODE[np.minimum(points, len(CODE) - 1)]
        keep = np.append(True, (codes[1:] > 0) | (codes[:-1] > 0))
        codes = codes[keep]
        if len(codes) > 2:
            counts += np.bincount((codes[:-2] * SIZE + codes[1:-1]) * SIZE + codes[2:], minlength=SIZE**3)
    return counts


def corpus_trigrams(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Trigram counts of all texts. Tasks send their own counts, the driver gets the alphabet's."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SIZE**3, np.int64)
        for batch in sliced(batches):
            total += trigram_counts(batch.column(0).to_pylist())
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["gram", "n"])

    parts = docs.select(text).mapInArrow(count, "gram long, n long")
    counts = np.zeros(SIZE**3, np.int64)
    for gram, n in parts.groupBy("gram").agg(F.sum("n").alias("n")).collect():
        counts[gram] = n
    return counts


def _log_model(counts: np.ndarray) -> np.ndarray:
    """log P(letter | two before it), backed off to one before and to none."""
    cube = counts.reshape(SIZE, SIZE, SIZE).astype(float)
    single = (cube.sum(axis=(0, 1)) + 1) / (cube.sum() + SIZE)
    pair = (cube.sum(axis=0) + 5 * single) / (cube.sum(axis=0).sum(axis=1, keepdims=True) + 5)
    return np.log((cube + 5 * pair[None]) / (cube.sum(axis=2, keepdims=True) + 5))


@dataclass
class Model:
    """Everything that scoring needs, small enough to travel with each task."""

    trigrams: np.ndarray  # log probabilities
    weights: dict[str, float] = field(default_factory=dict)  # evidence of words and word beginnings
    slopes: tuple[float, ...] = ()
    base: float = 0.0


def letter_of(char: str) -> int:
    """The model's number of a letter, 0 of what it takes for no letter."""
    return int(CODE[ord(char)]) if ord(char) < len(CODE) else OTHER * char.isalpha()


def restore(token: str, trigrams: np.ndarray, split: bool = False) -> str:
    """The likeliest word behind a disguised token, by Viterbi decoding with a beam.

    Each character is a letter kept, a sign swapped for a letter, a sign or joiner dropped, or a repeat of the
    letter before it; with ``split`` a joiner may also end a word, and words come with blanks between. The
    state is the last two letters written.
    """
    beam: dict[tuple[int, int], tuple[float, tuple]] = {(0, 0): (0.0, ())}
    for char in token.lower():
        letter = letter_of(char)
        options = [(letter, char, 0.0)] if letter else []
        options += [(LETTERS.index(c) + 1, c, SWAP) for c in STANDS_FOR.get(char, "")]
        new: dict[tuple[int, int], tuple[float, tuple]] = {}

        def offer(state: tuple[int, int], cost: float, word: tuple, new=new) -> None:
            if state not in new or cost < new[state][0]:
                new[state] = (cost, word)

        for (a, b), (cost, word) in beam.items():
            for code, c, price in options:
                offer((b, code), cost + price - trigrams[a, b, code], (word, c))
                if code == b:
                    offer((a, b), cost + price + REPEAT, word)
            if not letter:
                offer((a, b), cost + (WASTE if char in STANDS_FOR else DROP), word)
                if split and b and char in JOINERS:
                    offer((b, 0), cost - trigrams[a, b, 0], (word, " "))
        beam = dict(sorted(new.items(), key=lambda x: x[1][0])[:BEAM])
    ends = ((cost - trigrams[a, b, 0], word) for (a, b), (cost, word) in beam.items())
    letters, word = [], min(ends, key=lambda x: x[0], default=(0.0, ()))[1]
    while word:
        word, c = word
        letters.append(c)
    return "".join(reversed(letters))


def disguised(core: str) -> bool:
    """Letters mixed with signs that stand for letters or join them, or a letter three times in a row."""
    if len(core) < 3 or sum(c.isalpha() for c in core) < 2:
        return False
    return bool(STRETCHED.search(core)) or (
        not PLAIN.fullmatch(core) and all(c.isalpha() or c in STANDS_FOR or c in ".-_*" for c in core)
    )


def words_of(text: str | None) -> set[str]:
    """Distinct words, lower-cased, without punctuation at the ends."""
    return {w.strip(EDGES) for w in (text or "").lower().split()} - {""}


def forms_of(text: str | None) -> dict[str, set[str]]:
    """The words of ``words_of``, and for each the forms that keep signs for letters at the ends."""
    out: dict[str, set[str]] = {}
    for raw in set((text or "").lower().split()):
        if core := raw.strip(EDGES):
            out.setdefault(core, {core}).add(raw.strip(FIRM))
    return out


def features(word: str) -> list[str]:
    """A word and its beginnings; a trailing ~ tells them apart."""
    return [word, *(word[:n] + "~" for n in PREFIXES if len(word) > n)]


class Reader(dict):
    """Evidence of every word, looked up once: the best of its features after restoration."""

    def __init__(self, model: Model) -> None:
        super().__init__()
        self.model = model
        self.known = {f.rstrip("~") for f in model.weights}
        self.stems = {f[:n] for f in self.known for n in range(1, len(f) + 1)}

    def __missing__(self, word: str) -> float:
        best = self._best(word)
        if disguised(word):
            best = max(best, self._restored(REPEATED.sub(r"\1\1", word)))
        if word.strip(SIGNS) != word:
            best = max(best, self._between_signs(word))
            for part in (word.rstrip(EDGES), word.lstrip(EDGES)):
                if part != word:
                    best = max(best, self[part])
        if len(self) < CACHED_WORDS and len(word) < 40:
            self[word] = best
        return best

    def _best(self, word: str) -> float:
        weights = self.model.weights
        return max((weights.get(f, 0.0) for f in features(word)), default=0.0)

    def _next(self, live: set[str], char: str) -> set[str]:
        """The beginnings of known words that ``live`` ones become when ``char`` is read."""
        letters = [char] if char.isalpha() else STANDS_FOR.get(char, "")
        longer = {s + c for s in live for c in letters if s + c in self.stems}
        return longer | {s for s in live if s[-1:] and (s[-1] in letters or char in JOINERS)}

    def _reaches(self, token: str, anywhere: bool) -> bool:
        """Whether any reading of ``token``, from its start or from anywhere, begins with something known.

        Without that its restoration has no weight, and the lattice need not be searched.
        """
        live = {""}
        for char in token:
            live = self._next(live | {""} if anywhere else live, char) | (set() if letter_of(char) else live)
            if not live.isdisjoint(self.known):
                return True
            if not live and not anywhere:
                return False
        return False

    def _restored(self, token: str) -> float:
        """The best of a token read as one word and, where it holds joiners, as several."""
        best = 0.0
        if self._reaches(token, False):
            best = self._best(restore(token, self.model.trigrams))
        if JOINER.search(token) and self._reaches(token, True):
            best = max([best, *map(self._best, restore(token, self.model.trigrams, True).split())])
            best = max([best, *(self[part] for part in JOINER.split(token) if len(part) > 2)])
        return best

    def _spelled(self, run: str) -> list[float]:
        """Evidence of a run of spaced characters: words that the lattice cuts it into, the run as one word,
        and known words of four or more letters from any start in it."""
        run = REPEATED.sub(r"\1\1", run.lower())
        if not self._reaches(run, True):
            return []
        words = [w for w in restore(run, self.model.trigrams, True).split() if len(w) > 2]
        found = [x for x in map(self._best, words) if x]
        joined = JOINER.sub("", run)
        best = self._best(restore(joined, self.model.trigrams)) if self._reaches(joined, False) else 0.0
        if sum(c.isalpha() for c in run) > 1:
            live: set[str] = set()
            for char in run:
                live = self._next(live | {""}, char)
                best = max([best, *(self.model.weights.get(s, 0.0) for s in live if len(s) > 3)])
        return found if best <= max(found, default=0.0) else [*found, best]

    def _between_signs(self, word: str) -> float:
        """The best known word that starts at any of the signs in front and ends at any of those behind."""
        if sum(c.isalpha() for c in word) < 2:
            return 0.0
        first, last = len(word) - len(word.lstrip(EDGES + SIGNS)), len(word.rstrip(EDGES + SIGNS))
        live, best = set(), 0.0
        for at, char in enumerate(word):
            live = self._next(live | {""} if at <= first else live, char)
            if at + 1 >= last:
                best = max([best, *(self.model.weights.get(s, 0.0) for s in live)])
        return best

    def evidence(self, text: str | None) -> list[float]:
        """What the classifier sees: the best word, the best five, how many good ones, their share."""
        words = forms_of(text)
        found = [w for w in (max(map(self.__getitem__, forms)) for forms in words.values()) if w]
        for spaced in SPACED.finditer(text or ""):
            found += self._spelled(spaced[0])
        found.sort(reverse=True)
        good = sum(w > 1 for w in found)
        return [
            found[0] if found else 0.0, sum(found[:5]), math.log1p(good), math.sqrt(good / max(len(words), 1))
        ]

    def score(self, text: str | None) -> float:
        if not self.model.slopes:
            return self.model.base
        z = self.model.base + sum(a * b for a, b in zip(self.model.slopes, self.evidence(text), strict=True))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def _weights(counts: dict[str, tuple[int, int]], toxic: int, clean: int) -> dict[str, float]:
    """Lower confidence bounds of the log odds of features, where above 0."""
    out = {}
    for name, (a, b) in counts.items():
        odds = math.log((a + 0.5) / (toxic + 1)) - math.log((b + 0.5) / (clean + 1))
        bound = odds - 2 * math.sqrt(1 / (a + 0.5) + 1 / (b + 0.5))
        if a > 1 and bound > 0:
            out[name] = bound
    return out


def held_out(doc_id: str | Column) -> Column:
    return F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id) % 3 == 1


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    rows: int = TRAINING_ROWS,
    text: str = "text",
    doc_id: str = "doc_id",
) -> Model:
    """Character model from all texts, classifier from at most ``rows`` labelled ones.

    Only documents whose crc32(doc_id) mod 3 is not 1 teach. A document labelled twice has its larger
    label. Word evidence is counted on two halves, and the last step learns from each half by the evidence of the
    other, so that its scores hold for texts it has not seen. Without labels of both kinds
    every score is the share of toxic ones.
    """
    known = (
        labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull())
        .groupBy(F.col(doc_id).alias("__id")).agg(F.max(label).cast("int").alias("y"))
        .where(~held_out("__id"))
        .orderBy(F.xxhash64("__id"), "__id").limit(rows)
    )
    # At most ``rows`` ids and labels are broadcast, so no text is shuffled; the texts they pick are kept once.
    half = (F.shiftright(F.xxhash64("__id"), 7) % 2 != 0).cast("int").alias("half")
    asked = docs.select(F.col(doc_id).alias("__doc"), F.col(text).alias("text"))
    taught = written(asked.join(F.broadcast(known), F.col("__doc") == F.col("__id")).select("text", "y", half))

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in sliced(batches):
            for text_, y, half in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own = {f for w in words_of(text_) for f in features(w)}
                seen.update((f, 2 * half + y) for f in own)
                seen["", 2 * half + y] += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in seen]), pa.array([k[1] for k in seen], pa.int32()),
             pa.array(list(seen.values()), pa.int64())], names=["f", "kind", "n"],
        )

    sums = [F.sum(F.when(F.col("kind") == k, F.col("n")).otherwise(0)).alias(f"n{k}") for k in range(4)]
    counted = taught.mapInArrow(count, "f string, kind int, n long").groupBy("f").agg(*sums)
    table = {r[0]: r[1:] for r in counted.where("f = '' OR n1 + n3 > 1").collect()}
    totals = table.pop("", (0, 0, 0, 0))
    pick = lambda i, j: _weights(
        {f: (sum(c[k] for k in j), sum(c[k] for k in i)) for f, c in table.items()},
        sum(totals[k] for k in j), sum(totals[k] for k in i),
    )
    clean, toxic = totals[0] + totals[2], totals[1] + totals[3]
    if not clean or not toxic:
        return Model(np.zeros((SIZE,) * 3), base=toxic / max(clean + toxic, 1))
    weights = pick((0, 2), (1, 3))
    corpus = corpus_trigrams(docs, text)
    marked = trigram_counts(w for w in weights if not w.endswith("~"))
    trigrams = np.logaddexp(_log_model(corpus), _log_model(marked)) - math.log(2)
    by_other = {0: Model(trigrams, pick((2,), (3,))), 1: Model(trigrams, pick((0,), (1,)))}

    def look(rows_: dict) -> dict:
        readers = {half: Reader(model) for half, model in by_other.items()}
        pairs = zip(rows_["text"], rows_["half"], strict=True)
        return {"x": [readers[half].evidence(t) for t, half in pairs], "y": rows_["y"]}

    lessons = sorted(map_batches(taught, look, "x array<double>, y int").collect())
    slopes, base = _logistic(np.array([r[0] for r in lessons]), np.array([r[1] for r in lessons], float))
    return Model(trigrams, weights, tuple(slopes.tolist()), base)


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """Ridge logistic regression by Newton steps."""
    z = np.column_stack([x, np.ones(len(x))])
    w, ridge = np.zeros(z.shape[1]), np.diag([0.1] * x.shape[1] + [1e-6])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + ridge, z.T @ (y - p) - ridge @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w[:-1], float(w[-1])


def score_texts(docs: DataFrame, model: Model, text: str = "text", score: str = "score") -> DataFrame:
    """``docs`` plus ``score``, from whole texts; a null text scores as an empty one, repeated rows score alike.

    A column of that name is replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = docs.drop(score)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(shared.value)
        for batch in sliced(batches):
            at = batch.schema.get_field_index(text)
            scores = pa.array([reader.score(t) for t in batch.column(at).to_pylist()], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, scores], names=[*batch.schema.names, score])

    schema = T.StructType([*kept.schema, T.StructField(score, T.DoubleType())])
    return kept.mapInArrow(run, schema)


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without those that score ``threshold`` or more; all columns as they were."""
    (score,) = unused(docs, "__score")
    return score_texts(docs, fit(docs, labels), score=score).where(F.col(score) < threshold).select(docs.columns)


def toxicity_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: whether its label was held out, its score, and the decision."""
    model = fit(docs, labels)
    return score_texts(docs.select("doc_id", "text"), model).select(
        "doc_id",
        F.coalesce(held_out("doc_id"), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
