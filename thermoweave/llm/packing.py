"""Packing token ids into fixed windows by nonnegative least squares over length combinations."""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from thermoweave.llm.common import SLICE_ROWS, cut, map_batches
from thermoweave.llm.tokens import encoder

ROWS_PER_RANK_GROUP = 1 << 16
DESCENT_STEPS = 400
GREEDY_GAP = 0.005  # a greedy window may leave this share of itself empty


@dataclass
class Plan:
    """Where the k-th remainder of each length goes.

    ``keys`` are length * 2^40 + first rank of a run of remainders, sorted; the remainder
    at rank r of the run starting at f lies at ``offsets`` in sequence ``sequences + r - f``.
    Remainders at or past ``tape_rank`` of their length lie end to end on a tape, from
    ``tape_start``, which is cut every ``window`` ids; its first sequence is ``tape_sequence``.
    """

    window: int
    keys: np.ndarray
    sequences: np.ndarray
    offsets: np.ndarray
    tape_rank: np.ndarray
    tape_start: np.ndarray
    tape_sequence: int


def combinations(window: int, counts: np.ndarray) -> np.ndarray:
    """(n, 3) lengths a >= b >= c that fill a window exactly; 0 where fewer than three do."""
    present = np.flatnonzero(counts[:window])
    present = present[present > 0]
    a, b = np.meshgrid(present, present, indexing="ij")
    a, b = a.ravel(), b.ravel()
    c = window - a - b
    fits = (a >= b) & (b >= c) & (c >= 0)
    a, b, c = a[fits], b[fits], c[fits]
    fits = (c == 0) | (counts[np.maximum(c, 0)] > 0)
    return np.stack([a, b, c], axis=1)[fits]


def solve_repeats(combos: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Nonnegative least squares: how often to repeat each combination to use up ``counts``.

    Accelerated projected gradient on ||A x - counts||^2, x >= 0, where column s of A counts
    the lengths of combination s. A is never formed: A x is a histogram, its transpose a look-up.
    """
    size = len(counts)
    weight = (combos > 0).astype(float)

    def used(x: np.ndarray) -> np.ndarray:
        return np.bincount(combos.ravel(), (weight * x[:, None]).ravel(), size)

    def back(r: np.ndarray) -> np.ndarray:
        return (r[combos] * weight).sum(axis=1)

    probe = np.ones(len(combos))
    for _ in range(30):
        probe = back(used(probe))
        step = np.linalg.norm(probe)
        probe /= step
    target = counts.astype(float)
    target[0] = 0
    x = y = np.zeros(len(combos))
    momentum = 1.0
    for _ in range(DESCENT_STEPS):
        new = np.maximum(0, y - back(used(y) - target) / (1.01 * step))
        faster = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        y = new + (momentum - 1) / faster * (new - x)
        x, momentum = new, faster
    return x


def make_plan(counts: np.ndarray, window: int, first_sequence: int) -> Plan:
    """Pack ``counts[length]`` remainders of each length below ``window``.

    Combinations take their rounded repeat counts, as far as remainders last. What is left is
    packed greedily, longest first, each window filled with the largest lengths that fit; a
    composition repeats while it lasts. Lengths that leave a larger gap go on the tape.
    """
    left = counts.astype(np.int64).copy()
    left[0] = 0
    runs: list[tuple[int, int, int, int]] = []  # length, first rank, sequence, offset
    taken = np.zeros(window, np.int64)
    sequence = first_sequence

    def place(lengths: list[int], repeats: int) -> None:
        nonlocal sequence
        offset = 0
        for length in lengths:
            runs.append((length, int(taken[length]), sequence, offset))
            taken[length] += repeats
            left[length] -= repeats
            offset += length
        sequence += repeats

    combos = combinations(window, counts)
    if len(combos):
        repeats = np.rint(solve_repeats(combos, counts)).astype(np.int64)
        for s in np.argsort(-repeats, kind="stable"):
            if repeats[s] < 1:
                break
            lengths = [int(v) for v in combos[s] if v]
            n = min(repeats[s], *(left[v] // lengths.count(v) for v in lengths))
            if n > 0:
                place(lengths, int(n))
    tape = np.zeros(window, bool)
    while True:
        open_lengths = np.flatnonzero((left > 0) & ~tape)
        if not len(open_lengths):
            break
        lengths, room = [int(open_lengths[-1])], window - int(open_lengths[-1])
        while room:
            fitting = [v for v in open_lengths[open_lengths <= room][::-1] if left[v] > lengths.count(v)]
            if not fitting:
                break
            lengths.append(int(fitting[0]))
            room -= lengths[-1]
        if room > GREEDY_GAP * window:
            tape[lengths[0]] = True
        else:
            place(lengths, int(min(left[v] // lengths.count(v) for v in lengths)))
    tape_start, at = np.zeros(window, np.int64), 0
    for length in range(window - 1, 0, -1):
        tape_start[length] = at
        at += int(left[length]) * length
    runs.sort()
    columns = np.array(runs, np.int64).reshape(-1, 4)
    return Plan(
        window, (columns[:, 0] << 40) + columns[:, 1], columns[:, 2], columns[:, 3], taken, tape_start, sequence
    )


def placed(plan: Plan, length: int, rank: int) -> list[tuple[int, int, int, int]]:
    """(start within the remainder, length, sequence, offset) of a remainder's pieces."""
    if rank < plan.tape_rank[length]:
        run = int(np.searchsorted(plan.keys, (length << 40) + rank, "right")) - 1
        ahead = (length << 40) + rank - int(plan.keys[run])
        return [(0, length, int(plan.sequences[run]) + ahead, int(plan.offsets[run]))]
    at = int(plan.tape_start[length]) + (rank - int(plan.tape_rank[length])) * length
    out, done = [], 0
    while done < length:
        part = min(length - done, plan.window - at % plan.window)
        out.append((done, part, plan.tape_sequence + at // plan.window, at % plan.window))
        done, at = done + part, at + part
    return out


def pack(
    docs: DataFrame,
    window: int = 1024,
    tokenizer: str = "byte_bpe_50k.json",
    end_id: int = 0,
    with_ids: bool = True,
    text: str = "text",
    doc_id: str = "doc_id",
) -> DataFrame:
    """Token sequences of at most ``window`` ids, as pieces.

    Per piece: doc_id, start (ids of its document before it), length, ids_crc32, doc_tokens,
    sequence_id, offset, and its ids (array<int>) unless ``with_ids`` is false. Every document
    is its ids and then ``end_id``; a null or empty text is the end id alone. Rows that repeat an
    id are packed as documents of their own, a null id too. ``padded_length`` gives what a
    sequence is padded to.

    Full windows of a document are sequences. Its remainder is packed by the lengths'
    histogram, ``window`` numbers that the driver turns into a plan; then every remainder finds its
    place by its rank within its length, which is counted in salted groups.
    """

    def split(rows: dict) -> dict:
        encode, end = encoder(tokenizer), end_id.to_bytes(4, "little")
        out: dict = {k: [] for k in ("tokens", "crcs", "body", "tail_length", "tail")}
        for text_ in rows["text"]:
            ids = encode(text_ or "") + end
            whole = len(ids) // (4 * window)
            body = ids[: 4 * window * whole]
            out["tokens"].append(len(ids) // 4)
            out["crcs"].append([zlib.crc32(body[i : i + 4 * window]) for i in range(0, len(body), 4 * window)])
            out["body"].append(body if with_ids else b"")
            out["tail_length"].append(len(ids) // 4 - whole * window)
            out["tail"].append(_halved(ids[len(body) :]))
        return {"doc_id": rows["doc_id"], **out}

    narrow = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    rows = cut(
        map_batches(
            narrow, split, "doc_id long, tokens long, crcs array<long>, body binary, tail_length long, tail binary",
            rows=SLICE_ROWS,
        )
    )
    total = rows.count()
    salts = max(1, -(-total // ROWS_PER_RANK_GROUP))
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("doc_id", "tokens"), F.lit(salts)))
    groups = salted.groupBy("salt", "tail_length").agg(
        F.count("*").alias("n"), F.sum(F.size("crcs").cast("long")).alias("whole")
    )
    groups = cut(groups)
    counts, whole = np.zeros(window, np.int64), 0
    for length, n, w in groups.groupBy("tail_length").agg(F.sum("n"), F.sum("whole")).collect():
        counts[length] = n
        whole += w
    plan = make_plan(counts, window, first_sequence=whole)

    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    per_salt = groups.groupBy("salt").agg(F.sum("whole").alias("whole"))
    per_salt = per_salt.select(
        "salt", F.coalesce(F.sum("whole").over(before(Window.orderBy("salt"))), F.lit(0)).alias("whole_before")
    )
    bases = groups.join(per_salt, "salt").select(
        "salt",
        "tail_length",
        F.coalesce(
            F.sum("n").over(before(Window.partitionBy("tail_length").orderBy("salt"))), F.lit(0)
        ).alias("rank_base"),
        (
            F.col("whole_before")
            + F.coalesce(
                F.sum("whole").over(before(Window.partitionBy("salt").orderBy("tail_length"))), F.lit(0)
            )
        ).alias("whole_base"),
    )
    order = Window.partitionBy("salt", "tail_length").orderBy("doc_id", "tokens", "tail", "crcs")
    ranked = (
        salted.withColumn("rank", F.row_number().over(order) - 1)
        .withColumn("ahead", F.coalesce(F.sum(F.size("crcs").cast("long")).over(before(order)), F.lit(0)))
        .join(bases, ["salt", "tail_length"])
        .select(
            "doc_id", "tokens", "crcs", "body", "tail_length", "tail",
            (F.col("rank") + F.col("rank_base")).cast("long").alias("rank"),
            (F.col("ahead") + F.col("whole_base")).cast("long").alias("whole"),
        )
    )

    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def lay(rows: dict) -> dict:
        out: list[tuple] = []
        for doc, tokens, crcs, body, length, tail, rank, first in zip(
            *(rows[k] for k in ("doc_id", "tokens", "crcs", "body", "tail_length", "tail", "rank", "whole")),
            strict=True,
        ):
            for i, crc in enumerate(crcs):
                ids = body[4 * window * i : 4 * window * (i + 1)]
                out.append((doc, window * i, window, crc, tokens, first + i, 0, ids))
            if length:
                ids, start = _widened(tail), tokens - length
                for at, part, sequence, offset in placed(plan, length, rank):
                    piece = ids[4 * at : 4 * (at + part)]
                    out.append((doc, start + at, part, zlib.crc32(piece), tokens, sequence, offset, piece))
        columns: dict = {n: [r[k] for r in out] for k, n in enumerate(names)}
        if with_ids:
            columns["ids"] = [np.frombuffer(r[7], "<u4").astype(np.int32) for r in out]
        return columns

    schema = ", ".join(f"{n} long" for n in names) + (", ids array<int>" if with_ids else "")
    return map_batches(ranked, lay, schema)


def _halved(ids: bytes) -> bytes:
    """Ids below 65,536 in two bytes each; a leading byte tells the width."""
    values = np.frombuffer(ids, "<u4")
    if len(values) and values.max() >= 1 << 16:
        return b"\x04" + ids
    return b"\x02" + values.astype("<u2").tobytes()


def _widened(packed: bytes) -> bytes:
    return np.frombuffer(packed, f"<u{packed[0]}", offset=1).astype("<u4").tobytes()


def padded_length(used: int, window: int = 1024) -> int:
    """A sequence is padded to the window, except at a power of two."""
    return used if used & (used - 1) == 0 else window


def packing_report(docs: DataFrame) -> DataFrame:
    """The pieces of all documents, without their ids."""
    return pack(docs, with_ids=False)
