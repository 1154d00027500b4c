"""MinHash near-dedup: one-permutation hashing, banded buckets, star-shaped candidates."""

from __future__ import annotations

import itertools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thermoweave.llm.common import SLICE_ROWS, Rounds, cut, map_batches, sliced, unused, written
from thermoweave.llm.components import components

BINS = 128
ROWS_PER_BAND = 4
BANDS = BINS // ROWS_PER_BAND
PAIRS_PER_ROW = 4  # pairs a slot for which the exact rest replaces further stars
HUB_FAMILIES = 4  # hubs that a document meets in a turn after the first
BLOCK_DOCUMENTS = 128
BLOCK_PAIRS = 8  # pairs of blocks that a task holds as Python objects
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
SHIFT = np.uint64(29)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    for _ in range(2):
        x = (x ^ (x >> np.uint64(32))) * MULTIPLIER
    return x ^ (x >> SHIFT)


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's word shingles.

    Words are the runs without ASCII white space, A-Z lower-cased. A text of fewer words is
    one shingle; a null text or one without words has none.
    """
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, parts), np.uint64, len(parts))
    n = max(len(hashes) - words + 1, 1)
    width = min(words, len(hashes))
    rolled = np.full(n, width, np.uint64)
    for k in range(width):
        rolled = mix(rolled) + hashes[k : k + n]
    return np.unique(mix(rolled))


EDGES = (np.arange(BINS + 1, dtype=object) << (64 - 7)).tolist()
LOWER = np.array(EDGES[:-1], np.uint64)


def one_permutation(sets: list[np.ndarray]) -> np.ndarray:
    """A row of ``BINS`` minima per non-empty set, empty bins filled by optimal densification.

    A set's hashes are dealt to bins by their upper bits and each bin keeps its least. An empty
    bin borrows from bins that a hash of (bin, attempt) names, the same for all
    sets, until it meets one that was filled to begin with (Shrivastava, 2017).
    """
    values = np.zeros((len(sets), BINS), np.uint64)
    full = np.zeros((len(sets), BINS), bool)
    for row, hashes in enumerate(sets):
        at = np.searchsorted(hashes, LOWER)
        full[row] = np.append(at[1:], len(hashes)) > at
        values[row] = hashes[np.minimum(at, len(hashes) - 1)]
    bins = np.arange(BINS, dtype=np.uint64)
    open_rows = np.flatnonzero(~full.all(axis=1))
    given, filled, attempt = full[open_rows], full[open_rows], 0
    out = values[open_rows]
    original = out.copy()
    rows = np.arange(len(open_rows))
    while len(rows):
        attempt += 1
        source = (mix(bins + np.uint64(attempt * BINS)) >> np.uint64(57)).astype(np.int64)
        take = ~filled[rows] & given[rows][:, source]
        out[rows] = np.where(take, original[rows][:, source], out[rows])
        filled[rows] |= take
        rows = rows[~filled[rows].all(axis=1)]
    values[open_rows] = out
    return values


def band_keys(signatures: np.ndarray) -> np.ndarray:
    """``BANDS`` bucket keys per signature, different bands never meeting by design."""
    grouped = signatures.reshape(len(signatures), BANDS, ROWS_PER_BAND)
    keys = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), grouped.shape[:2])
    for k in range(ROWS_PER_BAND):
        keys = mix(keys) + grouped[:, :, k]
    return mix(keys).view(np.int64)


def sketches(docs: DataFrame, words: int, text: str, doc_id: str) -> DataFrame:
    """(doc_id, n_shingles, print, bands) per row; print is a 128-bit hash of the whole set."""

    def sketch(rows: dict) -> dict:
        sets = [shingle_set(t, words) for t in rows["text"]]
        some = [i for i, s in enumerate(sets) if len(s)]
        bands: list = [[] for _ in sets]
        if some:
            for i, keys in zip(some, band_keys(one_permutation([sets[i] for i in some])), strict=True):
                bands[i] = keys
        return {
            "doc_id": rows["doc_id"],
            "n_shingles": [len(s) for s in sets],
            "print": [xxhash.xxh3_128_digest(s.tobytes()) for s in sets],
            "bands": bands,
        }

    narrow = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    schema = "doc_id long, n_shingles long, print binary, bands array<long>"
    return map_batches(narrow, sketch, schema, rows=SLICE_ROWS)


def confirmed(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full shingle sets reach ``percent`` of similarity.

    Texts travel, not sets, because they compress better; the right text of a run of
    rows with the same b is shingled once.
    """

    def check(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, right = (None, None), np.empty(0, np.uint64)
        for batch in sliced(batches):
            rows = batch.to_pydict()
            keep = []
            for a, b, left_text, right_text in zip(*(rows[k] for k in ("a", "b", "ta", "tb")), strict=True):
                if (b, right_text) != last:  # an id may have several texts
                    last, right = (b, right_text), shingle_set(right_text, words)
                left = shingle_set(left_text, words)
                shared = len(np.intersect1d(left, right, assume_unique=True))
                if 100 * shared >= percent * (len(left) + len(right) - shared) and shared:
                    keep.append((a, b))
            yield pa.RecordBatch.from_arrays(
                [pa.array([p[k] for p in keep], pa.int64()) for k in (0, 1)], names=["a", "b"]
            )

    left = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("ta"))
    hubs = pairs.select(F.col("b").alias("doc_id")).distinct()
    right = texts.join(hubs, "doc_id", "left_semi").select(F.col("doc_id").alias("b"), F.col("text").alias("tb"))
    return pairs.join(left, "a").join(right, "b").mapInArrow(check, "a long, b long")


def near_duplicates(
    docs: DataFrame,
    words: int = 5,
    percent: int = 80,
    text: str = "text",
    doc_id: str = "doc_id",
) -> DataFrame:
    """(doc_id, n_shingles, component_id) per row of ``docs``.

    Documents link when 100 * shared shingles >= percent * all shingles of the two.

    1. Documents with equal sets fall into one class, led by the smallest id.
    2. Leaders meet in banded buckets of their one-permutation signatures. A bucket proposes a
       star: a hub, drawn by hash, against every leader of another component. Confirmed pairs
       join components, buckets of one component are done, the others draw a new hub. So a
       large group of near-copies costs a few pairs a document.
    3. A link may still hide between two leaves. Once stars no longer halve the pairs left across
       components of a bucket, or few are left, these are compared block by block.

    At a similarity of 0.85 a pair shares no bucket with a chance of 6e-11 (0.8: 5e-8).
    Rows without an id are compared with nothing (component null); texts without words have
    n_shingles 0 and stand alone; rows that repeat an id are one document.
    """
    rows = written(sketches(docs, words, text, doc_id))
    usable = rows.where("doc_id IS NOT NULL AND n_shingles > 0")
    classes = usable.groupBy("print", "n_shingles").agg(F.min("doc_id").alias("leader"))
    member = cut(
        usable.join(classes, ["print", "n_shingles"])
        .select("doc_id", "leader")
        .distinct()
    )
    leaders = usable.join(
        member.where("doc_id = leader").select("doc_id"), "doc_id", "left_semi"
    ).dropDuplicates(["doc_id", "print"])
    slots = leaders.select(
        F.explode("bands").alias("bucket"), F.col("doc_id").alias("id"), F.col("n_shingles").alias("n")
    )
    shared = slots.groupBy("bucket").agg(F.count("*").alias("k")).where("k > 1").select("bucket")
    slot_rounds = Rounds(docs.sparkSession)
    open_slots = slot_rounds.put(slots.join(shared, "bucket").withColumn("component", F.col("id")))
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    texts = written(texts.join(open_slots.select(F.col("id").alias("doc_id")).distinct(), "doc_id", "left_semi"))
    close = F.expr(f"100 * least(n, m) >= {percent} * greatest(n, m)")
    tried = links = member.select(F.col("doc_id").alias("a"), F.col("leader").alias("b")).limit(0)
    pairs_before = None
    for turn in itertools.count():
        family = F.pmod("bucket", F.lit(HUB_FAMILIES if turn else 1))
        hub = F.min(F.struct(F.xxhash64("id", family, F.lit(turn)).alias("order"), "id", "n", "component"))
        hubs = open_slots.groupBy("bucket").agg(hub.alias("hub")).select(
            "bucket", F.col("hub.id").alias("b"), F.col("hub.n").alias("m"), F.col("hub.component").alias("c")
        )
        stars = open_slots.withColumnRenamed("id", "a").join(hubs, "bucket").where("component <> c").where(close)
        stars = cut(stars.select("a", "b").distinct().join(tried, ["a", "b"], "left_anti"))
        new = cut(confirmed(stars, texts, words, percent))
        tried, links = tried.union(stars), links.union(new)
        if not new.isEmpty():
            found: list[Rounds] = []
            open_slots = slot_rounds.put(_mixed(open_slots, components(links, found)))
            for done in found:
                done.drop()
        rows_left, pairs_left = _work_left(open_slots)
        slower = pairs_before is not None and 2 * pairs_left > pairs_before
        if new.isEmpty() or slower or pairs_left <= PAIRS_PER_ROW * rows_left:
            break
        pairs_before = pairs_left
    second = _exact_rest(open_slots, texts, words, percent)
    # Only an id that has several texts is in several classes; the classes of other ids follow their leaders.
    several = member.groupBy("doc_id").agg(F.count("*").alias("k")).where("k > 1").select("doc_id")
    several = member.join(several, "doc_id", "left_semi")
    merged = components(
        links.union(second).union(several.select(F.col("doc_id").alias("a"), F.col("leader").alias("b")))
    )
    placed = (
        member.groupBy("doc_id").agg(F.min("leader").alias("leader"))
        .join(merged.withColumnRenamed("id", "leader"), "leader", "left")
        .select("doc_id", F.coalesce("component", "leader").alias("component"))
    )
    return (
        rows.select("doc_id", "n_shingles")
        .join(placed, "doc_id", "left")
        .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
    )


def _mixed(slots: DataFrame, found: DataFrame) -> DataFrame:
    """Slots of the buckets that hold several components, with their component now."""
    placed = (
        slots.drop("component")
        .join(found, "id", "left")
        .withColumn("component", F.coalesce("component", "id"))
    )
    mixed = (
        placed.groupBy("bucket")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"))
        .where("low <> high")
        .select("bucket")
    )
    return placed.join(mixed, "bucket", "left_semi").select("bucket", "id", "n", "component")


def _work_left(slots: DataFrame) -> tuple[int, int]:
    """Slots, and pairs of slots of one bucket and different components."""
    parts = slots.groupBy("bucket", "component").agg(F.count("*").alias("k"))
    buckets = parts.groupBy("bucket").agg(F.sum("k").alias("k"), F.sum(F.col("k") * F.col("k")).alias("same"))
    return buckets.agg(
        F.coalesce(F.sum("k"), F.lit(0)), F.coalesce(F.sum(F.expr("(k * k - same) div 2")), F.lit(0))
    ).first()


def _exact_rest(slots: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Links (a, b) between components that share a bucket: at least one per pair of components that has any.

    Leaders that buckets connect form a group. A group is cut into blocks, large components into
    blocks of their own, and pairs of blocks are compared, unless both lie in one component. A pair of
    blocks is one row, whatever it holds, and answers with one link per pair of components.
    """
    hubs = slots.groupBy("bucket").agg(F.min("id").alias("b"))
    groups = components(slots.withColumnRenamed("id", "a").join(hubs, "bucket").select("a", "b"))
    placed = slots.select("id", F.col("component").alias("c")).distinct().join(groups, "id")
    sizes = placed.groupBy("component", "c").agg(F.count("*").alias("k"))
    placed = placed.join(sizes, ["component", "c"]).withColumn(
        "own", F.when(F.col("k") >= BLOCK_DOCUMENTS, F.col("c"))
    )
    room = placed.groupBy("component", "own").agg(F.count("*").alias("size"))
    placed = placed.join(
        room.withColumnsRenamed({"component": "g", "own": "o"}),
        (F.col("component") == F.col("g")) & F.col("own").eqNullSafe(F.col("o")),
    )
    chunk = F.pmod(F.xxhash64("id"), F.ceil(F.col("size") / BLOCK_DOCUMENTS))
    placed = placed.select("id", "c", "g", "o", chunk.alias("chunk"))

    def as_set(rows: dict) -> dict:
        return {"id": rows["id"], "set": [shingle_set(t, words).tobytes() for t in rows["text"]]}

    wanted = texts.join(placed.select(F.col("id").alias("doc_id")), "doc_id", "left_semi")
    sets = map_batches(wanted.select(F.col("doc_id").alias("id"), "text"), as_set, "id long, set binary", rows=SLICE_ROWS)
    blocks = placed.join(sets.dropDuplicates(["id"]), "id").groupBy("g", "o", "chunk").agg(
        *[F.collect_list(F.struct("id", "c", "set")).alias("rows")]
    )
    key = F.concat_ws(":", F.coalesce(F.col("o").cast("string"), F.lit("-")), "chunk")
    blocks = written(
        blocks.select(
            "g", "o", key.alias("key"), F.col("rows.id").alias("ids"), F.col("rows.c").alias("cs"),
            F.col("rows.set").alias("sets"),
        )
    )
    names = {"o": "o2", "key": "key2", "ids": "ids2", "cs": "cs2", "sets": "sets2"}
    pairs = blocks.join(blocks.withColumnsRenamed(names), "g").where("key <= key2").where(
        "o IS NULL OR o2 IS NULL OR o <> o2"
    )

    def compare(rows: dict) -> dict:
        out: list[tuple[int, int]] = []
        columns = ("ids", "cs", "sets", "ids2", "cs2", "sets2")
        for left_ids, left_cs, left, right_ids, right_cs, right in zip(*(rows[k] for k in columns), strict=True):
            out += block_links(left_ids, left_cs, left, right_ids, right_cs, right, percent)
        return {"a": [p[0] for p in out], "b": [p[1] for p in out]}

    pairs = pairs.select("ids", "cs", "sets", "ids2", "cs2", "sets2")
    return map_batches(pairs, compare, "a long, b long", rows=BLOCK_PAIRS)


def block_links(ids: list, cs: list, left: list, ids2: list, cs2: list, right: list, percent: int) -> list:
    """One link (id, id) for each two components that have one between these blocks."""
    sets = [np.frombuffer(x, np.uint64) for x in left]
    sizes = np.array([len(x) for x in sets])
    hashes = np.concatenate(sets)
    order = np.argsort(hashes, kind="stable")
    hashes, owner = hashes[order], np.repeat(np.arange(len(sets)), sizes)[order]
    components_, found = np.array(cs), {}
    for id2, c2, packed in zip(ids2, cs2, right, strict=True):
        own = np.frombuffer(packed, np.uint64)
        first = np.searchsorted(hashes, own, "left")
        count = np.searchsorted(hashes, own, "right") - first
        at = np.repeat(first - np.cumsum(count) + count, count) + np.arange(count.sum())
        shared = np.bincount(owner[at], minlength=len(sets))
        hit = (100 * shared >= percent * (sizes + len(own) - shared)) & (shared > 0) & (components_ != c2)
        for i in np.flatnonzero(hit):
            found.setdefault((min(cs[i], c2), max(cs[i], c2)), (ids[i], id2))
    return list(found.values())


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one document of each group of near-duplicates, that of the smallest id.

    Rows without an id stay. Rows that repeat the id of a kept document are its copies: one stays.
    """
    doc_id = options.get("doc_id", "doc_id")
    found = near_duplicates(docs, **options)
    one, n = unused(docs, "__id", "__n")
    kept = (
        found.where("doc_id = component_id")
        .groupBy(F.col("doc_id").alias(one))
        .agg(F.count("*").alias(n))
    )
    own = docs.join(kept, F.col(doc_id) == F.col(one))
    return (
        own.where(F.col(n) == 1).select(docs.columns)
        .union(own.where(F.col(n) > 1).select(docs.columns).dropDuplicates([doc_id]))
        .union(docs.where(F.col(doc_id).isNull()))
    )


def near_duplicate_report(docs: DataFrame) -> DataFrame:
    """Per document: size of its set, its component, and whether it stays."""
    return near_duplicates(docs, words=3, percent=85).select(
        "doc_id", "n_shingles", "component_id",
        (F.col("doc_id") == F.col("component_id")).alias("kept"),
    )


REPORT_SQL = r"""
WITH RECURSIVE parts AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i+1] || ' ' || w[i+2])) END AS s
  FROM parts
), items AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, any_value(x.n) AS n, any_value(y.n) AS m, count(*) AS c
  FROM items x JOIN items y ON x.g = y.g AND x.doc_id <> y.doc_id
  AND 100 * least(x.n, y.n) >= 85 * greatest(x.n, y.n)
  GROUP BY 1, 2
), links AS (SELECT a, b FROM shared WHERE 100 * c >= 85 * (n + m - c)),
walk AS (
  SELECT doc_id AS id, doc_id AS reached FROM documents
  UNION SELECT w.id, l.b FROM walk w JOIN links l ON w.reached = l.a
), lowest AS (SELECT id, min(reached) AS c FROM walk GROUP BY id)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, l.c AS component_id, s.doc_id = l.c AS kept
FROM sets s JOIN lowest l ON l.id = s.doc_id
"""
