"""Mixing documents to target domain weights by soft membership.

A classifier learned from a labelled table gives every document its domain posteriors. Document rates
are then fitted so that the expected tokens of every domain meet its target. Everything is DataFrame
operations; the driver sees numbers per domain only.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from thermoweave.llm.common import ascii_lower, cut

BUCKETS = 2048  # word hash buckets of the classifier
TRAINING_ROWS = 20_000  # labelled documents it is fitted on, those of the smallest hashes
DENSE_DOMAINS = 64  # up to so many, a step takes all domain pairs in one row; above, it is solved by passes of one sum per domain
EVIDENCE = 25.0  # words whose evidence a posterior takes in at most, however long the text
SMOOTHING = 0.5
TEMPER = 0.7
STEPS, TOLERANCE = 25, 1e-6

ROW_KEY = ("__d", "__t1", "__t2")


def _keyed(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """``docs`` with the columns that tell rows apart: the id and a 128-bit hash of the text."""
    return docs.withColumns(
        {"__d": F.col(doc_id).cast("long"), "__t1": F.xxhash64(text), "__t2": F.xxhash64(F.lit(1), F.col(text))}
    )


def _join_rows(left: DataFrame, right: DataFrame) -> DataFrame:
    """Left join on the row key; the right side's key columns go."""
    other = right.withColumnsRenamed({k: f"r{k}" for k in ROW_KEY})
    same = F.col("__d").eqNullSafe(F.col("r__d"))
    for k in ROW_KEY[1:]:
        same = same & (F.col(k) == F.col(f"r{k}"))
    return left.join(other, same, "left").drop(*other.columns[:3], *ROW_KEY)


def _words(text: str) -> Column:
    lowered = ascii_lower(F.coalesce(F.col(text), F.lit("")))
    return F.filter(F.split(lowered, r"[ \t\n\x0B\f\r]+"), lambda w: w != "")


def _added(terms: list[Column]) -> Column:
    """Sum of columns; many are added as a tree, as deep expressions overflow the planner's stack."""
    if len(terms) <= DENSE_DOMAINS:
        return sum(terms, F.lit(0.0))
    half = len(terms) // 2
    return _added(terms[:half]) + _added(terms[half:])


def _bucket(word: str) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(BUCKETS))


def learn(docs: DataFrame, labelled: DataFrame, rows: int, text: str, doc_id: str) -> tuple[list[str], DataFrame, dict]:
    """Domains, log probabilities (bucket, one column per domain), and log priors.

    ``labelled`` has (doc_id, domain); null ones are ignored, a document labelled twice has its
    smallest domain.
    """
    known = (
        labelled.where(F.col(doc_id).isNotNull() & F.col("domain").isNotNull())
        .groupBy(F.col(doc_id).cast("long").alias("__id")).agg(F.min("domain").alias("domain"))
        .orderBy(F.xxhash64("__id"), "__id").limit(rows)
    )
    taught = docs.select(F.col(doc_id).cast("long").alias("__id"), F.col(text).alias("__text")).join(known, "__id")
    sizes = {r[0]: r[1] for r in taught.groupBy("domain").count().orderBy("domain").collect()}
    names = list(sizes)
    counts = (
        taught.select("domain", F.explode(_words("__text")).alias("w"))
        .groupBy(_bucket("w").alias("bucket"), "domain").count()
    )
    columns = [
        F.coalesce(F.sum(F.when(F.col("domain") == name, F.col("count"))), F.lit(0)).alias(f"n{k}")
        for k, name in enumerate(names)
    ]
    counts = cut(counts.groupBy("bucket").agg(*columns)) if names else None
    if counts is None:
        return names, None, {}
    totals = counts.agg(*[F.coalesce(F.sum(f"n{k}"), F.lit(0)) for k in range(len(names))]).first()
    table = docs.sparkSession.range(BUCKETS).withColumnRenamed("id", "bucket").join(counts, "bucket", "left")
    logs = [
        F.log((F.coalesce(F.col(f"n{k}"), F.lit(0)) + SMOOTHING) / (totals[k] + SMOOTHING * BUCKETS)).alias(f"l{k}")
        for k in range(len(names))
    ]
    return names, table.select("bucket", *logs), {k: np.log(sizes[n] / sum(sizes.values())) for k, n in enumerate(names)}


def memberships(
    docs: DataFrame, labelled: DataFrame, rows: int = TRAINING_ROWS, text: str = "text", doc_id: str = "doc_id"
) -> tuple[list[str], DataFrame]:
    """Domains, and per distinct row its key, copies, tokens (words) and posteriors p0, p1, ...

    Naive Bayes over hashed words, whose evidence is averaged and counted as that of at most
    ``EVIDENCE`` words, so that long texts keep soft memberships. A text without words has the priors.
    """
    names, table, priors = learn(docs, labelled, rows, text, doc_id)
    keyed = _keyed(docs.select(F.col(doc_id), F.col(text)), text, doc_id)
    words = keyed.select(*ROW_KEY, F.posexplode_outer(_words(text)).alias("pos", "w"))
    words = words.withColumn("bucket", _bucket("w"))
    own = [F.sum(F.when(F.col("w").isNotNull(), F.col(f"l{k}"))).alias(f"s{k}") for k in range(len(names))]
    joined = words if table is None else words.join(F.broadcast(table), "bucket", "left")
    summed = joined.groupBy(*ROW_KEY).agg(
        F.count("w").alias("n"), F.sum(F.when(F.coalesce("pos", F.lit(0)) == 0, 1)).alias("copies"), *own
    )
    weight = F.least(F.lit(1.0), F.lit(EVIDENCE) / F.col("n"))
    logits = [
        F.when(F.col("n") > 0, F.col(f"s{k}") * weight).otherwise(0.0) + F.lit(float(priors[k])) for k in range(len(names))
    ]
    scored = summed.select(*ROW_KEY, "copies", (F.col("n") / F.col("copies")).alias("tokens"),
                           *[x.alias(f"z{k}") for k, x in enumerate(logits)])
    if not names:
        return names, scored
    top = F.greatest(*[f"z{k}" for k in range(len(names))]) if len(names) > 1 else F.col("z0")
    scored = scored.withColumn("__top", top)
    total = _added([F.exp(F.col(f"z{k}") - F.col("__top")) for k in range(len(names))])
    return names, scored.select(
        *ROW_KEY, "copies", "tokens",
        *[(F.exp(F.col(f"z{k}") - F.col("__top")) / total).alias(f"p{k}") for k in range(len(names))],
    )


def default_targets(natural: np.ndarray) -> np.ndarray:
    """Tempered shares: small domains gain, large ones lose."""
    tempered = np.maximum(natural, 0) ** TEMPER
    return tempered / tempered.sum()


def _dot(p: list[Column], v: np.ndarray) -> Column:
    return _added([x * F.lit(float(m)) for x, m in zip(p, v, strict=True)])


def _solve(along: Callable[[np.ndarray], np.ndarray], error: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """x with ``along(x)`` = ``error``, by conjugate gradients on a symmetric product scaled by ``scale``."""
    x, rest = np.zeros_like(error), error.copy()
    z = rest / scale
    way, size = z.copy(), float(rest @ z)
    first = size
    for _ in range(len(error)):
        if size <= 1e-12 * first:
            break
        image = along(way)
        step = size / float(way @ image)
        x += step * way
        rest -= step * image
        z = rest / scale
        size, before = float(rest @ z), size
        way = z + size / before * way
    return x


def fit_rates(members: DataFrame, size: int, targets: np.ndarray, least: float) -> DataFrame:
    """``members`` with ``rate`` >= ``least``, by projected gradient on the domains' squared errors.

    A step adds to every rate the posteriors' mix of one number per domain, then projects. These numbers
    are the gradient, scaled by the domains' curvature over the rates that are free to move. One
    aggregate per step gives both; it ends when no total moves any more. Above ``DENSE_DOMAINS`` the curvature
    is never written out: conjugate gradients solve the same step, and each of their passes
    aggregates one sum per domain.
    """
    sums = lambda df, cells: np.array(
        [float(v or 0) for v in df.agg(*[F.sum(c) for c in cells]).first()]
    )
    p = [F.col(f"p{k}") for k in range(size)]
    mass = F.col("tokens") * F.col("copies")
    rated = members.withColumn("rate", F.lit(1.0) if least <= 1 else F.lit(float(least)))
    before = None
    for step in range(STEPS):
        free = F.when(F.col("rate") > least, mass).otherwise(0.0) if step else mass
        dense = size <= DENSE_DOMAINS
        pairs = [free * x * y for x in p for y in p] if dense else [free * x for x in p]
        found = sums(rated, [mass * F.col("rate") * x for x in p] + pairs)
        totals, curve = found[:size], found[size:]
        error = targets - totals
        worst = np.abs(error).max() / max(targets.max(), 1e-300)
        if worst < TOLERANCE or (before is not None and abs(before - worst) < TOLERANCE):
            break
        before = worst
        if dense:
            curve = curve.reshape(size, size)
            ridge = 1e-9 * max(np.trace(curve), 1e-300) * np.eye(size)
            move = np.linalg.solve(curve + ridge, error)
        else:
            # Posteriors sum to 1, so the sums of a domain are its row of the curvature added up.
            ridge = 1e-9 * max(curve.sum(), 1e-300)
            along = lambda v: sums(
                rated, [free * _dot(p, v) * x for x in p]
            ) + ridge * v
            move = _solve(along, error, curve + ridge)
        change = _dot(p, move)
        rated = rated.withColumn("rate", F.greatest(F.lit(float(least)), F.col("rate") + change))
        if step % 4 == 3 or not dense:
            rated = cut(rated)
    return rated


def mix(
    docs: DataFrame,
    labelled: DataFrame,
    targets: Mapping[str, float] | None = None,
    budget: float | None = None,
    least: float = 0.0,
    rows: int = TRAINING_ROWS,
    text: str = "text",
    doc_id: str = "doc_id",
) -> DataFrame:
    """``docs`` plus n_tokens, rate, copies, domain (the likeliest) and membership (its posterior).

    Rates are nonnegative (at least ``least``) and such that, as nearly as can be in the least-squares
    sense, the expected tokens of each domain are ``budget`` times its target weight.
    Without ``targets`` the weights are the tempered natural shares; without ``budget`` it is the
    least at which no domain loses tokens. ``copies`` is the rate rounded up or down by a hash of the
    row, so that its expectation is the rate. Without labelled documents every rate is 1.

    Tokens are words. Rows that repeat an id and a text share their rate.
    """
    names, members = memberships(docs, labelled, rows, text, doc_id)
    size = len(names)
    if size:
        members = cut(members)
        mass = F.col("tokens") * F.col("copies")
        natural = members.agg(*[F.sum(mass * F.col(f"p{k}")) for k in range(size)]).first()
        natural = np.array([float(v or 0) for v in natural])
        share = default_targets(natural) if targets is None else np.array([float(targets.get(n, 0)) for n in names])
        if natural.sum() and share.sum():
            share = share / share.sum()
            some = (share > 0) & (natural > 0)
            total = budget if budget is not None else float((natural[some] / share[some]).max())
            rated = fit_rates(members, size, share * total, least)
        else:
            rated = members.withColumn("rate", F.lit(1.0))
        best = F.greatest(*[f"p{k}" for k in range(size)]) if size > 1 else F.col("p0")
        rated = rated.withColumn("membership", best)
        domain = F.coalesce(*[F.when(F.col(f"p{k}") == F.col("membership"), F.lit(n)) for k, n in enumerate(names)])
        rated = rated.withColumn("domain", domain)
    else:
        rated = members.withColumns(
            {"rate": F.lit(1.0), "membership": F.lit(None).cast("double"), "domain": F.lit(None).cast("string")}
        )
    point = F.pmod(F.xxhash64(F.lit(7), *ROW_KEY), F.lit(1 << 30)) / F.lit(float(1 << 30))
    new = rated.select(
        *ROW_KEY, F.round("tokens").cast("long").alias("n_tokens"), "rate",
        (F.floor("rate") + F.when(point < F.col("rate") - F.floor("rate"), 1).otherwise(0)).cast("long").alias("copies"),
        "domain", "membership",
    )
    old = docs.drop("n_tokens", "rate", "copies", "domain", "membership")
    return _join_rows(_keyed(old, text, doc_id), new)


def repeat_by_rate(docs: DataFrame, labelled: DataFrame, **options) -> DataFrame:
    """``docs``, each row as often as its ``copies`` say."""
    rated = mix(docs, labelled, **options)
    times = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    return rated.where("copies > 0").withColumn("__time", times).select(docs.columns)


def quality_domains(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, domain) of labelled documents: their language and whether their quality is good."""
    good = F.when(F.col("quality") == 1, "good").otherwise("poor")
    known = labels.where("quality IS NOT NULL").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    return docs.select("doc_id", "lang").join(known, "doc_id").select(
        "doc_id", F.concat_ws("-", F.coalesce("lang", F.lit("other")), good).alias("domain")
    )


def mixing_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: tokens, likeliest domain and its posterior, rate and copies."""
    return mix(docs.select("doc_id", "text"), quality_domains(docs, labels)).drop("text")
