"""Document fingerprints as Merkle trees: leaves, paragraphs, sections, root. DataFrame expressions only.

A text is sections parted by empty lines, a section is paragraphs parted by line ends, a paragraph is
leaves of up to eight words that end early with a sentence. A leaf's digest is that of its characters, every
other node's that of its children's digests. Two roots are equal where the texts are; else only the
branches that differ need a look to find the edits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from thermoweave.llm.common import cut
from thermoweave.llm.order import with_next

SECTION_END, PARAGRAPH_END = "\n\n", "\n"
# Up to seven words that end no sentence, then any word; every character lies in exactly one leaf.
LEAF = "(?: *[^ ]*[^ .!?] ){0,7}(?: *[^ ]+ ?| +)"
SHORT = 12  # hex digits of an inner digest in a fingerprint; the root has all 64


def _node(digests: Column) -> Column:
    return F.sha2(F.array_join(digests, ","), 256)


def _digests(nodes: Column) -> Column:
    return F.transform(nodes, lambda n: n["digest"])


def tree(text: Column) -> Column:
    """The tree of a text as a struct (root, sections); a null text counts as empty.

    Sections are (digest, paragraphs), paragraphs (digest, leaves), leaves short digests. It grows level by
    level, each a function of the one below, so that nothing is hashed twice.
    """
    digest = lambda leaf: F.sha2(leaf, 256)
    of_paragraph = lambda p: F.transform(F.regexp_extract_all(p, F.lit(LEAF), F.lit(0)), digest)
    of_section = lambda s: F.transform(F.split(s, PARAGRAPH_END, -1), of_paragraph)
    hashed = F.transform(F.split(F.coalesce(text, F.lit("")), SECTION_END, -1), of_section)
    paragraph = lambda ls: F.struct(_node(ls).alias("digest"), _short(ls).alias("leaves"))
    paragraphs = F.transform(hashed, lambda s: F.transform(s, paragraph))
    section = lambda ps: F.struct(_node(_digests(ps)).alias("digest"), ps.alias("paragraphs"))
    root = lambda ss: F.struct(_node(_digests(ss)).alias("root"), ss.alias("sections"))
    return F.transform(F.array(F.transform(paragraphs, section)), root)[0]


def _short(digests: Column) -> Column:
    return F.transform(digests, lambda d: F.left(d, F.lit(SHORT)))


def fingerprint(t: Column) -> Column:
    """A tree as a string: ``root:section/paragraph/leaf,leaf;paragraph/...|section/...``."""
    short = lambda node: F.left(node["digest"], F.lit(SHORT))
    paragraph = lambda p: F.concat_ws("/", short(p), F.array_join(p["leaves"], ","))
    section = lambda s: F.concat_ws(
        "/", short(s), F.array_join(F.transform(s["paragraphs"], paragraph), ";")
    )
    return F.concat_ws(":", t["root"], F.array_join(F.transform(t["sections"], section), "|"))


def leaves(t: Column) -> Column:
    """The distinct leaf digests of a tree, as numbers."""
    paragraphs = F.flatten(F.transform(t["sections"], lambda s: s["paragraphs"]))
    every = F.flatten(F.transform(paragraphs, lambda p: p["leaves"]))
    return F.transform(F.array_distinct(every), lambda d: F.conv(d, 16, 10).cast("long"))


def likeness(root_a: Column, leaves_a: Column, root_b: Column, leaves_b: Column) -> Column:
    """1 for equal roots; else the share of leaves in common, twice the common over both, below 1 always."""
    both = F.size(leaves_a) + F.size(leaves_b)
    common = 2 * F.size(F.array_intersect(leaves_a, leaves_b))
    # The same leaves in another order are another text.
    return F.when(root_a == root_b, 1.0).otherwise(F.least(common, both - 1) / F.greatest(both, F.lit(1)))


def edits(a: Column, b: Column) -> Column:
    """Places (section, paragraph), from 0, of the paragraphs of tree ``a`` that tree ``b`` lacks.

    Only sections whose digest ``b`` lacks are looked into; equal roots give none.
    """
    known_sections = _digests(b["sections"])
    known = _digests(F.flatten(F.transform(b["sections"], lambda s: s["paragraphs"])))

    def places(s: Column, i: Column) -> Column:
        found = F.transform(
            s["paragraphs"],
            lambda p, j: F.struct(
                i.alias("section"), j.alias("paragraph"), F.array_contains(known, p["digest"]).alias("kept")
            ),
        )
        lost = F.transform(F.filter(found, lambda x: ~x["kept"]), lambda x: F.struct(x["section"], x["paragraph"]))
        return F.when(F.array_contains(known_sections, s["digest"]), F.slice(lost, 1, 0)).otherwise(lost)

    every = F.flatten(F.transform(a["sections"], places))
    return F.when(a["root"] == b["root"], F.slice(every, 1, 0)).otherwise(every)


def fingerprints(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, n_chars, tree) per row; a null text counts as empty, repeated rows stay, ids may be null."""
    whole = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.col(doc_id).alias("doc_id"), F.char_length(whole).cast("long").alias("n_chars"), tree(whole).alias("tree"))


_KEY = ["__none", "__id", "__sha"]  # null ids come last; then the id; rows of one id by their text's digest


def edited_pairs(docs: DataFrame, share: int = 4, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Every document with an edited form and with the document behind it.

    Edited is a text whose last 1 / ``share`` of code points is replaced by the first as many of the next
    document (all, if it has fewer). Documents follow each other by ascending id, null ids last, rows of one id
    by the SHA-256 of their texts; behind the last comes the first. A null text counts as empty. Result:
    (doc_id, text, edited, next_root, next_leaves).

    Texts are shuffled once, by id and digest. Behind that a row sends on what the one before it
    needs: the start of its text and its leaves. Equal rows share a key; each is followed by its copy, the last
    by the next document, so copies send nothing.
    """
    own = docs.select(
        F.col(doc_id).cast("long").alias("__id"), F.coalesce(F.col(text), F.lit("")).alias("text")
    ).select(
        "text",
        F.col("__id").isNull().alias("__none"),
        F.coalesce("__id", F.lit(0)).alias("__id"),
        F.coalesce(F.unhex(F.sha2("text", 256)), F.lit(b"")).alias("__sha"),
    )
    chars = F.char_length("text")
    slim = cut(own.groupBy(*_KEY).agg(F.count(F.lit(1)).alias("copies"), F.max(chars).alias("n")))
    after = with_next(slim, _KEY, _KEY, "next")
    # To whom a document's start goes, how much of it, and to which of the copies there.
    to = [F.col(k).alias(f"to{k}") for k in _KEY]
    links = after.select(
        *[F.col(f"next.{k}").alias(k) for k in _KEY], *to,
        F.floor(F.col("n") / share).cast("int").alias("wanted"), F.col("copies").alias("to_copy"),
    )
    placed = own.withColumn("copy", F.row_number().over(Window.partitionBy(*_KEY).orderBy(*_KEY)))
    # The first copy sends. Told by a column of the other side: a filter would give this branch a shuffle of its own.
    first = F.col("copy") <= F.least("to_copy", F.lit(1))
    sent = (
        placed.join(links, _KEY).where(first)
        .select(*[F.col(f"to{k}").alias(k) for k in _KEY], "to_copy", F.left("text", "wanted").alias("start"), tree(F.col("text")).alias("t"))
        .select(*_KEY, "to_copy", "start", F.col("t.root").alias("root"), leaves(F.col("t")).alias("leaves"))
    )
    last = F.col("copy") == F.col("to_copy")
    take = F.floor(chars / share).cast("int")
    start = F.when(last, F.col("start")).otherwise(F.left("text", take))
    return placed.join(sent, _KEY).select(
        F.when(~F.col("__none"), F.col("__id")).alias("doc_id"), "text",
        F.concat(F.left("text", chars - take), start).alias("edited"),
        F.when(last, F.col("root")).alias("next_root"),
        F.when(last, F.col("leaves")).alias("next_leaves"),
    )


def fingerprint_report(documents: DataFrame) -> DataFrame:
    """Fingerprints of all documents and of their edited texts, and how alike neighbours are."""
    trees = edited_pairs(documents).withColumns({"t": tree(F.col("text")), "e": tree(F.col("edited"))})
    parts = trees.withColumns({"own": leaves(F.col("t")), "new": leaves(F.col("e"))})
    root = F.col("t.root")
    near_next = likeness(root, F.col("own"), F.col("next_root"), F.col("next_leaves"))
    return parts.select(
        "doc_id",
        F.char_length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint(F.col("t")).alias("fingerprint"),
        fingerprint(F.col("e")).alias("edited_fingerprint"),
        likeness(root, F.col("own"), F.col("e.root"), F.col("new")).alias("near_edited"),
        F.when(F.col("next_root").isNull(), 1.0).otherwise(near_next).alias("near_next"),  # its own copy is next
    )


def _tree_sql(text: str, name: str) -> str:
    return f"""
paragraphs_{name} AS (
  SELECT r, s, p, list_transform(regexp_extract_all(paragraph, '{LEAF}'), lambda x: sha256(x)) AS l
  FROM (SELECT r, s, generate_subscripts(ps, 1) AS p, unnest(ps) AS paragraph
        FROM (SELECT r, generate_subscripts(ss, 1) AS s, string_split(unnest(ss), chr(10)) AS ps
              FROM (SELECT r, string_split({text}, chr(10) || chr(10)) AS ss FROM pairs)))),
sections_{name} AS (
  SELECT r, s, sha256(string_agg(sha256(array_to_string(l, ',')), ',' ORDER BY p)) AS d,
         string_agg(left(sha256(array_to_string(l, ',')), {SHORT}) || '/' ||
                    array_to_string(list_transform(l, lambda x: left(x, {SHORT})), ','), ';' ORDER BY p) AS f,
         flatten(list(list_transform(l, lambda x: left(x, {SHORT})))) AS l
  FROM paragraphs_{name} GROUP BY r, s),
tree_{name} AS MATERIALIZED (
  SELECT r, sha256(string_agg(d, ',' ORDER BY s)) AS root, string_agg(left(d, {SHORT}) || '/' || f, '|' ORDER BY s) AS f,
         list_distinct(flatten(list(l))) AS l
  FROM sections_{name} GROUP BY r)"""


def _like_sql(a: str, b: str) -> str:
    both = f"(len({a}.l) + len({b}.l))"
    return (
        f"CASE WHEN {a}.root = {b}.root THEN 1.0::DOUBLE "
        f"ELSE least(2 * len(list_intersect({a}.l, {b}.l)), {both} - 1)::DOUBLE / greatest({both}, 1) END"
    )


REPORT_SQL = f"""
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS text, row_number() OVER (ORDER BY doc_id NULLS LAST, sha256(coalesce(text, ''))) AS r
  FROM documents),
pairs AS MATERIALIZED (
  SELECT d.r, n.r AS nr, d.doc_id, d.text,
         left(d.text, (length(d.text) - length(d.text) // 4)::BIGINT) || left(n.text, (length(d.text) // 4)::BIGINT) AS edited
  FROM docs d JOIN docs n ON n.r = CASE WHEN d.r = (SELECT max(r) FROM docs) THEN 1 ELSE d.r + 1 END),
{_tree_sql("text", "t")},
{_tree_sql("edited", "e")}
SELECT p.doc_id, length(p.text)::BIGINT AS n_chars, sha256(p.edited) AS edited_sha256, t.root || ':' || t.f AS fingerprint,
       e.root || ':' || e.f AS edited_fingerprint, {_like_sql("t", "e")} AS near_edited, {_like_sql("t", "n")} AS near_next
FROM pairs p JOIN tree_t t USING (r) JOIN tree_e e USING (r) JOIN tree_t n ON n.r = p.nr
"""
