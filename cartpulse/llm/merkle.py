"""Document fingerprints: Merkle trees over sections and paragraphs, in native functions.

A text is cut into sections at empty lines, a section into paragraphs at line breaks, a
paragraph into blocks of ``BLOCK`` characters. Each cut can be undone, so two texts have
the same root if and only if they are the same (up to SHA-256 collisions). A node is
the SHA-256 of its kind and its children's digests.

The likeness of two fingerprints is the share of leaves they have in common: twice the
different leaves of both over the different leaves of each; two texts without any
leaf are alike by 1. ``differing_branches`` walks two trees side by side and names the
paragraphs in which they differ.

Defined cases: a null text counts as an empty one; repeated rows get a row each; rows
that share a ``doc_id`` share the next document, and the next document of an id with
several texts is the one with the least hash; a null ``doc_id`` comes last in
descending order; a single id is followed by itself; an empty table gives no rows;
further columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cartpulse.llm import tables

BLOCK = 64


def _node(kind: str, children: Column) -> Column:
    return F.sha2(F.concat(F.lit(kind), F.array_join(children, ",")), 256)


def _blocks(paragraph: Column) -> Column:
    return F.regexp_extract_all(paragraph, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))


def _cut(text: Column) -> Column:
    """Sections of paragraphs of blocks."""
    return F.transform(
        F.split(text, "\n\n"),
        lambda section: F.transform(F.split(section, "\n"), _blocks),
    )


def with_tree(df: DataFrame, text: str, into: str) -> DataFrame:
    """Add the struct ``into``: root, sections, paragraphs (per section), leaves.

    ``leaves`` are 64-bit hashes of the different blocks, for likeness; the tree is
    built from SHA-256. Each level is a column of its own, since the next one reads
    it more than once.
    """
    cut, paragraphs, sections = (
        tables.free_name(df, f"{into}_{level}") for level in ("cut", "paragraphs", "sections")
    )
    return (
        df.withColumn(cut, _cut(F.coalesce(F.col(text), F.lit(""))))
        .withColumn(
            paragraphs,
            F.transform(
                cut,
                lambda section: F.transform(
                    section,
                    lambda blocks: _node(
                        "paragraph", F.transform(blocks, lambda block: F.sha2(block, 256))
                    ),
                ),
            ),
        )
        .withColumn(sections, F.transform(paragraphs, lambda nodes: _node("section", nodes)))
        .withColumn(
            into,
            F.struct(
                _node("document", F.col(sections)).alias("root"),
                F.col(sections).alias("sections"),
                F.col(paragraphs).alias("paragraphs"),
                leaves(F.col(cut)).alias("leaves"),
            ),
        )
        .drop(cut, paragraphs, sections)
    )


def leaves(cut: Column) -> Column:
    """64-bit hashes of the different blocks of a text cut by ``_cut``."""
    return F.array_distinct(F.transform(F.flatten(F.flatten(cut)), lambda block: F.xxhash64(block)))


def likeness(first: Column, second: Column) -> Column:
    """Share of common leaves, 0 to 1."""
    both = F.size(first) + F.size(second)
    common = F.size(F.array_intersect(first, second))
    return F.when(both == 0, F.lit(1.0)).otherwise(common * F.lit(2.0) / both)


def differing_branches(first: Column, second: Column) -> Column:
    """(section, paragraph) numbers, from 0, at which two trees differ; none if roots agree.

    Sections of equal digest are not entered.
    """
    longest = F.greatest(F.size(first["sections"]), F.size(second["sections"]))

    def nodes(tree: Column, section: Column) -> Column:
        return F.coalesce(F.get(tree["paragraphs"], section), F.array().cast("array<string>"))

    def within(section: Column) -> Column:
        left, right = nodes(first, section), nodes(second, section)
        numbers = F.sequence(F.lit(0), F.greatest(F.size(left), F.size(right)) - 1)
        changed = F.filter(
            numbers, lambda p: ~F.get(left, p).eqNullSafe(F.get(right, p))
        )
        return F.transform(
            changed, lambda p: F.struct(section.alias("section"), p.alias("paragraph"))
        )

    differing = F.filter(
        F.sequence(F.lit(0), longest - 1),
        lambda s: ~F.get(first["sections"], s).eqNullSafe(F.get(second["sections"], s)),
    )
    none = F.array().cast("array<struct<section:int,paragraph:int>>")
    return F.when(first["root"] == second["root"], none).otherwise(
        F.flatten(F.transform(differing, within))
    )


def with_next(ids: DataFrame) -> DataFrame:
    """Different ids with further columns, and ``next_<column>`` of the next in descending order.

    After the last comes the first. The ids are sorted into ranges and numbered in
    each; the numbers of whole ranges are added from one row per range.
    """
    ranged = tables.stored(
        ids.repartitionByRange(tables.tasks(ids), F.desc_nulls_last("doc_id")).withColumn(
            "part", F.spark_partition_id()
        ),
        "id-ranges",
    )
    in_part = Window.partitionBy("part").orderBy(F.desc_nulls_last("doc_id"))
    parts = ranged.groupBy("part").agg(F.count("*").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    passed = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("passed"))
    total = parts.agg(F.sum("n")).first()[0] or 1
    numbered = (
        ranged.withColumn("number", F.row_number().over(in_part) - 1)
        .join(passed, "part")
        .select(*ids.columns, (F.col("passed") + F.col("number")).alias("number"))
    )
    following = numbered.select(
        F.pmod(F.col("number") - 1, F.lit(total)).alias("number"),
        *[F.col(name).alias(f"next_{name}") for name in ids.columns],
    )
    return numbered.join(following, "number").drop("number")


def fingerprints_with_edits(docs: DataFrame) -> DataFrame:
    """Every document's fingerprint, that of an edited copy, and two likenesses.

    The edit replaces the last half of the characters by as many first characters of
    the next document. Those characters and the next document's leaves travel to the
    document. Both joins read the texts by the same key and the same two columns, so
    Spark shuffles the texts once.
    """
    doc_id = F.col("doc_id").cast("long")
    half = F.floor(F.length("text") / 2).cast("int")
    source = docs.select(
        # the id as text, a null one empty: a key that plain equality can join
        F.coalesce(doc_id.cast("string"), F.lit("")).alias("key"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    known_id = F.when(F.col("key") != "", F.col("key").cast("long"))
    ids = source.groupBy("key").agg(
        F.min(F.xxhash64("text")).alias("hash"), F.max(half).alias("half")
    )
    links = with_next(ids.select(known_id.alias("doc_id"), "key", "hash", "half")).select(
        "next_key", "next_hash", F.col("key").alias("of"), "half"
    )
    # a difference, so that the hash is no part of the key and the shuffle stays the same
    is_first = F.xxhash64("text") - F.col("next_hash") == 0
    given = (
        source.join(links, (F.col("key") == F.col("next_key")) & is_first)
        .select(
            "of",
            F.substr("text", F.lit(1), F.col("half")).alias("head"),
            leaves(_cut(F.col("text"))).alias("next_leaves"),
        )
        .dropDuplicates(["of"])
    )
    n_kept = F.length("text") - half
    edited = source.join(given, F.col("key") == F.col("of")).select(
        known_id.alias("doc_id"),
        "text",
        F.concat(
            F.substr("text", F.lit(1), n_kept), F.substr("head", F.lit(1), half)
        ).alias("edited"),
        "next_leaves",
    )
    trees = with_tree(with_tree(edited, "text", "tree"), "edited", "edited_tree")
    return trees.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        F.col("tree.root").alias("fingerprint"),
        F.col("edited_tree.root").alias("edited_fingerprint"),
        likeness(F.col("tree.leaves"), F.col("edited_tree.leaves")).alias("near_edited"),
        likeness(F.col("tree.leaves"), F.col("next_leaves")).alias("near_next"),
    )
