"""Merkle manifest of a table: a tree of fanout 8 per language, and one over the languages' roots.

Method: slot pivot. The nodes of a level lie in slots 0 to 7 of their parents; conditional aggregates
spread a parent's children into eight columns, whose concatenation is hashed to the parent. What
remains of the concatenation without one slot's column are that child's siblings, so the pivots that
built the tree also give every proof: they are walked down from the root, each child taking its
parent's path and its own siblings. Only inner nodes are joined; the lowest pivots carry the
documents' ids and are opened after their last join, so paths as long as the tree is deep travel once
for eight documents. Each level is written once. A language of any size is spread over ranges.

A leaf hashes doc_id, source, lang, n_chars and text: ``-`` for null, else byte count, ``:``, value.
So null and empty text differ. Leaves ascend by doc_id (null first), rows of one doc_id by their leaf;
repeated rows are leaves of their own. A row without a doc_id is never tampered with. An empty table
has no rows and no root.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airshed.llm.order import ROWS, ranges, running
from airshed.session import settle

FANOUT = 8
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
_SLOTS = [f"s{k}" for k in range(FANOUT)]


def leaf(fields: dict[str, Column]) -> Column:
    """Lowercase hex SHA-256 of the fields, each with its length in front."""
    parts = []
    for x in fields.values():
        text = x.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@dataclass
class Tree:
    """Levels of pivots, lowest first; columns tree, at, width, s0 to s7 (struct of digest and payload)."""

    pivots: list[DataFrame]
    tops: DataFrame  # one row per tree: tree, level, digest, payload


def grow(nodes: DataFrame, name: str) -> Tree:
    """Trees over ``nodes``: tree string, at long (from 0 in the tree), width long (nodes of the tree),
    digest string, payload of any type. Single nodes are tops of their own, without a pivot."""
    pivots, tops, level = [], [], 0
    while True:
        tops.append(nodes.where("width = 1").select("tree", F.lit(level).alias("level"), "digest", "payload"))
        wider = nodes.where("width > 1")
        if (wider.agg(F.max("width")).first()[0] or 1) == 1:
            break
        child = F.struct("digest", "payload")
        pivot = wider.groupBy("tree", F.expr(f"at div {FANOUT}").alias("at")).agg(
            F.first("width").alias("width"),
            *[F.first(F.when(F.col("at") % FANOUT == k, child), ignorenulls=True).alias(s) for k, s in enumerate(_SLOTS)],
        )
        pivots.append(settle(pivot, f"{name}-{level}"))
        digest = F.sha2(F.concat_ws("", *[F.col(s)["digest"] for s in _SLOTS]), 256)
        width = F.expr(f"cast(ceil(width / {FANOUT}) as long)")
        nodes = pivots[-1].select("tree", "at", width.alias("width"), digest.alias("digest"), F.lit(None).cast("string").alias("payload"))
        level += 1
    out = tops[0]
    for t in tops[1:]:
        out = out.unionByName(t.withColumn("payload", F.lit(None).cast(out.schema["payload"].dataType)))
    return Tree(pivots, settle(out, f"{name}-tops"))


def opened(pivot: DataFrame, paths: DataFrame) -> DataFrame:
    """A row per child of the pivots: its digest and payload, and its parent's path with its siblings in front.

    A path lists, level by level from the child upwards, the digests left and right of it.
    """
    digests = [F.coalesce(F.col(s)["digest"], F.lit("")) for s in _SLOTS]

    def joined(some: list[Column]) -> Column:
        return F.concat(F.lit(""), *some)

    children = F.array(
        *[
            F.when(
                F.col(s).isNotNull(),
                F.struct(
                    (F.col("at") * FANOUT + k).alias("at"),
                    F.col(s)["digest"].alias("digest"),
                    F.col(s)["payload"].alias("payload"),
                    F.struct(joined(digests[:k]).alias("left"), joined(digests[k + 1 :]).alias("right")).alias("step"),
                ),
            )
            for k, s in enumerate(_SLOTS)
        ]
    )
    rest = [c for c in paths.columns if c not in ("tree", "at", "path")]
    return (
        pivot.join(paths, ["tree", "at"])
        .select("tree", *rest, "path", F.explode(F.array_compact(children)).alias("c"))
        .select("tree", "c.at", "c.digest", "c.payload", *rest, F.concat(F.array("c.step"), "path").alias("path"))
    )


def descend(tree: Tree, tops: DataFrame) -> DataFrame:
    """Every node of the lowest level with its path. ``tops``: tree, level, digest, payload, path and more
    columns that each node of the tree is given."""
    rest = [c for c in tops.columns if c not in ("tree", "level", "digest", "payload", "path")]
    paths = None
    for level in range(len(tree.pivots), -1, -1):
        here = tops.where(F.col("level") == level).withColumn("at", F.lit(0).cast("long"))
        here = here.select("tree", "at", "digest", "payload", *rest, "path")
        if paths is not None:
            if level:
                here = here.withColumn("payload", F.lit(None).cast(paths.schema["payload"].dataType))
            here = here.unionByName(paths)
        if not level:
            return here
        paths = opened(tree.pivots[level - 1], here.drop("digest", "payload"))
    raise AssertionError


def fold(start: Column, path: Column) -> Column:
    """The root that follows from a leaf and the digests beside its path."""
    return F.aggregate(path, start, lambda acc, x: F.sha2(F.concat(x["left"], acc, x["right"]), 256))


def digest(docs: DataFrame, rows: int = ROWS) -> DataFrame:
    """The contract's columns, a row per document; see the module for nulls, ties, repeats and empty tables."""
    fields = {c: F.col(c) for c in FIELDS}
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, F.lit(False))
    forged = F.when(tampered, leaf({**fields, "text": ascii_lower(F.col("text"))}))
    # Null sorts first, as the empty key; all other languages have a sign in front.
    key = F.coalesce(F.concat(F.lit("="), "lang"), F.lit(""))
    table = docs.select(
        key.alias("tree"), F.col("doc_id").cast("long").alias("doc_id"), leaf(fields).alias("leaf"), forged.alias("forged")
    )
    order = ["tree", "doc_id", "leaf"]
    table = ranges(table, order, "manifest-leaves", rows)
    at = running(table, ["tree"], order, {"place": F.lit(1).cast("long")}, whole={"place": "width"})
    nodes = at.select(
        "tree", (F.col("place") - 1).alias("at"), "width", F.col("leaf").alias("digest"), F.struct("doc_id", "forged").alias("payload")
    )
    leaves = grow(settle(nodes, "manifest-nodes"), "manifest")

    languages = ranges(leaves.tops.select(F.col("tree").alias("lang"), "digest"), ["lang"], "manifest-languages", rows)
    count = languages.count()
    over = running(languages, [], ["lang"], {"place": F.lit(1).cast("long")}).select(
        F.lit("").alias("tree"), (F.col("place") - 1).alias("at"), F.lit(count).cast("long").alias("width"), "digest",
        F.col("lang").alias("payload"),
    )
    forest = grow(settle(over, "manifest-over"), "manifest-top")
    top = forest.tops.select("digest").first()
    none = F.array().cast("array<struct<left:string,right:string>>")
    langs = descend(forest, forest.tops.withColumn("path", none))
    langs = langs.select(F.col("payload").alias("tree"), F.col("digest").alias("subroot"), "path")
    tops = leaves.tops.join(settle(langs, "manifest-subroots"), "tree")
    each = descend(leaves, tops)

    root = F.lit(top[0] if top else None).cast("string")
    steps = F.transform("path", lambda x: F.concat(x["left"], x["right"]))
    out = each.select(
        F.col("payload.doc_id").alias("doc_id"),
        F.col("digest").alias("leaf"),
        "subroot",
        root.alias("root"),
        F.sha2(F.array_join(steps, ""), 256).alias("proof_sha256"),
        fold(F.coalesce("payload.forged", "digest"), F.col("path")).alias("folded_root"),
    )
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
