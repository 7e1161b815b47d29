"""Near-duplicate join of texts: Jaccard similarity of their word n-grams by a MinHash LSH forest.

A document's signature is cut into trees; in each tree it has a label, a row of minima. Documents
whose labels share a prefix meet. The prefix is the longest with which a pair at the similarity
threshold is met in some tree with the target probability; it follows from the parameters, not from
the data, so labels are made at that length and hashed whole: a forest at one depth, which is banded
LSH. Documents that meet are first compared by their signatures (a pair is put aside only when its estimate lies far
below the threshold); what is left falls into small components, and within each component every
pair of different texts is compared exactly, in blocks. So a group of any size costs no row per pair.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airshed.llm.common import connected, free_name, keyed, mapped, mixed, per_group, roots, window_hashes, word_hashes, words
from airshed.session import settle

N = 5  # words in an n-gram
SIMILARITY = 0.8
TREES = 14
DEPTH = 6  # longest label
RECALL = 0.9999  # chance that a pair just at the threshold meets in some tree
DEVIATIONS = 5.5  # an estimate so many standard deviations below the threshold puts a pair aside
BLOCK_ROWS = 512  # texts compared with one another in one task at most ...
BLOCK_BYTES = 4 << 20  # ... and their bytes (a longer text is a block of its own)
SEED = 10


def prefix_length(similarity: float = SIMILARITY, trees: int = TREES, depth: int = DEPTH, recall: float = RECALL) -> int:
    """The longest prefix that reaches the recall: shortened step by step from the whole label, the same for all documents."""
    for k in range(depth, 1, -1):
        if 1 - (1 - similarity**k) ** trees >= recall:
            return k
    return 1


def _multipliers(count: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(1, 1 << 62, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def signature(grams: np.ndarray, odd: np.ndarray) -> np.ndarray:
    """The minimum of the n-gram hashes under each of the permutations, as 32 bits."""
    out = np.full(len(odd), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(grams), 2048):  # so that a very long text needs no large table
        out = np.minimum(out, (mixed(grams[at : at + 2048])[None, :] * odd[:, None]).min(axis=1))
    return (out >> np.uint64(32)).astype(np.uint32)


def grams_of(text: str | None, n: int = N) -> np.ndarray:
    return np.unique(window_hashes(word_hashes(words(text)), n))


def sketched(docs: DataFrame, trees: int, length: int, name: str) -> DataFrame:
    """docs, written once, with row_key (long), text_class (string, null without words), labels
    (array of a long per tree) and signature (binary) under names that docs doesn't have."""
    odd = _multipliers(trees * length, SEED)
    at = docs.columns.index("text")

    def fill(batch: pa.RecordBatch) -> list:
        classes, labels, signatures = [], [], []
        for value in batch.column(at):
            found = words(value.as_py())
            if not found:
                classes.append(None), labels.append(None), signatures.append(None)
                continue
            classes.append(xxhash.xxh3_128_hexdigest(b" ".join(found)))
            minima = signature(np.unique(window_hashes(word_hashes(found), N)), odd)
            signatures.append(minima.tobytes())
            labels.append([xxhash.xxh64_intdigest(x.tobytes()) >> 1 for x in minima.reshape(trees, length)])
        return [pa.array(classes, pa.string()), pa.array(labels, pa.list_(pa.int64())), pa.array(signatures, pa.binary())]

    text_class, label, sig = (free_name(docs, c) for c in ("text_class", "labels", "signature"))
    out = mapped(docs, f"`{text_class}` string, `{label}` array<bigint>, `{sig}` binary", fill)
    return keyed(out, name, free_name(out, "row_key"))


def blocks(members: DataFrame, group: str, rows: int = BLOCK_ROWS, size: int = BLOCK_BYTES) -> DataFrame:
    """members (``group``, node, bytes, ...) once for each pair of blocks they are compared in.

    Groups of one go. A group beyond the limits is dealt into blocks by a hash of the node; each
    pair of blocks is a task of its own. New columns: left, right (the blocks), side (0: left), same (left is right).
    """
    sizes = members.groupBy(group).agg(F.count("*").alias("__n"), F.sum("bytes").alias("__b")).where("__n > 1")
    count = F.greatest(F.ceil(F.col("__n") / rows), F.ceil(F.col("__b") / size)).cast("int")
    at = F.pmod(F.xxhash64("node"), F.col("__blocks")).cast("int")
    dealt = members.join(sizes.select(group, count.alias("__blocks")), group).withColumn("__at", at)
    other = F.explode(F.sequence(F.lit(0), F.col("__blocks") - 1))
    dealt = dealt.withColumn("__other", other)
    return dealt.select(
        *members.columns,
        F.least("__at", "__other").alias("left"),
        F.greatest("__at", "__other").alias("right"),
        (F.col("__at") > F.col("__other")).cast("int").alias("side"),
        (F.col("__at") == F.col("__other")).alias("same"),
    )


def sides(side: np.ndarray, same: bool) -> list[np.ndarray]:
    """Positions of the rows of the two blocks that are compared; one block is compared with itself."""
    return [np.flatnonzero(side == 0), np.flatnonzero(side == (0 if same else 1))]


def counted(hit: np.ndarray, rows: list[np.ndarray], same: bool, copies: np.ndarray, node: np.ndarray) -> list[np.ndarray]:
    """For the rows of two blocks: how many rows they are linked with, and a linked node each."""
    if same:
        np.fill_diagonal(hit, False)
    links = np.zeros(len(node), np.int64)
    links[rows[0]] += hit @ copies[rows[1]]
    if not same:
        links[rows[1]] += hit.T @ copies[rows[0]]
    a, b = np.nonzero(hit)
    return [links, node[roots(len(node), rows[0][a], rows[1][b])]]


def pair_table(left: np.ndarray, right: np.ndarray, same: bool, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of two signature tables that agree in a share of at least ``threshold``."""
    a, b = [], []
    for i in range(len(left)):
        start = i + 1 if same else 0
        alike = (right[start:] == left[i]).mean(axis=1)
        hit = np.flatnonzero(alike >= threshold) + start
        a.append(np.full(len(hit), i)), b.append(hit)
    empty = np.zeros(0, np.int64)
    return np.concatenate([empty, *a]), np.concatenate([empty, *b])


def met(sketches: DataFrame, similarity: float, trees: int, name: str) -> DataFrame:
    """Edges (a, b) that hold together what shares a label and has like enough signatures.

    sketches: node, labels, signature. One edge per node, block pair and tree at most.
    """
    by_tree = sketches.select("node", F.posexplode("labels").alias("tree", "label"))
    crowd = by_tree.groupBy("tree", "label").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    chosen = by_tree.join(crowd, ["tree", "label"]).withColumn("bucket", F.xxhash64("tree", "label"))
    members = chosen.join(sketches.select("node", "signature"), "node").select(
        "bucket", "node", F.lit(0).alias("bytes"), "signature"
    )

    def compare(part: pa.Table) -> list[np.ndarray]:
        node, side, same = (part[c].to_numpy() for c in ("node", "side", "same"))
        sig = np.frombuffer(b"".join(part["signature"].to_pylist()), np.uint32).reshape(len(node), -1)
        floor = similarity - DEVIATIONS * math.sqrt(similarity * (1 - similarity) / sig.shape[1])
        rows = sides(side, same[0])
        a, b = pair_table(sig[rows[0]], sig[rows[1]], same[0], floor)
        root = roots(len(node), rows[0][a], rows[1][b])
        tied = np.flatnonzero(root != np.arange(len(node)))
        return [node[tied], node[root[tied]]]

    dealt = blocks(members, "bucket")
    return settle(per_group(dealt, ["bucket", "left", "right"], compare, "a long, b long").distinct(), name)


def overlap(grams: list[np.ndarray], rows: list[np.ndarray]) -> np.ndarray:
    """How many n-grams each text of rows[0] shares with each of rows[1].

    N-grams that only one text has cannot be shared and are left out; the rest become columns of a
    table of zeros and ones, a slice at a time.
    """
    every = np.concatenate(grams)
    owner = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
    value, place, count = np.unique(every, return_inverse=True, return_counts=True)
    shared = count[place] > 1
    owner, place = owner[shared], np.unique(place[shared], return_inverse=True)[1]
    width = int(place.max()) + 1 if len(place) else 0
    order = np.argsort(place, kind="stable")
    owner, place = owner[order], place[order]
    total = np.zeros((len(rows[0]), len(rows[1])))
    for start in range(0, width, 4096):
        lo, hi = np.searchsorted(place, [start, start + 4096])
        table = np.zeros((len(grams), min(4096, width - start)), np.float32)
        table[owner[lo:hi], place[lo:hi] - start] = 1
        total += table[rows[0]] @ table[rows[1]].T
    return total


def linked(texts: DataFrame, similarity: float, name: str) -> DataFrame:
    """Exact comparison of every pair of texts in a component: node, links, root per block pair.

    texts: component, node, copies (rows with this text), bytes, text. links counts the rows behind
    the linked texts; root is a linked node that ties the node to its group (or itself).
    """

    def compare(part: pa.Table) -> list[np.ndarray]:
        node, copies, side, same = (part[c].to_numpy() for c in ("node", "copies", "side", "same"))
        grams = [grams_of(t.as_py()) for t in part["text"]]
        size = np.array([len(g) for g in grams], np.float64)
        rows = sides(side, same[0])
        both = overlap(grams, rows)
        hit = both >= similarity * (size[rows[0]][:, None] + size[rows[1]][None, :] - both) - 1e-9
        return [node, *counted(hit, rows, same[0], copies, node)]

    dealt = blocks(texts, "component")
    return settle(per_group(dealt, ["component", "left", "right"], compare, "node long, links long, root long"), name)


def found_in(docs: DataFrame, similarity: float, trees: int, recall: float) -> tuple[DataFrame, DataFrame, str]:
    """docs, written once, with row_key; what the join finds for each row without the other columns
    (__row, __class, __links, __group); and the name of row_key."""
    length = prefix_length(similarity, trees, DEPTH, recall)
    text_class, labels, signature = (free_name(docs, c) for c in ("text_class", "labels", "signature"))
    row_key = free_name(docs, "row_key")
    s = sketched(docs, trees, length, "ngram-sketches")
    plain = s.where(F.col(text_class).isNotNull()).select(
        F.col(row_key).alias("row"), F.col(text_class).alias("class"), F.col(labels).alias("labels"),
        F.col(signature).alias("signature"), "text",
    )
    classes = settle(
        plain.groupBy("class").agg(F.min("row").alias("node"), F.count("*").alias("copies")), "ngram-classes"
    )
    first = classes.select("node", "copies")
    sketches = plain.select(F.col("row").alias("node"), "labels", "signature").join(first.select("node"), "node", "left_semi")
    near = connected(met(sketches, similarity, trees, "ngram-met"), "ngram-near")
    near = settle(near.join(first, "node"), "ngram-candidates")
    texts = plain.select(F.col("row").alias("node"), "text").join(near, "node").select(
        "component", "node", "copies", F.length("text").cast("long").alias("bytes"), "text"
    )
    exact = linked(texts, similarity, "ngram-exact")
    links = exact.groupBy("node").agg(F.sum("links").alias("links"))
    tied = connected(exact.select(F.col("node").alias("a"), F.col("root").alias("b")), "ngram-groups")
    found = classes.join(links, "node", "left").join(tied, "node", "left").select(
        F.col("class").alias("__class"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("__links"),
        F.coalesce("component", "node").alias("__group"),
    )
    narrow = s.select(F.col(row_key).alias("__row"), F.col(text_class).alias("__class")).join(found, "__class", "left")
    narrow = narrow.select(
        "__row", "__class", F.coalesce("__links", F.lit(0)).alias("__links"), F.coalesce("__group", "__row").alias("__group")
    )
    return s.drop(text_class, labels, signature), settle(narrow, "ngram-found"), row_key


def grouped(docs: DataFrame, similarity: float = SIMILARITY, trees: int = TREES, recall: float = RECALL) -> DataFrame:
    """docs, written once, with what the join finds for each row (new names get underscores if taken):

    row_key (a number per row), text_class (rows with the same words, null without words), n_links
    (other rows whose n-grams have a Jaccard similarity of at least ``similarity``, rows of the same
    class included) and group_key (a number that rows reachable by links share).

    Null texts and texts without a word link with nothing. Texts of fewer than five words have one
    n-gram, all their words. Repeated rows are copies of one another.
    """
    rows, found, row_key = found_in(docs, similarity, trees, recall)
    names = {c: free_name(docs, c) for c in ("text_class", "n_links", "group_key")}
    return rows.join(found, F.col(row_key) == F.col("__row")).select(
        *rows.columns,
        F.col("__class").alias(names["text_class"]),
        F.col("__links").alias(names["n_links"]),
        F.col("__group").alias(names["group_key"]),
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each group, the one with the smallest doc_id, nulls last, with its own columns."""
    rows, found, row_key = found_in(docs, SIMILARITY, TREES, RECALL)
    numbered = found.join(rows.select(F.col(row_key).alias("__row"), F.col("doc_id").alias("__id")), "__row")
    order = F.struct(F.col("__id").isNull(), "__id", "__row")
    first = numbered.groupBy("__group").agg(F.min(order).alias("first")).select(F.col("first.__row").alias("__row"))
    return rows.join(first, F.col(row_key) == F.col("__row"), "left_semi").select(*docs.columns)


def joined(docs: DataFrame) -> DataFrame:
    """doc_id, class_id (smallest doc_id with the same words), n_links, component_id (smallest
    doc_id of its group) and kept (one row per group) of each document."""
    rows = grouped(docs.select("doc_id", "text")).select(
        "doc_id", "row_key", "n_links", F.col("group_key").alias("g"),
        F.coalesce("text_class", F.col("row_key").cast("string")).alias("c"),
    )
    rows = settle(rows, "ngram-rows")
    of_class = rows.groupBy("c").agg(F.min("doc_id").alias("class_id"))
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "row_key")
    of_group = rows.groupBy("g").agg(F.min("doc_id").alias("component_id"), F.min(order).alias("first"))
    return rows.join(of_class, "c").join(of_group, "g").select(
        "doc_id", "class_id", "n_links", "component_id", (F.col("row_key") == F.col("first.row_key")).alias("kept")
    )
