"""Prefix trie of conversations: which share their first turns, and what sharing them would save.

A conversation c is rebuilt from the first h turns of the conversation c - c % 100 and its own turns
after its first h, h = crc32(c) % 6. A node is a distinct sequence of first turns.

Method: a node table under a minimal perfect hash. A prefix has a digest of 128 bits, the exclusive or
of a hash of each of its turns (SHA-256 of role and text) and their depths, so a conversation of any
length gets its digests by a running fold over ranges. Distinct digests are enumerated by an aggregate
that shrinks on the map side. Nodes are dealt to shards; a shard gives each digest a slot of a minimal
perfect hash, verified against the digest it holds, scatters the counts into flat arrays, looks up
each node's parent slot, and adds children to parents from the deepest nodes upwards.

A shard must hold whole subtrees of bounded size. A node's weight, the turns of its members from it on,
bounds the nodes under it. A layer is the nodes whose weights lie between two thresholds, a band
``BAND`` depths; within both, the nodes under one top are at most ``SHARD``, whatever the data: a depth
of the part above a threshold has at most weight / threshold nodes. So hot beginnings are taken apart
and the pieces added up layer by layer, one job each; nodes of all other sizes go through the same code.

Conversations are ordered by turn (null first), equal turns by the digest of role and text. Null role
or text is empty. Rows without a conv_id belong to no conversation. ``%`` keeps the sign of conv_id.
An empty table has no nodes, not even a root. Repeated rows are turns of their own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from airshed.llm.common import mixed, per_group, ship
from airshed.llm.order import ROWS, attached, ranges, running
from airshed.session import settle

STRIDE = 100  # a conversation's beginning is that of the last multiple of this
HEADS = 6  # it takes fewer turns from there than this
SHARD = 262_144  # nodes under one top
BAND = 1024  # depths
EMPTY = hashlib.sha256(b"").hexdigest()
KEY = ["depth", "x1", "x2"]


def _step(depth: Column, t: Column) -> tuple[Column, Column]:
    """What a turn at a depth adds to a prefix's digest."""
    return F.xxhash64(F.lit(11), depth, t), F.xxhash64(F.lit(29), depth, t)


def _long(value: int) -> Column:
    return F.lit(value).cast("long")


def paths(conversations: DataFrame, rows: int = ROWS) -> DataFrame:
    """A row per rebuilt conversation and depth, the root included: conv, depth, digest x1 and x2, the
    parent's p1 and p2, tokens (code points of the last text), length (turns of the conversation)."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turn = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    table = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv"), "turn", F.unhex(turn).alias("t"), F.char_length(text).cast("long").alias("tokens")
    )
    order = ["turn", "t"]
    table = ranges(table, ["conv", *order], "trie-turns", rows)
    one = _long(1)
    # What follows orders by place, which is the order of the ranges too.
    placed = settle(running(table, ["conv"], order, {"place": one}, whole={"place": "own"}).drop("turn"), "trie-places")
    h = (F.crc32(F.col("conv").cast("string").cast("binary")) % HEADS).alias("h")

    # The few turns that others may begin with, and their digests, in one row a conversation.
    first = placed.where(F.col("place") < HEADS).groupBy("conv").agg(
        F.max("own").alias("own"), F.array_sort(F.collect_list(F.struct("place", "t", "tokens"))).alias("turns")
    )
    x1, x2, head = _long(0), _long(0), []
    for k in range(HEADS - 1):
        turn = F.get("turns", F.lit(k))
        f1, f2 = _step(_long(k + 1), turn["t"])
        p1, p2, x1, x2 = x1, x2, x1.bitwiseXOR(f1), x2.bitwiseXOR(f2)
        parts = {"depth": _long(k + 1), "x1": x1, "x2": x2, "p1": p1, "p2": p2, "tokens": turn["tokens"]}
        head.append(F.when(turn.isNotNull(), F.struct(*[c.alias(n) for n, c in parts.items()])))
    bases = first.where(F.col("conv") % STRIDE == 0).select(F.col("conv").alias("base"), F.array_compact(F.array(*head)).alias("head"))
    convs = first.select("conv", "own", h, (F.col("conv") - F.col("conv") % STRIDE).alias("base")).join(bases, "base", "left")
    taken = F.slice(F.coalesce("head", F.array().cast(bases.schema["head"].dataType)), F.lit(1), F.col("h").cast("int"))
    convs = convs.select("conv", "h", taken.alias("head"), (F.size(taken) + F.greatest(F.col("own") - F.col("h"), _long(0))).alias("length"))
    convs = settle(convs, "trie-conversations")

    root = convs.select("conv", *[_long(0).alias(c) for c in (*KEY, "p1", "p2", "tokens")], "length")
    begun = convs.select("conv", F.explode("head").alias("a"), "length").select("conv", "a.*", "length")
    last = F.get("head", F.size("head") - 1)
    facts = convs.select(
        "conv", "h", "length", F.size("head").alias("taken"),
        *[F.coalesce(last[c], _long(0)).alias(b) for c, b in (("x1", "b1"), ("x2", "b2"))],
    )
    own = attached(placed.select("*", h.alias("skip")).where("place > skip").drop("own", "skip"), ["conv"], facts)
    own = own.withColumn("depth", F.col("place") - F.col("h") + F.col("taken"))
    f1, f2 = _step(F.col("depth"), F.col("t"))
    own = settle(own.select("*", f1.alias("f1"), f2.alias("f2")).drop("t", "h", "taken"), "trie-own")
    own = running(own, ["conv"], ["place"], {"y1": F.col("f1"), "y2": F.col("f2")}, F.bit_xor)
    own = own.withColumn("x1", F.col("y1").bitwiseXOR(F.col("b1"))).withColumn("x2", F.col("y2").bitwiseXOR(F.col("b2")))
    own = own.select(
        "conv", *KEY, F.col("x1").bitwiseXOR(F.col("f1")).alias("p1"), F.col("x2").bitwiseXOR(F.col("f2")).alias("p2"), "tokens", "length"
    )
    return settle(root.unionByName(begun).unionByName(own), "trie-paths")


def layered(rows: DataFrame, shard: int = SHARD, band: int = BAND) -> DataFrame:
    """The distinct nodes of ``paths``: KEY, p1, p2, tokens, conv_id, n_convs, band, layer, ``top`` (a hash
    that the nodes under one top share), and ``up``, the parent's conv_id where it is of a higher layer."""
    by_node = rows.groupBy(*KEY).agg(F.sum(F.col("length") - F.col("depth") + 1).alias("weight"), F.min("conv").alias("up"))
    factor, thresholds = max(2, shard // band), [shard]
    while thresholds[-1] < 2**62:
        thresholds.append(thresholds[-1] * factor)
    layer = sum((F.col("weight") > F.lit(t).cast("decimal(38,0)")).cast("int") for t in thresholds[:-1])
    heavy = settle(by_node.where(F.col("weight") > shard).select(*KEY, layer.alias("layer"), "up"), "trie-heavy")

    rows = rows.join(heavy, KEY, "left").withColumn("layer", F.coalesce("layer", F.lit(0)))
    rows = rows.withColumn("band", F.expr(f"depth div {band}"))
    path = W.partitionBy("conv", "band").orderBy("depth")
    begins = F.coalesce(F.lag("layer").over(path) != F.col("layer"), F.lit(True))
    rows = rows.select("*", F.lag("up").over(path).alias("above"), F.when(begins, F.xxhash64(*KEY)).alias("begin"))
    top = F.last("begin", ignorenulls=True).over(path.rowsBetween(W.unboundedPreceding, 0))
    rows = rows.withColumn("top", top)
    same = [F.min(c).alias(c) for c in ("p1", "p2", "tokens", "band", "layer", "top")]
    return rows.groupBy(*KEY).agg(*same, F.min("conv").alias("conv_id"), F.count("*").alias("n_convs"), F.min("above").alias("up"))


def _places(depth: np.ndarray, x1: np.ndarray, x2: np.ndarray, level: int, size: int) -> np.ndarray:
    seed = np.uint64((level + 1) * 0x9E3779B97F4A7C15 % 2**64)
    h = mixed(x1.view(np.uint64) + seed) ^ x2.view(np.uint64)
    return (mixed(h + depth.view(np.uint64)) % np.uint64(size)).astype(np.int64)


class Slots:
    """A minimal perfect hash of distinct 128-bit digests with depths, and the digests by slot.

    Level by level the keys left over are hashed; those alone at their place take the next slots, in
    the order of places, the others go on to a level with another seed. A look-up that ends in a slot
    is only believed if that slot holds the same key.
    """

    def __init__(self, depth: np.ndarray, x1: np.ndarray, x2: np.ndarray):
        self.levels, n = [], len(x1)
        self.slot, left, given = np.empty(n, np.int64), np.arange(n), 0
        while len(left):
            size = 2 * len(left)
            place = _places(depth[left], x1[left], x2[left], len(self.levels), size)
            alone = np.bincount(place, minlength=size) == 1
            rank = np.where(alone, given + np.cumsum(alone) - 1, -1)
            self.levels.append(rank)
            found = rank[place]
            self.slot[left[found >= 0]] = found[found >= 0]
            given, left = given + int(alone.sum()), left[found < 0]
        self.keys = [np.empty_like(c) for c in (depth, x1, x2)]
        for held, c in zip(self.keys, (depth, x1, x2), strict=True):
            held[self.slot] = c
        if not np.array_equal(self.find(depth, x1, x2), self.slot):
            raise ValueError("two nodes of a shard have one digest")

    def find(self, depth: np.ndarray, x1: np.ndarray, x2: np.ndarray) -> np.ndarray:
        """Slots of keys, -1 for keys that are not held."""
        out = np.full(len(x1), -1, np.int64)
        left = np.arange(len(x1))
        for level, rank in enumerate(self.levels):
            found = rank[_places(depth[left], x1[left], x2[left], level, len(rank))]
            out[left], left = found, left[found < 0]
        hit = out >= 0
        for held, c in zip(self.keys, (depth, x1, x2), strict=True):
            hit[hit] = held[out[hit]] == c[hit]
        out[~hit] = -1
        return out


def accumulated(part: pa.Table) -> list[np.ndarray]:
    """The columns of ``DONE`` for the nodes of one shard, by slot."""
    col = {n: part[n].to_numpy() for n in part.column_names}
    slots = Slots(col["depth"], col["x1"], col["x2"])
    flat = {}
    for n, c in col.items():
        flat[n] = np.empty_like(c)
        flat[n][slots.slot] = c
    parent = slots.find(flat["depth"] - 1, flat["p1"], flat["p2"])
    inside = parent >= 0
    kids = flat["kids"] + np.bincount(parent[inside], minlength=len(parent))
    leaves = flat["leaves"] + (kids == 0)
    saved = flat["saved"] + (flat["n_convs"] - 1) * flat["tokens"]
    order = np.argsort(flat["depth"], kind="stable")
    cuts = np.flatnonzero(np.diff(flat["depth"][order])) + 1
    for nodes in reversed(np.split(order, cuts)):
        nodes = nodes[inside[nodes]]
        np.add.at(leaves, parent[nodes], leaves[nodes])
        np.add.at(saved, parent[nodes], saved[nodes])
    up = np.where(inside, flat["conv_id"][parent], flat["up"])
    known = np.where(inside, 1, flat["known"])
    out = [flat[c] for c in (*KEY, "p1", "p2", "conv_id", "n_convs")]
    return [*out, kids, leaves, saved, up, known, inside.astype(np.int64)]


DONE = ", ".join(f"{c} long" for c in (*KEY, "p1", "p2", "conv_id", "n_convs", "kids", "leaves", "saved", "up", "known", "inside"))


def summed(nodes: DataFrame, shard: int = SHARD) -> DataFrame:
    """``layered`` nodes (a written table) with children, leaves and savings of their subtrees."""
    sizes = {(r["band"], r["layer"]): r["count"] for r in nodes.groupBy("band", "layer").count().collect()}
    done = None
    for band, layer in sorted(sizes, key=lambda s: (-s[0], s[1])):
        shards = -(-2 * sizes[band, layer] // shard)
        part = nodes.where((F.col("band") == band) & (F.col("layer") == layer)).withColumn("shard", F.expr(f"pmod(top, {shards}L)"))
        part = part.withColumn("known", F.col("up").isNotNull().cast("long")).withColumn("up", F.coalesce("up", _long(0)))
        sums = ["kids", "leaves", "saved"]
        if done is None:
            part = part.select("*", *[_long(0).alias(c) for c in sums])
        else:
            below = done.where((F.col("inside") == 0) & (F.col("depth") > 0))
            below = below.groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("x1"), F.col("p2").alias("x2")).agg(
                F.count("*").alias("kids"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")
            )
            part = part.join(below, KEY, "left").fillna(0, sums)
        part = part.select("shard", *KEY, "p1", "p2", "tokens", "conv_id", "n_convs", "up", "known", *sums)
        new = settle(per_group(part, ["shard"], accumulated, DONE), "trie-done")
        done = new if done is None else done.unionByName(new)
    if done is None:
        done = nodes.sparkSession.createDataFrame([], DONE)
    if any(band for band, _ in sizes):  # parents in the band above, whose children are bounded by their weight or known
        lost = (F.col("known") == 0) & (F.col("depth") > 0)
        parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("x1").alias("p1"), F.col("x2").alias("p2"), F.col("conv_id").alias("over"))
        found = done.where(lost).join(parents, ["depth", "p1", "p2"]).withColumn("up", F.col("over")).select(*done.columns)
        done = done.where(~lost).unionByName(found)
    return done


def ends(rows: DataFrame, count: int = ROWS) -> DataFrame:
    """Per node that is the end of conversations: SHA-256 of their ids, ascending, joined by commas.

    Ids are sorted in ranges, a range joins its ids of a node to one text, and these texts, in order, are
    hashed as a stream; the ids of a node that a third of all conversations end at are never held together.
    """
    ship(rows.sparkSession)
    last = rows.where("depth = length").select(*KEY, "conv")
    parts = -(-max(last.count(), 1) // count)
    pieces = last.repartitionByRange(parts, *KEY, "conv").sortWithinPartitions(*KEY, "conv")
    key = ", ".join(f"{c} long" for c in KEY)
    pieces = pieces.mapInArrow(_joined, f"{key}, begin long, ids string")
    return pieces.repartition(*KEY).sortWithinPartitions(*KEY, "begin").mapInArrow(_hashed, f"{key}, ends_sha256 string")


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            key = np.stack([batch[c].to_numpy() for c in KEY])
            cuts = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1
            starts = np.concatenate([[0], cuts])
            conv = batch["conv"].to_numpy()
            ids = [",".join(map(str, c)) for c in np.split(conv, cuts)]
            yield pa.RecordBatch.from_arrays(
                [*[pa.array(k[starts]) for k in key], pa.array(conv[starts]), pa.array(ids)], names=[*KEY, "begin", "ids"]
            )


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    at, state = None, None

    def out(found: list) -> pa.RecordBatch:
        columns = list(zip(*[(*k, h) for k, h in found], strict=True)) or [()] * 4
        types = [pa.int64()] * 3 + [pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=[*KEY, "ends_sha256"])

    for batch in batches:
        found = []
        for *key, ids in zip(*[batch[c].to_pylist() for c in KEY], batch["ids"].to_pylist(), strict=True):
            if key != at:
                if state:
                    found.append((at, state.hexdigest()))
                at, state = key, hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        if found:
            yield out(found)
    if state:
        yield out([(at, state.hexdigest())])


def digest(conversations: DataFrame, rows: int = ROWS, shard: int = SHARD, band: int = BAND) -> DataFrame:
    """The contract's columns, a row per node; see the module for nulls, ties, repeats and empty tables."""
    every = paths(conversations, rows)
    done = summed(settle(layered(every, shard, band), "trie-nodes"), shard)
    return done.join(ends(every, rows), KEY, "left").select(
        "conv_id",
        "depth",
        F.when(F.col("depth") > 0, F.col("up")).alias("parent_conv_id"),
        "n_convs",
        F.col("kids").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256"),
    )
