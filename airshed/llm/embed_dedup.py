"""Near-duplicate vectors by sorted projection passes.

In each pass every vector gets a key, the signs of its projections on random directions one after
the other, and the vectors of a label are ordered by these keys: like vectors often stand close
together. Each is compared with a bounded window of its neighbours, and verified pairs of all
passes are united. The number of passes follows from the number of vectors, so that a pair just at
the threshold is met with the target probability: it agrees in the first signs of some key. Vectors
that agree in them and are more than a window holds, as where those of a label share a direction,
are compared in blocks, all of them with one another; where these would be more pairs than the label
has, all of the label's. Within the groups so found, all pairs are then compared in blocks: the
bound of the window costs no link. Equal vectors are compared once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airshed.llm.common import connected, mapped, per_group, roots
from airshed.llm.ngram_join import blocks, counted, sides
from airshed.session import settle

COSINE = 0.93
WINDOW = 64  # neighbours on one side
BITS = 48  # signs in a key
RECALL = 0.9995
PART = 20_000  # vectors that one task orders and compares
RUN_ROWS = 8192  # vectors of a long run compared with one another in one task at most ...
RUN_BYTES = 16 << 20  # ... and their bytes
MARGIN = 1e-5  # single precision is enough to find pairs; the blocks decide in double
SEED = 6


def passes(vectors: int, cosine: float = COSINE, window: int = WINDOW, recall: float = RECALL) -> int:
    """How many orders are needed until a pair at the threshold falls into some window.

    Two vectors stand within a window when their keys agree until fewer than ``window`` of the
    vectors are left, that is in log2(vectors / window) signs, each with probability 1 - angle / pi.
    """
    same = 1 - math.acos(cosine) / math.pi
    met = same ** max(1.0, math.log2(max(vectors, 1) / window) + 1)
    return max(2, math.ceil(math.log(1 - recall) / math.log(1 - met)))


def prefix_bits(vectors: int, window: int = WINDOW) -> int:
    """The signs that ``passes`` counts on: a pair that agrees in them in some pass is compared."""
    return int(max(1.0, math.log2(max(vectors, 1) / window) + 1))


def directions(dim: int, number: int) -> np.ndarray:
    return np.random.default_rng((SEED, dim, number)).standard_normal((dim, BITS))


def unit(flat: np.ndarray, dim: int) -> np.ndarray:
    x = flat.reshape(-1, dim).astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # so that squares neither overflow nor vanish
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def table_of(part: pa.Table | pa.RecordBatch, column: str) -> np.ndarray:
    values = part.column(column)
    values = values.combine_chunks() if isinstance(values, pa.ChunkedArray) else values
    return values.flatten().to_numpy()


def classes_of(vectors: DataFrame, vec_id: str, embedding: str, label: str) -> DataFrame:
    """One row for each vector that can link: node (long), label, dim, copies, first_id, embedding.

    Left out are null, empty and zero vectors, those with null or non-finite components, and null labels.
    """
    value = F.col("embedding")
    bad = F.exists(value, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists(value, lambda x: x != 0)
    usable = vectors.select(
        F.col(vec_id).alias("vec_id"), F.col(embedding).cast("array<double>").alias("embedding"), F.col(label).alias("label")
    ).where(value.isNotNull() & F.col("label").isNotNull())
    usable = usable.where(~bad & some)
    one = usable.groupBy("label", "embedding").agg(F.count("*").alias("copies"), F.min("vec_id").alias("first_id"))
    # A class's number is fixed by writing the classes.
    return settle(one.select(F.monotonically_increasing_id().alias("node"), "label", F.size("embedding").alias("dim"),
                             "copies", "first_id", "embedding"), "vector-classes")


def with_keys(classes: DataFrame, count: int) -> DataFrame:
    """classes with keys, an array of a long for each of ``count`` passes."""
    at = {c: classes.columns.index(c) for c in ("dim", "embedding")}
    shape = pa.list_(pa.int64())

    def keys(batch: pa.RecordBatch) -> list:
        dims = batch.column(at["dim"]).to_numpy()
        flat = table_of(batch, "embedding")
        starts = np.concatenate([[0], np.cumsum(dims)])
        out = np.zeros((len(dims), count), np.int64)
        for dim in np.unique(dims):
            rows = np.flatnonzero(dims == dim)
            x = unit(flat[(starts[rows][:, None] + np.arange(dim)).ravel()], dim)
            for n in range(count):
                signs = (x @ directions(int(dim), n)) > 0
                out[rows, n] = signs @ (1 << np.arange(BITS - 1, -1, -1, dtype=np.int64))
        return [pa.array(list(out), shape)]

    return mapped(classes, "`keys` array<bigint>", keys)


def met(classes: DataFrame, cosine: float, count: int, total: int) -> DataFrame:
    """Edges (a, b) of verified neighbours in ``count`` orders; each vector has one edge a pass and batch at most."""
    ordered = with_keys(classes, count).select(
        "node", "label", "dim", F.col("embedding").cast("array<float>").alias("near"), F.posexplode("keys").alias("pass", "key")
    )
    order = ["pass", "label", "dim", "key"]
    parts = max(1, -(-total * count // PART))
    ordered = ordered.repartitionByRange(parts, *order).sortWithinPartitions(*order)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            part = pa.Table.from_batches([batch])
            part = pa.concat_tables([held, part]).combine_chunks() if held is not None else part
            held = part.slice(max(0, part.num_rows - WINDOW))
            group = part.group_by(["pass", "label", "dim"]).aggregate([("node", "count")])
            starts = np.concatenate([[0], np.cumsum(group["node_count"].to_numpy())])
            dims = group["dim"].to_numpy()
            node, found = part["node"].to_numpy(), []
            for dim, lo, hi in zip(dims, starts, starts[1:], strict=False):
                x = unit(table_of(part.slice(lo, hi - lo), "near"), int(dim)).astype(np.float32)
                for step in range(1, min(WINDOW, hi - lo - 1) + 1):
                    hit = np.flatnonzero((x[:-step] * x[step:]).sum(axis=1) >= cosine - MARGIN)
                    found.append(np.stack([hit, hit + step]) + lo)
            a, b = np.concatenate([np.zeros((2, 0), np.int64), *found], axis=1)
            root = roots(len(node), a, b)
            tied = np.flatnonzero(root != np.arange(len(node)))
            yield pa.RecordBatch.from_arrays([pa.array(node[tied]), pa.array(node[root[tied]])], names=["a", "b"])

    return settle(ordered.mapInArrow(compare, "a long, b long").distinct(), "vector-met")


def long_runs(classes: DataFrame, near: DataFrame, count: int, bits: int) -> DataFrame | None:
    """run, node: the vectors that agree in the first ``bits`` signs of a pass, where they are more than
    a window holds and not yet united. None if there are none.

    A label whose runs have more pairs than itself is one run instead, so no distribution of
    the vectors costs more than comparing all pairs.
    """
    at = ["label", "dim", "pass", "prefix"]
    place = with_keys(classes.select("node", "label", "dim", "embedding"), count).select(
        "node", "label", "dim", F.posexplode("keys").alias("pass", "key")
    )
    place = place.select("node", "label", "dim", "pass", F.shiftright("key", BITS - bits).alias("prefix"))
    own = F.coalesce("component", "node")
    runs = place.join(near, "node", "left").groupBy(*at).agg(F.count("*").alias("n"), F.min(own).alias("a"), F.max(own).alias("b"))
    runs = settle(runs.where((F.col("n") > WINDOW + 1) & (F.col("a") < F.col("b"))).drop("a", "b"), "vector-runs")
    if runs.isEmpty():
        return None
    pairs = runs.groupBy("label", "dim").agg(F.sum(F.col("n") * F.col("n")).alias("pairs"))
    sizes = classes.groupBy("label", "dim").agg(F.count("*").alias("all"))
    whole = settle(pairs.join(sizes, ["label", "dim"]).where(F.col("pairs") >= F.col("all") * F.col("all")).select("label", "dim"), "vector-whole")
    some = place.join(runs.drop("n"), at).join(whole, ["label", "dim"], "left_anti")
    every = classes.join(whole, ["label", "dim"])
    return some.select(F.xxhash64(*at).alias("run"), "node").unionByName(every.select(F.xxhash64("label", "dim").alias("run"), "node"))


def met_in_runs(classes: DataFrame, runs: DataFrame, cosine: float) -> DataFrame:
    """Edges (a, b) that hold together what is like enough in each run."""

    def compare(part: pa.Table) -> list[np.ndarray]:
        node, side, same, dim = (part[c].to_numpy() for c in ("node", "side", "same", "dim"))
        x = unit(table_of(part, "near"), int(dim[0])).astype(np.float32)
        rows = sides(side, same[0])
        root = np.arange(len(node))
        for start in range(0, len(rows[0]), 256):
            i, j = np.nonzero(x[rows[0][start : start + 256]] @ x[rows[1]].T >= cosine - MARGIN)
            a, b = root[rows[0][start + i]], root[rows[1][j]]
            new = a != b
            if new.any():
                root = roots(len(node), a[new], b[new])[root]
        tied = np.flatnonzero(root != np.arange(len(node)))
        return [node[tied], node[root[tied]]]

    vectors = classes.select(
        "node", "dim", (F.col("dim") * 4).cast("long").alias("bytes"), F.col("embedding").cast("array<float>").alias("near")
    )
    members = runs.join(vectors, "node").select("run", "node", "bytes", "dim", "near")
    dealt = blocks(members, "run", RUN_ROWS, RUN_BYTES)
    return settle(per_group(dealt, ["run", "left", "right"], compare, "a long, b long").distinct(), "vector-met")


def linked(members: DataFrame, cosine: float) -> DataFrame:
    """Every pair of a component in double precision: node, links, root per pair of blocks."""

    def compare(part: pa.Table) -> list[np.ndarray]:
        node, copies, side, same, dim = (part[c].to_numpy() for c in ("node", "copies", "side", "same", "dim"))
        x = unit(table_of(part, "embedding"), int(dim[0]))
        rows = sides(side, same[0])
        hit = x[rows[0]] @ x[rows[1]].T >= cosine
        return [node, *counted(hit, rows, same[0], copies, node)]

    dealt = blocks(members, "component", rows=2048)
    return settle(per_group(dealt, ["component", "left", "right"], compare, "node long, links long, root long"), "vector-links")


def deduplicated(
    vectors: DataFrame, cosine: float = COSINE, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label"
) -> DataFrame:
    """vec_id, n_links, component_id, kept of each row of vectors.

    Only vectors of equal, not null label and equal length are compared. Vectors that cannot link
    (null, empty, zero, null or non-finite components, null label) have no links and are kept, each
    its own component. Repeated rows are copies, linked with one another; a null id counts as a
    vector, but names a component only if there is no other id. An empty table gives no rows.
    """
    classes = classes_of(vectors, vec_id, embedding, label)
    total = classes.count()
    largest = classes.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    count = passes(largest, cosine)
    edges = met(classes, cosine, count, total)
    near = settle(connected(edges, "vector-near"), "vector-near")
    runs = long_runs(classes, near, count, prefix_bits(largest))
    if runs is not None:
        near = connected(edges.unionByName(met_in_runs(classes, runs, cosine)), "vector-near")
    members = classes.join(near, "node").select(
        "component", "node", "copies", "dim", (F.col("dim") * 8).cast("long").alias("bytes"), "embedding"
    )
    exact = linked(members, cosine)
    links = exact.groupBy("node").agg(F.sum("links").alias("links"))
    tied = connected(exact.select(F.col("node").alias("a"), F.col("root").alias("b")), "vector-groups")
    found = classes.join(links, "node", "left").join(tied, "node", "left").select(
        "node", "label", "embedding", "first_id",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component", "node").alias("group"),
    )
    found = settle(found, "vector-found")
    smallest = found.groupBy("group").agg(F.min("first_id").alias("component_id"))
    found = found.join(smallest, "group").select("label", "embedding", "n_links", "component_id")
    rows = vectors.select(
        F.col(vec_id).alias("vec_id"), F.col(label).alias("__label"), F.col(embedding).cast("array<double>").alias("__embedding")
    )
    same = (F.col("__label") == F.col("label")) & (F.col("__embedding") == F.col("embedding"))
    out = rows.join(found, same, "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").cast("long").alias("component_id"),
    )
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
