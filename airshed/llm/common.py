"""What several corpus operators share: words, row keys, components, exact selection."""

from __future__ import annotations

import math
import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airshed.session import settle

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = ASCII_UPPER.lower()

FEW = 1_000_000  # edges, of 16 bytes, that one task holds at most

#: Bytes of a word are digits, letters and everything beyond ASCII; all others part words.
_WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: str | None) -> list[bytes]:
    """Words of a text, A-Z lower-cased, as UTF-8. No words in null."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split()


def word_hashes(found: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, found), np.uint64, len(found))


_MIX = np.uint64(0x9E3779B97F4A7C15)
_SHIFT = np.uint64(29)


def mixed(x: np.ndarray) -> np.ndarray:
    """64-bit values spread over all bits."""
    x = (x ^ (x >> _SHIFT)) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash for each window of ``size`` words; a shorter, not empty text is one window."""
    if not len(hashes):
        return hashes
    size = min(size, len(hashes))
    out = np.zeros(len(hashes) - size + 1, np.uint64)
    for i in range(size):
        out = out * _MIX + hashes[i : len(hashes) - size + 1 + i] + np.uint64(1)
    return mixed(out)


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package to Python workers that would not find it, once per application.

    Nothing is sent where PYTHONPATH names the package's folder, or a local session was started in it.
    """
    root = Path(__file__).resolve().parents[2]
    context = spark.sparkContext
    local = context.master.split("[")[0] == "local" and Path.cwd() == root
    if local or str(root) in os.environ.get("PYTHONPATH", "").split(":") or context.applicationId in _SHIPPED:
        return
    target = f"{tempfile.mkdtemp(prefix='airshed-code-')}/airshed.zip"
    with zipfile.ZipFile(target, "w") as out:
        for f in sorted((root / "airshed").rglob("*.py")):
            out.write(f, f.relative_to(root))
    context.addPyFile(target)  # Spark serves the copy to its executors
    _SHIPPED.add(context.applicationId)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or with underscores in front until no column of ``df`` has it in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def mapped(
    df: DataFrame, added: str, fill: Callable[[pa.RecordBatch], list], prepare: Callable[[], None] | None = None
) -> DataFrame:
    """``df`` with the columns of the DDL ``added``, which ``fill`` makes from each Arrow batch."""
    ship(df.sparkSession)
    extra = T.StructType.fromDDL(added)
    schema = T.StructType([*df.schema.fields, *extra.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if prepare:
            prepare()
        for batch in batches:
            new = fill(batch)
            names = [*batch.schema.names, *[f.name for f in extra.fields]]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], names=names)

    return df.mapInArrow(run, schema)


def per_group(
    df: DataFrame, keys: list[str], work: Callable[[pa.Table], list[np.ndarray]], ddl: str
) -> DataFrame:
    """``work`` on the rows of each group of the long columns ``keys``; its arrays are the columns of ``ddl``.

    The rows are dealt by the keys and sorted, and a task walks through its groups one after the
    other: thousands of small groups cost one stream, not one each. A group must be of bounded size.
    """
    ship(df.sparkSession)
    schema = T.StructType.fromDDL(ddl)
    names = schema.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None

        def out(part: pa.Table, cuts: list[int]) -> pa.RecordBatch:
            done = [work(part.slice(a, b - a)) for a, b in zip(cuts, cuts[1:], strict=False)]
            columns = [np.concatenate(c) for c in zip(*done, strict=True)]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

        for batch in batches:
            part = pa.Table.from_batches([batch])
            part = pa.concat_tables([held, part]).combine_chunks() if held is not None else part
            if not part.num_rows:
                continue
            key = np.stack([part[k].to_numpy() for k in keys])
            cuts = [0, *(np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1).tolist()]
            if len(cuts) > 1:
                yield out(part, cuts)
            held = part.slice(cuts[-1])
        if held is not None and held.num_rows:
            yield out(held, [0, held.num_rows])

    return df.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema)


def keyed(df: DataFrame, name: str, key: str) -> DataFrame:
    """The rows written once with a number each; the numbers are fixed from then on."""
    return settle(df.withColumn(key, F.monotonically_increasing_id()), name)


def connected(edges: DataFrame, name: str, few: int = FEW, rounds: int = 60) -> DataFrame:
    """Components of undirected edges (a long, b long): columns node, component (its smallest node).

    Alternating star contraction: every node hands its neighbours to the smallest of them. Each
    round is written to the shared folder, so a lost executor repeats one round at most, and the
    driver sees only a row count and a checksum. At most ``few`` edges are done by one task instead,
    to the same result. Nodes without an edge are not listed.
    """
    ship(edges.sparkSession)
    e = edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    e = settle(e.distinct(), name)
    n, check = _state(e)
    if n <= few:
        return e.coalesce(1).mapInArrow(_union, "node long, component long")
    for _ in range(rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where(F.col("u") != F.col("v"))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(least.select("u", F.col("m").alias("v")))
        e = settle(small.where(F.col("u") != F.col("v")).distinct(), name)
        before, (n, check) = (n, check), _state(e)
        if before == (n, check):
            break
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    stars = e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(stars)


def _state(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count("*"), F.sum(F.hash("u", "v").cast("decimal(20,0)"))).first())


def _union(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts = [np.stack([b["u"].to_numpy(), b["v"].to_numpy()]) for b in batches]
    if parts:
        node, place = np.unique(np.concatenate(parts, axis=1), return_inverse=True)
        a, b = place.reshape(2, -1)
        root = roots(len(node), a, b)
        yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(node[root])], names=["node", "component"])


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For n nodes and edges (a[i], b[i]): the smallest node of each node's component."""
    p = np.arange(n)
    while True:
        m = np.minimum(p[a], p[b])
        q = p.copy()
        for x in (a, b, p[a], p[b]):
            np.minimum.at(q, x, m)
        q = q[q]
        if np.array_equal(p, q):
            return p
        p = q


def kth_largest(df: DataFrame, column: str, k: int, few: int = 2000, bins: int = 1000) -> float:
    """The k-th largest value of a double column without nulls, by repeated histograms.

    The driver gets ``bins`` counts a round and at last ``few`` values, whatever the size.
    """
    low, high, n = df.agg(F.min(column), F.max(column), F.count("*")).first()
    if k <= 0 or not n:
        return math.inf
    if k >= n:
        return low
    part = df.select(F.col(column).alias("x"))
    while n > few and high > low:
        width = (high - low) / bins
        if low + width == low or high - width == high:
            break
        place = F.least(F.floor((F.col("x") - low) / width), F.lit(bins - 1))
        counts = dict(part.groupBy(place.alias("b")).count().collect())
        for b in sorted(counts, reverse=True):
            if counts[b] >= k:
                break
            k -= counts[b]
        part = part.where(place == b)
        low, high, n = part.agg(F.min("x"), F.max("x"), F.count("*")).first()
    for x, count in sorted(part.groupBy("x").count().collect(), reverse=True):
        if k <= count:
            return x
        k -= count
    return low


def gumbel(seed: int, *columns: str) -> Column:
    """Noise of the standard Gumbel distribution that depends on the row and the seed alone."""
    uniform = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), *columns), 11) + 0.5) / F.lit(2.0**53)
    return -F.log(-F.log(uniform))
