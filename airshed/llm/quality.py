"""Quality by importance resampling.

Two generative models of hashed n-grams, one of good (target) text and one of all (raw) text; the
log of their ratio, summed over a document, is its importance weight. Documents are then drawn
without replacement in proportion to the weights: Gumbel noise is added to the log weight and the
k largest are kept. k is the number of documents whose weight reaches the point that parts the
labelled good from the labelled bad documents best.

Fluent text can be toxic all the same, so toxic text has a ratio of its own, against clean text: of
the documents that have an n-gram, how many more are labelled toxic than clean. Only n-grams that
tell far beyond chance are summed, so that a few of them count in a long document. Documents beyond
the point that parts the labelled toxic from the labelled clean ones best are not drawn from.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airshed.llm.common import free_name, gumbel, kth_largest, mapped, ship
from airshed.session import settle

BUCKETS = 1 << 17  # hashed n-grams; bounds the model, whatever the corpus
SLICE = 1024  # buckets whose counts travel in one row
LABELS = 40_000  # labelled documents of each class that the target model and the cut are fitted on
PRIOR = 5.0  # n-grams seen about as often say little
POINTS = 200_000  # different weights of the label sample that the driver gets exactly
COST = 3.0  # of a good document lost, in bad ones kept
TELLING = 4.0  # standard deviations by which an n-gram must stand out in toxic documents
SEED = 20

_TOKEN = re.compile(rb"[A-Za-z\x80-\xff]+|[0-9]+|[^\sA-Za-z0-9\x80-\xff]+")
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_TOP = np.uint64(64 - BUCKETS.bit_length() + 1)
_REPEAT = 1  # bucket of "the word before once more"


def ngrams(text: str | None) -> np.ndarray:
    """Buckets of the words and of the pairs of neighbouring words, in any case and with signs."""
    tokens = _TOKEN.findall((text or "").encode("utf-8", "surrogatepass"))
    one = np.fromiter(map(zlib.crc32, tokens), np.uint64, len(tokens))
    two = ((one[:-1] * _A) ^ (one[1:] * _B)) * _B >> _TOP
    two[one[:-1] == one[1:]] = _REPEAT
    return np.concatenate([one * _A >> _TOP, two]).astype(np.int64)


def labelled(labels: DataFrame, limit: int = LABELS) -> DataFrame:
    """doc_id, good and toxic (booleans) for at most ``limit`` documents of each class, by hash order.

    Good: quality 1 and not toxic; bad: quality 0; toxic: toxic 1, of either quality. good is null
    for toxic documents of quality 1, which are neither. A document labelled twice counts as its
    worst label. Null ids are left out, and null qualities but for toxic documents.
    """
    one = labels.where("doc_id is not null and (quality is not null or toxic = 1)").groupBy("doc_id").agg(
        F.min("quality").alias("quality"), F.max(F.coalesce("toxic", F.lit(0))).alias("toxic")
    )
    good = F.when(F.col("quality") == 0, False).when(F.col("toxic") == 0, True)
    one = one.select("doc_id", good.alias("good"), (F.col("toxic") == 1).alias("toxic"))
    first = [F.xxhash64("doc_id"), F.col("doc_id")]
    parts = [one.where(c).orderBy(*first).limit(limit) for c in ("good", "not good", "toxic")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).distinct()


COUNTS = ("raw", "target", "toxic", "clean")


def model(marked: DataFrame, text: str, good: str, toxic: str) -> list[np.ndarray]:
    """For every bucket: its n-grams in all documents and in the good ones; toxic documents and good
    documents that have it.

    Each task adds up what it reads; the shuffle adds up the tasks. The driver gets four numbers a
    bucket.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros(BUCKETS, np.int64) for _ in COUNTS]
        raw, target, foul, clean = sums
        for batch in batches:
            for value, g, bad in zip(batch.column(0), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                found = np.bincount(ngrams(value.as_py()), minlength=BUCKETS)
                raw += found
                if g:
                    target += found
                    clean += found > 0
                if bad:
                    foul += found > 0
        starts = range(0, BUCKETS, SLICE)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(range(len(starts)), pa.int32()),
                *[pa.array([s[i : i + SLICE].tobytes() for i in starts], pa.binary()) for s in sums],
            ],
            names=["slice", *COUNTS],
        )

    def add(key: tuple, parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros(SLICE, np.int64) for _ in COUNTS]
        for part in parts:
            for total, name in zip(sums, COUNTS, strict=True):
                for value in part.column(name):
                    total += np.frombuffer(value.as_py(), np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array([key[0].as_py()], pa.int32()), *[pa.array([s.tobytes()], pa.binary()) for s in sums]],
            names=["slice", *COUNTS],
        )

    ship(marked.sparkSession)
    ddl = ", ".join(["slice int", *[f"{c} binary" for c in COUNTS]])
    rows = marked.select(text, good, toxic).mapInArrow(count, ddl).groupBy("slice").applyInArrow(add, ddl).collect()
    out = [np.zeros(BUCKETS, np.int64) for _ in COUNTS]
    for r in rows:
        at = slice(r["slice"] * SLICE, (r["slice"] + 1) * SLICE)
        for total, name in zip(out, COUNTS, strict=True):
            total[at] = np.frombuffer(r[name], np.int64)
    return out


def log_weight(found: np.ndarray, raw: np.ndarray, target: np.ndarray, share: float, good: bool) -> float:
    """Sum of the log ratios of a document's n-grams, its own counts taken out of both models."""
    if not len(found):
        return 0.0
    bucket, own = np.unique(found, return_counts=True)
    t = target[bucket] - (own if good else 0)
    r = raw[bucket] - own
    return float((np.log((t + PRIOR) / (r * share + PRIOR)) * own).sum())


def toxic_weight(found: np.ndarray, toxic: np.ndarray, clean: np.ndarray, share: float, is_toxic: bool, is_clean: bool) -> float:
    """Sum of the log ratios of a document's different telling n-grams, itself taken out of both models.

    share: toxic documents for each clean one.
    """
    bucket = np.unique(found)
    t = toxic[bucket] - int(is_toxic)
    r = (clean[bucket] - int(is_clean)) * share
    telling = t - r > TELLING * np.sqrt(t + r + 1)
    return float(np.log((t[telling] + PRIOR) / (r[telling] + PRIOR)).sum())


def scored(docs: DataFrame, labels: DataFrame, limit: int = LABELS) -> DataFrame:
    """docs with the columns good and toxic (booleans; null: not in the label sample, or see
    ``labelled``), log_weight and toxic_weight (doubles).

    The names get underscores in front where docs has them already; the four are always the last.
    Null and empty texts weigh 0. Repeated rows weigh the same.
    """
    spark = docs.sparkSession
    good, toxic, weight, foul = (free_name(docs, c) for c in ("good", "toxic", "log_weight", "toxic_weight"))
    fitted = settle(labelled(labels, limit), "quality-labels")  # 3 x limit rows at most
    known = F.broadcast(fitted.select(F.col("doc_id").alias("__id"), F.col("good").alias(good), F.col("toxic").alias(toxic)))
    marked = docs.join(known, F.col("doc_id") == F.col("__id"), "left").drop("__id")
    counts = model(marked, "text", good, toxic)
    share = float(counts[1].sum() / counts[0].sum()) if counts[0].sum() else 0.0
    documents = {bool(r["toxic"]): r["count"] for r in fitted.where("good or toxic").groupBy("toxic").count().collect()}
    odds = documents.get(True, 0) / documents[False] if documents.get(False) else 0.0
    shipped = spark.sparkContext.broadcast(counts)
    at_text, at_good, at_toxic = (marked.columns.index(c) for c in ("text", good, toxic))

    def fill(batch: pa.RecordBatch) -> list:
        raw, target, in_toxic, in_clean = shipped.value
        weights, fouls = [], []
        for value, g, bad in zip(batch.column(at_text), batch.column(at_good).to_pylist(), batch.column(at_toxic).to_pylist(), strict=True):
            found = ngrams(value.as_py())
            weights.append(log_weight(found, raw, target, share, bool(g)) if share else 0.0)
            fouls.append(toxic_weight(found, in_toxic, in_clean, odds, bool(bad), bool(g)) if odds else 0.0)
        return [pa.array(weights, pa.float64()), pa.array(fouls, pa.float64())]

    return mapped(marked, f"`{weight}` double, `{foul}` double", fill)


def counted(points: DataFrame, limit: int = POINTS) -> list[tuple[float, bool, int]]:
    """points (x, good) as different (x, good, count), in ``limit`` steps of x if they are more than ``limit``.

    A document repeated over any number of rows is one of them.
    """
    some = settle(points.toDF("x", "good").groupBy("x", "good").agg(F.count("*").alias("n")), "quality-points")
    n, low, high = some.agg(F.count("*"), F.min("x"), F.max("x")).first()
    if n > limit:
        width = (high - low) / limit or 1.0
        some = some.withColumn("x", low + F.floor((F.col("x") - low) / width) * width).groupBy("x", "good").agg(F.sum("n").alias("n"))
    return [tuple(r) for r in some.collect()]


def cut(points: list[tuple], cost: float = COST) -> float:
    """The weight from which on documents count as good: the one that tells most labelled bad ones
    apart, less ``cost`` times the good ones lost by it; the lowest of equals.

    points: weight, good and, if not one, how many there are. Minus infinity if no weight gains
    anything, so also without labels of both classes.
    """
    best, at = 0.0, float("-inf")
    gain = 0.0
    points = sorted(points)
    for i, (x, good, *n) in enumerate(points):
        gain += (-cost if good else 1) * (n[0] if n else 1)
        if i + 1 < len(points) and points[i + 1][0] > x and gain > best:
            best, at = gain, points[i + 1][0]
    return at


def resampled(
    docs: DataFrame, labels: DataFrame, limit: int = LABELS, seed: int = SEED, drop: tuple[str, ...] = ()
) -> DataFrame:
    """docs, without the columns ``drop``, with good, toxic, log_weight, toxic_weight, sample_key (log
    weight plus Gumbel noise) and kept (the k largest of those that are not found toxic).

    Rows that are alike in id and text get the same noise: they stay or go together, and rows that
    tie at the k-th key all stay. No documents give no rows; without labels of both classes all stay,
    but for what is found toxic, and nothing is without labels of toxic and of good documents.
    """
    rows = scored(docs, labels, limit)
    good, toxic, weight, foul = rows.columns[-4:]
    key, kept = free_name(rows, "sample_key"), free_name(rows, "kept")
    rows = rows.withColumn(key, F.col(weight) + gumbel(seed, "doc_id", "text")).drop(*drop)
    # Without the texts the rows are written and used as they are; with them only the weights are,
    # and what is kept is scored again: a second pass costs less than another copy of the corpus.
    narrow = settle(rows if drop else rows.select(weight, foul, good, toxic, key), "quality-scores")
    rows = narrow if drop else rows
    at = cut(counted(narrow.where(F.col(good).isNotNull()).select(weight, good)))
    toxicity = narrow.where(F.col(good) | F.col(toxic)).select(-F.col(foul), ~F.col(toxic))
    clean = -F.col(foul) >= F.lit(cut(counted(toxicity)))
    pool = narrow.where(clean)
    k = pool.where(F.col(weight) >= at).count()
    return rows.withColumn(kept, clean & (F.col(key) >= F.lit(kth_largest(pool, key, k))))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are drawn, with their own columns."""
    rows = resampled(docs, labels)
    return rows.where(F.col(rows.columns[-1])).select(*docs.columns)


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, log_weight, kept of each document."""
    rows = resampled(docs.select("doc_id", "text"), labels, drop=("text",))
    return rows.select("doc_id", "log_weight", "kept")
