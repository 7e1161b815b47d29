"""Benchmark decontamination: windows of normalised test words, looked up in every text.

The windows of the benchmark become a hash table that every task gets. A table of more than
``BLOCK`` windows is cut into blocks: one is looked up in all texts and its hits are written before the
next one is built, so there is one block in memory at a time, whatever the benchmark's size, and at
last the hits of a text are put together. A window counts only after its words have been compared.
Every row is judged for itself, repeated ones too; a null or empty text has no words and no hits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airshed.llm.common import free_name, keyed, mapped, ship, words
from airshed.session import settle

WINDOW = 10
BLOCK = 250_000  # windows of items in one table


def windows(benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """Distinct windows of the items: window (the words with single spaces), n (words), item_id (string).

    An item of fewer words, but not none, is one window. Null items have none; null ids are the text "null".
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = words(text)
                n = min(size, len(found))
                rows += [(b" ".join(found[i : i + n]), n, item) for i in range(len(found) - n + 1) if n]
            columns = list(zip(*rows, strict=True)) if rows else [[], [], []]
            types = (pa.binary(), pa.int32(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["window", "n", "item_id"])

    named = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item_id"), "text")
    return named.mapInArrow(cut, "window binary, n int, item_id string").distinct()


class Windows:
    """A block of windows, ready for lookups."""

    def __init__(self, rows: list[tuple[bytes, int, str]]):
        self.items: dict[int, dict[bytes, list[str]]] = {}
        for window, n, item in rows:
            self.items.setdefault(n, {}).setdefault(window, []).append(item)
        every = {w for known in self.items.values() for window in known for w in window.split()}
        self.number = {w: i + 1 for i, w in enumerate(sorted(every))}
        self.sums = {
            n: np.unique(self.hashes(np.array([[self.number[w] for w in x.split()] for x in known]).reshape(len(known), n)))
            for n, known in self.items.items()
        }

    @staticmethod
    def hashes(rows: np.ndarray) -> np.ndarray:
        out = np.zeros(len(rows), np.uint64)
        for i in range(rows.shape[1]):
            out = out * np.uint64(0x9E3779B97F4A7C15) + rows[:, i].astype(np.uint64)
        return out

    def look_up(self, found: list[bytes]) -> tuple[set[tuple[int, int]], set[str]]:
        """Spans of words (start, end) that are windows, and the items they come from."""
        numbers = np.fromiter(map(self.number.get, found, (0,) * len(found)), np.int64, len(found))
        spans, items = set(), set()
        unknown = np.concatenate([[0], np.cumsum(numbers == 0)])
        for n, sums in self.sums.items():
            if len(found) < n:
                continue
            starts = np.flatnonzero(unknown[n:] == unknown[: len(found) - n + 1])  # all words are known
            if not len(starts):
                continue
            sum_of = self.hashes(numbers[starts[:, None] + np.arange(n)])
            place = np.minimum(np.searchsorted(sums, sum_of), len(sums) - 1)
            for i in starts[sums[place] == sum_of]:
                owners = self.items[n].get(b" ".join(found[i : i + n]))  # the words themselves
                if owners:
                    spans.add((int(i), int(i) + n))
                    items.update(owners)
        return spans, items


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def marked(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, block: int = BLOCK) -> DataFrame:
    """docs with n_words (long), hit_spans (array of word numbers start, end), hit_items (array of strings).

    The spans are merged where they touch. A null text has no words. Names that docs already has get
    underscores in front; the three are always the last columns.
    """
    spark = docs.sparkSession
    ship(spark)
    n_words, hit_spans, hit_items = (free_name(docs, c) for c in ("n_words", "hit_spans", "hit_items"))
    # A window that many items share may lie in several blocks; what they find adds up.
    table = settle(windows(benchmark, size), "benchmark-windows")
    count = max(1, -(-table.count() // block))
    ddl = f"`{n_words}` long, `{hit_spans}` array<struct<start:int,end:int>>, `{hit_items}` array<string>"
    kinds = [f.dataType for f in T.StructType.fromDDL(ddl)]
    at = docs.columns.index("text")
    shape = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    if count == 1:
        return _passed(docs, at, _shipped(table), ddl, shape)
    row = free_name(docs, "__row")
    rows = keyed(docs, "benchmark-docs", row)
    found = None
    for i in range(count):
        part = _shipped(table.where(F.pmod(F.xxhash64("window", "item_id"), F.lit(count)) == i))
        hits = _passed(rows.select(row, "text"), 1, part, ddl, shape).drop("text")
        hits = settle(hits if i == 0 else hits.where(F.size(hit_spans) > 0), "benchmark-hits")  # the first tells the words of all
        part.destroy()
        found = hits if found is None else found.unionByName(hits)
    found = found.groupBy(row).agg(
        F.max(n_words).alias(n_words),
        F.flatten(F.collect_list(hit_spans)).alias(hit_spans),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list(hit_items)))).alias(hit_items),
    )
    out = rows.join(found, row).select(*docs.columns, n_words, hit_spans, hit_items)

    def touching(batch: pa.RecordBatch) -> list:
        return [pa.array([[{"start": a, "end": b} for a, b in merged([(x["start"], x["end"]) for x in r])] for r in batch.column(hit_spans).to_pylist()], shape)]

    again = free_name(out, "__merged")
    united = mapped(out, f"`{again}` {kinds[1].simpleString()}", touching)
    return united.select(*docs.columns, n_words, F.col(again).alias(hit_spans), hit_items)


def _shipped(table: DataFrame):
    """The windows of one block, some ``BLOCK`` of them, for every task."""
    rows = [tuple(r) for r in table.collect()]
    return table.sparkSession.sparkContext.broadcast([(bytes(w), n, item) for w, n, item in rows])


def _passed(docs: DataFrame, at: int, shipped, ddl: str, shape: pa.DataType) -> DataFrame:
    """docs with what the block's windows find in column ``at``."""
    state: dict = {}

    def prepare() -> None:
        state["windows"] = Windows(shipped.value)

    def fill(batch: pa.RecordBatch) -> list:
        counts, spans, items = [], [], []
        for value in batch.column(at):
            found = words(value.as_py())
            hit, owners = state["windows"].look_up(found)
            counts.append(len(found))
            spans.append([{"start": a, "end": b} for a, b in merged(list(hit))])
            items.append(sorted(owners))
        return [pa.array(counts, pa.int64()), pa.array(spans, shape), pa.array(items, pa.list_(pa.string()))]

    return mapped(docs, ddl, fill, prepare)


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no window of the benchmark, with their own columns; those without words stay."""
    rows = marked(docs, benchmark)
    return rows.where(F.size(rows.columns[-2]) == 0).select(*docs.columns)


def cleaned(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """docs whose hit words, with what stands between them, are cut out of the text, until no window is left.

    A cut leaves a line break, so the words around it stay apart; should they form a window anew,
    that is cut as well.
    """
    rows = marked(docs, benchmark)
    spans, columns = rows.columns[-2], docs.columns

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            both = zip(part["text"], part[spans], strict=True)
            part["text"] = [cut_words(t, [(x["start"], x["end"]) for x in s]) for t, s in both]
            yield part[columns]

    hit = F.size(spans) > 0
    changed = settle(rows.where(hit).mapInPandas(cut, docs.schema), "decontaminated")
    again = cleaned(changed, benchmark) if changed.count() else changed
    return rows.where(~hit).select(*docs.columns).unionByName(again)


def cut_words(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words of the spans, a line break in place of each span."""
    raw = text.encode("utf-8", "surrogatepass")
    bounds, inside = [], False
    for i, b in enumerate([*raw, 0x20]):
        letter = 0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A or b >= 0x80
        if letter and not inside:
            start = i
        if inside and not letter:
            bounds.append((start, i))
        inside = letter
    out, end = [], 0
    for a, b in spans:
        out.append(raw[end : bounds[a][0]])
        end = bounds[b - 1][1]
    return b"\n".join([*out, raw[end:]]).decode("utf-8", "surrogatepass")


def digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of each document."""
    rows = marked(docs.select("doc_id", "text"), benchmark)
    n_hit = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda a, x: a + x["end"] - x["start"])
    return rows.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hit_items", ","), 256).alias("items_sha256"),
        (F.size("hit_spans") > 0).alias("contaminated"),
    )
