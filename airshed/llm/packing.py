"""Sequence packing by sums of squares.

A text becomes token ids and one separator, and only what is longer than a sequence is cut. The
pieces are then placed one by one, long ones first: into the open sequence that leaves the sum over
all gaps of (open sequences with that gap) squared the smallest, or into a new one if none has room.
Gaps so stay spread out and nearly all of them are met by some later piece. Pieces are dealt into groups that
pack on their own; the sequences that a group leaves open are dealt again, as pieces, into fewer
groups, until one group of bounded size is left.
"""

from __future__ import annotations

import os
import unicodedata
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airshed.llm.common import keyed, per_group, ship
from airshed.session import settle

LENGTH = 2048
GROUP = 20_000  # pieces that are packed together
VOCABULARY = "word_bpe_49k.json"
CACHE = 350_000  # words, with and without signs, whose ids a worker keeps

_SPLIT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")  # fixed value: the vocabulary's pattern
_ODD_SPACE = regex.compile("[\x1c-\x1f]")  # white space to Python, not to the tokenizer
_LATIN = regex.compile("[!-~\u00a1-\u024f]+")  # printable, and alike in every version of Unicode
_PLAIN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
#: Bytes as the model's vocabulary shows them: printable ones as themselves, the rest from U+0100 on.
_SHOWN = {b: 0x100 + i for i, b in enumerate(b for b in range(256) if b not in _PLAIN)}
SEPARATOR = (0).to_bytes(4, "little")


class Kept(dict):
    """Remembers what ``make`` gives for the first ``bound`` keys."""

    def __init__(self, make: Callable[[str], bytes], bound: int):
        super().__init__()
        self.make, self.bound = make, bound

    def __missing__(self, key: str) -> bytes:
        value = self.make(key)
        if len(self) < self.bound:
            self[key] = value
        return value


class Encoder:
    """Ids of whole texts as little-endian 32-bit numbers.

    White space parts words and is dropped, so the ids of a text are those of its words. Words of
    Latin letters go to the tokenizer's model straight away, others through the whole tokenizer;
    the ids of words seen before are kept, up to a bound.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.number = [i.to_bytes(4, "little") for i in range(self.tokenizer.get_vocab_size(with_added_tokens=True))]
        self.known = Kept(self.chunk, CACHE)

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def word(self, word: str) -> bytes:
        shown = word if word.isascii() else word.encode().decode("latin-1").translate(_SHOWN)
        return b"".join([self.number[t.id] for t in self.model.tokenize(shown)])

    def chunk(self, chunk: str) -> bytes:
        """Ids of a stretch without white space; those of its words are kept as well."""
        if chunk.isalpha() and chunk.isascii():
            small = chunk.lower()
            return self.word(chunk) if small == chunk else self.known[small]
        if _LATIN.fullmatch(chunk) and not any(s in chunk for s in self.special):
            words = _SPLIT.findall(unicodedata.normalize("NFC", chunk).lower())
            return self.word(chunk) if words == [chunk] else b"".join(map(self.known.__getitem__, words))
        return self.whole(chunk)

    def __call__(self, text: str) -> bytes:
        if _ODD_SPACE.search(text):
            return self.whole(text)
        return b"".join(map(self.known.__getitem__, text.split()))


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def pieces(docs: DataFrame, vocabulary: str, length: int = LENGTH) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of each piece of each document, in any order.

    A null text counts as empty: its only id is the separator.
    """
    ship(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary)
        for batch in batches:
            rows, columns = [], [[], [], [], []]
            for k, text in enumerate(batch.column(1)):
                ids = encode(text.as_py() or "") + SEPARATOR
                for n, at in enumerate(range(0, len(ids), 4 * length)):
                    part = ids[at : at + 4 * length]
                    rows.append(k)
                    for c, x in zip(columns, (n, at // 4, len(part) // 4, zlib.crc32(part)), strict=True):
                        c.append(x)
            types = (pa.int32(), pa.int64(), pa.int64(), pa.int64())
            made = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), *made], names=names)

    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    ddl = f"doc_id {kind.simpleString()}, piece int, start long, length long, ids_crc32 long"
    return docs.select("doc_id", "text").mapInArrow(cut, ddl)


def packed(lengths: np.ndarray, size: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """For pieces, longest first: the bin (numbered from 0) and the place in it of each."""
    open_bins: list[list[int]] = [[] for _ in range(size + 1)]  # by gap
    count = np.zeros(size + 1, np.int64)
    bins, places = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    none = np.iinfo(np.int64).max
    made = 0
    for i, n in enumerate(lengths.tolist()):
        # From gap g to gap g - n the sum changes by 2 (count[g - n] - count[g] + 1); a full sequence
        # has no gap, so filling one up changes it by 1 - 2 count[g].
        change = 2 * (count[: size + 1 - n] - count[n:] + 1)
        change[0] = 1 - 2 * count[n]
        change[count[n:] == 0] = none
        best = int(change.argmin())  # of equal ones the tightest
        if change[best] == none:
            number, gap = made, size
            made += 1
        else:
            gap = best + n
            number = open_bins[gap].pop()
            count[gap] -= 1
        bins[i], places[i] = number, size - gap
        if gap > n:
            open_bins[gap - n].append(number)
            count[gap - n] += 1
    return bins, places


def in_sequences(found: DataFrame, length: int = LENGTH, group: int = GROUP) -> DataFrame:
    """The pieces with sequence_id and offset. found: the columns of ``pieces``.

    Pieces that fill a sequence are one. The others are items; each round deals the items into
    groups, packs these, and makes the sequences that are not nearly full the next round's items.
    """
    rows = keyed(found, "pieces", "item")
    # The bin of an item: a number that no other has, as every bin is named after an item in it.
    items = rows.where(F.col("length") < length).select("item", F.col("length").alias("size"))
    placed: list[DataFrame] = []
    left = items.count()
    while left > 1:
        groups = -(-left // group)

        def work(part: pa.Table) -> list[np.ndarray]:
            item, size = part["item"].to_numpy(), part["size"].to_numpy()
            order = np.lexsort((item, -size))
            bins, places = packed(size[order], length)
            first = item[order][np.unique(bins, return_index=True)[1]]
            fill = np.bincount(bins, weights=size[order]).astype(np.int64)
            return [item[order], first[bins], places, fill[bins]]

        dealt = items.withColumn("group", F.pmod(F.xxhash64("item", F.lit(left)), F.lit(groups)))
        done = settle(per_group(dealt, ["group"], work, "item long, bin long, place long, fill long"), "packed")
        placed.append(done.select("item", "bin", "place"))
        if groups == 1:
            break
        items = done.where((F.col("place") == 0) & (F.col("fill") < length)).select(
            F.col("bin").alias("item"), F.col("fill").alias("size")
        )
        fewer = items.count()
        if fewer > 0.7 * left:  # what is left over hardly fits together any more
            break
        left = fewer
    out = rows.withColumn("bin", F.col("item")).withColumn("offset", F.lit(0).cast("long"))
    for i, step in enumerate(placed):
        step = step.select(F.col("item").alias("bin"), F.col("bin").alias("next"), F.col("place").alias("more"))
        out = out.join(step, "bin", "left").select(
            *rows.columns,
            F.coalesce("next", "bin").alias("bin"),
            (F.col("offset") + F.coalesce("more", F.lit(0))).alias("offset"),
        )
    return out.drop("item").withColumnRenamed("bin", "sequence_id")


def sequences(docs: DataFrame, vocabulary: str | None = None, length: int = LENGTH) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of each piece of docs.

    Repeated rows are packed each for itself; a null id stays null. No documents give no rows.
    """
    path = vocabulary or public_tokenizers.path(VOCABULARY)
    out = in_sequences(pieces(docs, path, length), length)
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
