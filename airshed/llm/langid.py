"""Language identification by cross-parsing entropy.

Each language's labelled sample becomes a suffix automaton. A text is parsed by it: the longest
stretch that occurs in the sample is a phrase, then the next. A text needs few phrases by its own
language and many by others; the number of phrases times the logarithm of the sample's length, per
letter, estimates the cross entropy, and the language with the smallest wins. Texts are parsed
whole, in segments of a fixed length that stand side by side in one array.

All letters of the samples are told apart. When there are more than symbols, the most frequent ones
have a symbol each, and every other letter is spelled by a fixed number of further symbols.
"""

from __future__ import annotations

import hashlib
import unicodedata
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airshed.llm.common import free_name, mapped

SAMPLE_DOCS = 400  # documents a language's sample is taken from, at most ...
SAMPLE_CHARS = 60_000  # ... and its characters
SALT = 32  # parts that the sample is first taken from
SYMBOLS = 64  # of the automata
SPELLING = 24  # symbols that letters are spelled with when there are too many for one each
SEGMENT = 1024  # letters and gaps parsed in one go; a phrase ends with its segment
UNKNOWN = "und"

_GAP, _OTHER = 0, 1


def codes_of(text: str) -> np.ndarray:
    """Code points of the text, lower-cased and composed."""
    data = unicodedata.normalize("NFC", text.lower()).encode("utf-32-le", "surrogatepass")
    return np.frombuffer(data, np.uint32)


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


class Alphabet:
    """Letters of the samples as small numbers, all that is not a letter as a gap.

    Letters that no sample has are one: no automaton knows any of them.
    """

    def __init__(self, samples: dict[str, str]):
        count = Counter(chr(c) for s in samples.values() for c in codes_of(s).tolist())
        letters = sorted((c for c in count if c.isalpha()), key=lambda c: (-count[c], c))
        more = len(letters) > SYMBOLS - 2
        self.plain = SYMBOLS - SPELLING if more else len(letters) + 2  # symbols that stand for themselves
        self.size = SYMBOLS if more else self.plain
        self.width = 1  # symbols that spell one of the other letters
        while SPELLING**self.width < len(letters) + 2 - self.plain:
            self.width += 1
        self.number = np.array([_OTHER if chr(c).isalpha() else _GAP for c in range(0x110000)], np.uint32)
        for i, c in enumerate(letters):
            self.number[ord(c)] = i + 2

    def __call__(self, text: str) -> np.ndarray:
        """Symbols of the text; of several gaps in a row the first."""
        s = self.number[codes_of(text)]
        if len(s):
            s = s[np.concatenate([[True], (s[1:] != _GAP) | (s[:-1] != _GAP)])]
        if self.size == self.plain:
            return s.astype(np.uint8)
        length = np.where(s < self.plain, 1, self.width)
        place = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
        s = np.repeat(s.astype(np.int64), length)
        digit = (s - self.plain) // SPELLING ** (self.width - 1 - place) % SPELLING
        return np.where(s < self.plain, s, self.plain + digit).astype(np.uint8)


def suffix_automaton(symbols: list[int], size: int) -> np.ndarray:
    """The transitions of the automaton of all substrings: table[state, symbol] (-1: none), start 0."""
    table, link, length = [[-1] * size], [-1], [0]
    last = 0
    for c in symbols:
        new = len(table)
        table.append([-1] * size)
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and table[p][c] < 0:
            table[p][c] = new
            p = link[p]
        if p >= 0:
            q = table[p][c]
            if length[p] + 1 == length[q]:
                link[new] = q
            else:
                copy = len(table)
                table.append(table[q][:])
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and table[p][c] == q:
                    table[p][c] = copy
                    p = link[p]
                link[q] = link[new] = copy
        last = new
    return np.array(table, np.int32)


class Parser:
    """The automata of all languages, side by side in one table of steps."""

    def __init__(self, samples: dict[str, str]):
        self.languages = sorted(samples)
        self.alphabet = Alphabet(samples)
        steps, self.start, self.cost = [], [], []
        base = 0
        for language in self.languages:
            own = self.alphabet(samples[language])
            table = suffix_automaton(own.tolist(), self.alphabet.size)
            # Where the automaton has no step, the symbol begins the next phrase: such steps are
            # negative. A symbol that the sample lacks is a phrase of its own; after it, as at the
            # beginning, stands a last state from which every symbol begins a phrase.
            fresh = len(table)
            begun = np.where(table[0] >= 0, table[0], fresh)
            table = np.vstack([table, np.full((1, self.alphabet.size), -1, np.int32)])
            to = np.where(table >= 0, table + base, -1 - (begun[None, :] + base))
            steps.append(to.astype(np.int32))
            self.start.append(base + fresh)
            self.cost.append(np.log2(max(len(own), 2)))
            base += len(table)
        self.steps = np.concatenate(steps).ravel() if steps else np.zeros(0, np.int32)

    def phrases(self, texts: list[np.ndarray]) -> np.ndarray:
        """Phrases that each text needs in each language."""
        owner, parts = [], []
        for i, t in enumerate(texts):
            for at in range(0, len(t), SEGMENT):
                owner.append(i)
                parts.append(t[at : at + SEGMENT])
        out = np.zeros((len(texts), len(self.languages)))
        if not parts:
            return out
        order = np.argsort([-len(p) for p in parts], kind="stable")
        lengths = np.array([len(parts[k]) for k in order])
        grid = np.zeros((lengths[0], len(parts)), np.int32)
        for column, k in enumerate(order):
            grid[: lengths[column], column] = parts[k]
        size = self.alphabet.size
        for j, start in enumerate(self.start):
            state = np.full(len(parts), start * size, np.int32)
            begun = np.zeros(len(parts), np.int32)
            live = np.searchsorted(-lengths, -np.arange(lengths[0]), side="left")  # segments longer than the step
            for row, n in zip(grid, live.tolist(), strict=True):
                to = self.steps[state[:n] + row[:n]]
                broken = to < 0
                begun[:n] += broken
                state[:n] = np.where(broken, -1 - to, to) * size
            np.add.at(out[:, j], np.array(owner)[order], begun)
        return out

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """Language and score of each text: the share of the winner when languages are weighed by
        one over their entropy. Of equal ones the first by name."""
        known = [k for k, t in enumerate(texts) if has_letter(t)] if self.languages else []
        out = [(UNKNOWN, 0.0)] * len(texts)
        if known:
            entropy = self.phrases([self.alphabet(texts[k]) for k in known]) * np.array(self.cost)
            best = entropy.argmin(axis=1)
            share = (1 / entropy) / (1 / entropy).sum(axis=1, keepdims=True)
            for k, b, s in zip(known, best.tolist(), share, strict=True):
                out[k] = (self.languages[b], float(s[b]))
        return out


_PARSERS: dict[str, Parser] = {}


def parser(samples: dict[str, str]) -> Parser:
    """The parser of the samples, built once in a worker."""
    key = hashlib.sha256(repr(sorted(samples.items())).encode("utf-8", "surrogatepass")).hexdigest()
    if key not in _PARSERS:
        _PARSERS.clear()
        _PARSERS[key] = Parser(samples)
    return _PARSERS[key]


def held_out() -> Column:
    """Whether a document is kept from the samples: by its id alone."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


def sampled(docs: DataFrame, documents: int = SAMPLE_DOCS, chars: int = SAMPLE_CHARS) -> dict[str, str]:
    """For each language the beginnings of at most ``documents`` labelled documents, not held out.

    They are the first by a hash of their ids, of each of ``SALT`` parts first and then of all, so
    that no task gets more than so many a part. Every document gives an equal share of the
    characters; what short ones leave goes to the next ones.
    """
    share = 4 * chars // documents
    usable = docs.where(F.col("lang").isNotNull() & ~held_out()).where(F.length(F.trim("text")) > 0)
    part = usable.select("lang", F.xxhash64("doc_id").alias("h"), F.substring("text", 1, share).alias("part"))
    part = part.withColumn("salt", F.pmod("h", F.lit(SALT)))
    for group in (["lang", "salt"], ["lang"]):
        order = Window.partitionBy(*group).orderBy("h", "part")
        part = part.withColumn("n", F.row_number().over(order)).where(F.col("n") <= documents)
    rows = part.collect()
    out: dict[str, str] = {}
    for r in sorted(rows, key=lambda r: (r["lang"], r["n"])):
        if len(out.setdefault(r["lang"], "")) < chars:
            out[r["lang"]] += r["part"] + "\n"
    return {k: v for k, v in ((k, v[:chars]) for k, v in out.items()) if has_letter(v)}


def identified(docs: DataFrame, documents: int = SAMPLE_DOCS, chars: int = SAMPLE_CHARS) -> DataFrame:
    """docs with held_out, lang_pred and score (names get underscores if taken).

    Learns from text and lang of documents whose crc32 of the id, as text, is not a multiple of 5;
    a null id is not held out. A null text or one without a letter is ``und``, score 0, as is every
    text when nothing is labelled. Repeated rows get the same.
    """
    samples = sampled(docs.select("doc_id", "lang", "text"), documents, chars)  # bounded, see above
    shipped = docs.sparkSession.sparkContext.broadcast(samples)
    at = docs.columns.index("text")
    lang, score = free_name(docs, "lang_pred"), free_name(docs, "score")

    def fill(batch: pa.RecordBatch) -> list:
        p = parser(shipped.value)
        out: list[tuple[str, float]] = []
        texts, size = [], 0
        for value in batch.column(at):
            texts.append(value.as_py())
            size += len(texts[-1] or "")
            if size > 8_000_000:  # so that the array stays small, however long the texts
                out += p.predict(texts)
                texts, size = [], 0
        out += p.predict(texts)
        return [pa.array([x for x, _ in out], pa.string()), pa.array([s for _, s in out], pa.float64())]

    rows = mapped(docs, f"`{lang}` string, `{score}` double", fill)
    return rows.withColumn(free_name(rows, "held_out"), held_out())


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of each document."""
    return identified(docs.select("doc_id", "lang", "text")).select("doc_id", "held_out", "lang_pred", "score")
