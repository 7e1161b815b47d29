"""Importance resampling against a plain version over the whole given table: weights, cuts and the draw."""

import math
import re
import zlib
from collections import Counter

import pytest

pytest.importorskip("airshed.llm")

from airshed.llm import quality  # noqa: E402
from airshed.llm.common import gumbel  # noqa: E402

SF = "/root/testdata/sf0.01"
MASK, A, B = 2**64 - 1, 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F


def buckets(text):
    tokens = re.findall(rb"[A-Za-z\x80-\xff]+|[0-9]+|[^\sA-Za-z0-9\x80-\xff]+", (text or "").encode())
    one = [zlib.crc32(t) for t in tokens]
    pairs = [1 if x == y else ((((x * A) & MASK) ^ ((y * B) & MASK)) * B & MASK) >> 47 for x, y in zip(one, one[1:])]
    return [((x * A) & MASK) >> 47 for x in one] + pairs


def classes(labels):
    """doc_id -> (good, toxic)."""
    by_id = {}
    for doc_id, q, toxic in labels:
        if doc_id is not None and (q is not None or toxic == 1):
            by_id.setdefault(doc_id, []).append((q, toxic or 0))
    out = {}
    for doc_id, found in by_id.items():
        q, toxic = min((x for x, _ in found if x is not None), default=None), max(t for _, t in found)
        good = False if q == 0 else True if toxic == 0 else None
        if good is not None or toxic:
            out[doc_id] = (good, toxic == 1)
    return out


def best_cut(points, cost):
    """The lowest of the points below which most bad ones lie, less ``cost`` times the good ones."""
    gains = {x: sum((-cost if good else 1) for y, good in points if y < x) for x in {x for x, _ in points}}
    most = max(gains.values(), default=0)
    return min(x for x, g in gains.items() if g == most) if most > 0 else -math.inf


def plain(docs, labels, noise):
    known = classes(labels)
    found = {d: Counter(buckets(t)) for d, t in docs}
    raw, target, foul, clean = Counter(), Counter(), Counter(), Counter()
    for d, c in found.items():
        good, toxic = known.get(d, (None, None))
        raw.update(c)
        if good:
            target.update(c)
            clean.update(c.keys())
        if toxic:
            foul.update(c.keys())
    share = sum(target.values()) / sum(raw.values())
    odds = sum(t for _, t in known.values()) / sum(1 for g, t in known.values() if g and not t)
    weight, toxicity = {}, {}
    for d, c in found.items():
        good, toxic = known.get(d, (None, None))
        weight[d] = sum(n * math.log((target[b] - n * bool(good) + 5) / ((raw[b] - n) * share + 5)) for b, n in c.items())
        pairs = [(foul[b] - bool(toxic), (clean[b] - bool(good)) * odds) for b in c]
        toxicity[d] = sum(math.log((t + 5) / (r + 5)) for t, r in pairs if t - r > 4 * math.sqrt(t + r + 1))
    judged = [(d, *known[d]) for d in found if d in known]
    at = best_cut([(weight[d], g) for d, g, _ in judged if g is not None], 3)
    foul_at = best_cut([(-toxicity[d], not t) for d, g, t in judged if g or t], 3)
    pool = [d for d in found if -toxicity[d] >= foul_at - 1e-12]
    k = sum(weight[d] >= at - 1e-9 for d in pool)
    keys = sorted((weight[d] + noise[d] for d in pool), reverse=True)
    kept = {d for d in pool if k and weight[d] + noise[d] >= keys[k - 1] - 1e-9}
    return weight, kept


def test_weights_and_draw_equal_a_plain_version(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    noise = {r[0]: r[1] for r in docs.select("doc_id", gumbel(quality.SEED, "doc_id", "text")).collect()}
    rows = [tuple(r) for r in labels.select("doc_id", "quality", "toxic").collect()]
    weight, kept = plain([tuple(r) for r in docs.collect()], rows, noise)
    got = quality.judged(docs, labels).collect()
    assert len(got) == len(weight) and 0 < len(kept) < len(weight)
    for r in got:
        assert r["log_weight"] == pytest.approx(weight[r["doc_id"]], abs=1e-6)
    assert {r["doc_id"] for r in got if r["kept"]} == kept
