"""Shards, manifest and prefix trie against plain versions, at several sizes of ranges and shards."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

pytest.importorskip("airshed.llm")

import brute  # noqa: E402
from airshed.llm import manifest, order, prefix_trie, sharding  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from test_edges import DOCS, TEXTS  # noqa: E402

RANK = lambda x: (x is not None, x)  # noqa: E731  null first


@pytest.fixture(scope="module")
def docs(spark):
    langs = [None, "", "aa", "b", "é", "Z"]
    rows = [(i, t, langs[k % 6], "s" if k % 3 else None, k if k % 4 else None, *["x"] * 7, 1) for k, (i, t) in enumerate(TEXTS)]
    rows += [(1000 + k // 3, f"Text {k // 3}", "de", "s", 6, *["x"] * 7, 1) for k in range(240)]  # each three times
    rows += [(77, "Hot", "hot", "s", 3, *["x"] * 7, 1)] * 150  # one row again and again
    return spark.createDataFrame(rows, DOCS).repartition(3)


def plain(docs, *names):
    return [tuple(r[n] for n in names) for r in docs.collect()]


# --- order ---------------------------------------------------------------------------------------


@pytest.mark.parametrize("rows", [7, 10**6])
def test_running_sums_do_not_depend_on_ranges(spark, rows):
    r = random.Random(1)
    data = [(r.choice("aaaab"), r.randrange(40), r.randrange(9)) for _ in range(300)]
    table = order.ranges(spark.createDataFrame(data, "g string, k int, v int"), ["g", "k", "v"], "t", rows)
    assert (table.select("__range").distinct().count() > 5) == (rows == 7)
    got = order.running(table, ["g"], ["k", "v"], {"upto": F.col("v")}, whole={"upto": "total"})
    want, sums = [], defaultdict(int)
    for g, k, v in sorted(data):
        sums[g] += v
        want.append((g, k, v, sums[g]))
    want = [(*w, sums[w[0]]) for w in want]
    assert sorted(tuple(x) for x in got.select("g", "k", "v", "upto", "total").collect()) == want
    folded = order.running(table, ["g"], ["k", "v"], {"upto": F.col("v")}, F.bit_xor).where("g = 'b'")
    want, state = [], 0
    for _, k, v in sorted(d for d in data if d[0] == "b"):
        state ^= v
        want.append((k, v, state))
    assert sorted(tuple(x) for x in folded.select("k", "v", "upto").collect()) == sorted(want)
    named = order.attached(table, ["g"], spark.createDataFrame([("b", 5)], "g string, fact int")).collect()
    assert len(named) == sum(d[0] == "b" for d in data) and {x.fact for x in named} == {5}


# --- shards --------------------------------------------------------------------------------------


def shards_of(rows, shards=16):
    """The middle byte's sixteenth of all bytes."""
    made = [(i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows]
    made.sort(key=lambda x: (RANK(x[0]), x[1:]))
    total, at, slots, out = sum(x[1] for x in made), 0, defaultdict(int), []
    for i, size, crc in made:
        s = min(shards - 1, (2 * at + size) * shards // (2 * total))
        out.append((i, size, crc, s, slots[s]))
        slots[s] += 1
        at += size
    return out


@pytest.mark.parametrize("rows", [50, 10**6])
def test_shards(docs, rows, monkeypatch):
    monkeypatch.setattr(sharding.placed, "__defaults__", (16, rows))
    got = [tuple(r) for r in sharding.digest(docs).collect()]
    assert sorted(got, key=repr) == sorted([(*x[:3], "bytes", *x[3:], None) for x in shards_of(plain(docs, "doc_id", "text"))], key=repr)


def test_shards_are_balanced_and_contiguous(spark):
    r = random.Random(3)
    data = [(i, "x" * r.randrange(1, 400)) for i in range(2000)]
    got = sharding.digest(spark.createDataFrame(data, "doc_id long, text string")).toPandas().sort_values("doc_id")
    assert (np.diff(got["shard"]) >= 0).all()
    sizes = got.groupby("shard")["size"].sum()
    assert len(sizes) == 16 and sizes.max() - sizes.min() <= 2 * 400
    assert (got.groupby("shard")["slot"].max() + 1 == got.groupby("shard").size()).all()


def test_shards_of_nothing_and_of_one(spark, docs):
    assert sharding.digest(docs.where("false")).count() == 0
    one = sharding.digest(docs.where("doc_id = 9")).collect()
    assert [(x.shard, x.slot) for x in one] == [(8, 0)]  # its middle is the middle
    giant = spark.createDataFrame([(1, "a"), (2, "b" * 10_000), (3, None)], "doc_id long, text string")
    assert [(x.doc_id, x.size, x.shard, x.slot) for x in sharding.digest(giant).orderBy("doc_id").collect()] == [
        (1, 2, 0, 0), (2, 10_001, 8, 0), (3, 1, 15, 0),
    ]


def test_shards_written(spark, docs, tmp_path):
    sharding.write(docs.where("text is not null"), str(tmp_path / "s"), shards=4, rows=100)
    back = spark.read.parquet(str(tmp_path / "s"))
    assert sorted(c for c in back.columns) == sorted([*docs.columns, "shard", "slot"])
    assert back.groupBy("doc_id", "text").count().exceptAll(docs.where("text is not null").groupBy("doc_id", "text").count()).count() == 0


# --- manifest ------------------------------------------------------------------------------------


def field(x):
    return "-" if x is None else f"{len(str(x).encode())}:{x}"


def tree(nodes):
    """Levels of a list of digests, each run of 8 hashed."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([brute.sha("".join(levels[-1][i : i + 8])) for i in range(0, len(levels[-1]), 8)])
    return levels


def climb(levels, at):
    """(left, right) at each level."""
    steps = []
    for level in levels[:-1]:
        first = at - at % 8
        steps.append(("".join(level[first:at]), "".join(level[at + 1 : first + 8])))
        at //= 8
    return steps


def manifest_of(rows):
    by_lang = defaultdict(list)
    for doc_id, source, lang, n_chars, text in rows:
        digest = brute.sha("".join(map(field, (doc_id, source, lang, n_chars, text))))
        low = None if text is None else text.translate(brute.UPPER)
        odd = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0
        forged = brute.sha("".join(map(field, (doc_id, source, lang, n_chars, low)))) if odd else digest
        by_lang[lang].append((doc_id, digest, forged))
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        by_lang[lang].sort(key=lambda x: (RANK(x[0]), x[1]))
        trees[lang] = tree([x[1] for x in by_lang[lang]])
    top = tree([trees[lang][-1][0] for lang in langs]) if langs else None
    out = []
    for k, lang in enumerate(langs):
        for i, (doc_id, digest, forged) in enumerate(by_lang[lang]):
            steps = climb(trees[lang], i) + climb(top, k)
            acc = forged
            for left, right in steps:
                acc = brute.sha(left + acc + right)
            proof = brute.sha("".join(a + b for a, b in steps))
            out.append((doc_id, digest, trees[lang][-1][0], top[-1][0], proof, acc, acc == top[-1][0]))
    return out


FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


@pytest.mark.parametrize("rows", [40, 10**6])
def test_manifest(docs, rows):
    got = [tuple(r) for r in manifest.digest(docs, rows).collect()]
    assert sorted(got, key=repr) == sorted(manifest_of(plain(docs, *FIELDS)), key=repr)
    assert {r[-1] for r in got} == {True, False}


@pytest.mark.parametrize("where", ["false", "doc_id = 9", "lang is null"])
def test_manifest_of_few(docs, where):
    some = docs.where(where)
    assert sorted(map(tuple, manifest.digest(some).collect()), key=repr) == sorted(manifest_of(plain(some, *FIELDS)), key=repr)


def test_manifest_of_many_languages(spark):
    data = [(i, None, f"l{i % 70}", 1, f"T{i}") for i in range(600)]
    df = spark.createDataFrame(data, "doc_id long, source string, lang string, n_chars long, text string")
    assert sorted(map(tuple, manifest.digest(df, 100).collect())) == sorted(manifest_of(data))


# --- prefix trie ---------------------------------------------------------------------------------


def trie_of(rows):
    """Nodes by walking every rebuilt conversation."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            own[conv].append((RANK(turn) if turn is not None else (False, 0), brute.sha(f"{len(role.encode())}:{role}{text}"), role, text))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    members, final = defaultdict(list), defaultdict(list)
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        path = own.get(base, [])[:h] + own[c][h:]
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
        final[tuple(path)].append(c)
    kids, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for node in sorted(members, key=len, reverse=True):
        leaves[node] += not kids[node]
        saved[node] += (len(members[node]) - 1) * len(node[-1][1] if node else "")
        if node:
            kids[node[:-1]] += 1
            leaves[node[:-1]] += leaves[node]
            saved[node[:-1]] += saved[node]
    return [
        (min(m), len(n), min(members[n[:-1]]) if n else None, len(m), kids[n], leaves[n], saved[n], brute.sha(",".join(map(str, sorted(final[n])))))
        for n, m in members.items()
    ]


TURNS = "conv_id long, turn long, role string, text string, n_convs int, depth string"


def talk(seed):
    r = random.Random(seed)
    rows = []
    for c in [*range(-30, 260), 1000, 1001, 1002, 1099]:
        if c == 100 or c % 17 == 3:
            continue  # a beginning that is not there
        for t in range(r.choice([1, 2, 3, 5, 8])):
            rows.append((c, t if r.random() < 0.95 else None, r.choice(["user", "assistant", None]), r.choice(["hi", "Hé 🎉", "", None, f"x{r.randrange(5)}"])))
    rows += [(5, 1, "user", "hi")] * 3 + [(None, 1, "user", "no one's"), (7, None, None, None)]
    rows += [(300 + i, t, "user", "the same") for i in range(90) for t in range(3)]  # one path, many members
    rows += [(900, t, "user", f"long {t % 3}") for t in range(150)] + [(901, t, "user", f"long {t % 3}") for t in range(150)]
    r.shuffle(rows)
    return [(*x, 1, "x") for x in rows]


@pytest.mark.parametrize(("rows", "shard", "band"), [(10**6, 2**18, 1024), (60, 40, 16), (10**6, 12, 4)])
def test_trie(spark, rows, shard, band):
    data = talk(1)
    got = [tuple(r) for r in prefix_trie.digest(spark.createDataFrame(data, TURNS).repartition(3), rows, shard, band).collect()]
    assert sorted(got, key=repr) == sorted(trie_of([x[:4] for x in data]), key=repr)


def test_shards_of_the_trie_are_bounded(spark):
    shard, band = 40, 8
    nodes = prefix_trie.layered(prefix_trie.paths(spark.createDataFrame(talk(2), TURNS)), shard, band)
    assert nodes.groupBy("band", "layer", "top").count().agg(F.max("count")).first()[0] <= shard
    assert nodes.select("layer").distinct().count() > 1 and nodes.select("band").distinct().count() > 1


@pytest.mark.parametrize("data", [[], [(1, 0, None, None), (None, 1, "user", "x")], [(0, 0, "a", "b"), (1, 0, "a", "b")]])
def test_trie_of_few(spark, data):
    got = prefix_trie.digest(spark.createDataFrame(data, "conv_id long, turn long, role string, text string")).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(trie_of(data), key=repr)


def test_slots_are_minimal_and_verified():
    r = np.random.default_rng(4)
    depth, x1, x2 = r.integers(0, 9, 5000), r.integers(-(2**63), 2**63 - 1, 5000), r.integers(-(2**63), 2**63 - 1, 5000)
    slots = prefix_trie.Slots(depth, x1, x2)
    assert sorted(slots.slot) == list(range(5000)) and (slots.find(depth, x1, x2) == slots.slot).all()
    assert (slots.find(depth, x1 + 1, x2) == -1).all() and (slots.find(depth + 9, x1, x2) == -1).all()
    assert len(prefix_trie.Slots(depth[:0], x1[:0], x2[:0]).slot) == 0


def test_many_ends_are_hashed_in_order(spark):
    data = [(c, 0, "user", "one") for c in range(1, 3000) if c % 100]
    df = spark.createDataFrame(data, "conv_id long, turn long, role string, text string").repartition(5)
    got = {r.depth: r for r in prefix_trie.digest(df, rows=250).collect()}
    want = {x[1]: x for x in trie_of(data)}
    assert {d: tuple(r) for d, r in got.items()} == want
