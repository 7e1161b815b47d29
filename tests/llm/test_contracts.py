"""The registered corpus queries, over whole given tables, against plain versions."""

import json
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

pytest.importorskip("airshed.llm")

import brute  # noqa: E402
from airshed.llm import queries  # noqa: E402

SF = "/root/testdata/sf0.01"


def run(spark, name, sf=SF):
    return queries.QUERIES[name](spark, sf).toPandas()


@pytest.fixture(scope="module")
def tables(spark):
    return {
        t: spark.read.parquet(f"{SF}/{t}.parquet").toPandas()
        for t in ("documents", "benchmark", "embeddings", "pages", "labels")
    }


def by_id(frame, key):
    return frame.sort_values(key).reset_index(drop=True)


def test_html(spark, tables):
    got = by_id(run(spark, "op1_html"), "page_id")
    pages = by_id(tables["pages"], "page_id")
    assert list(got.page_id) == list(pages.page_id)
    assert (got.n_chars == got.text.str.len()).all()
    import html
    import re

    for text, page in zip(got.text, pages.html, strict=True):
        # These pages hold one article of one heading and paragraphs.
        body = re.sub(r"<[A-Za-z/!][^<>]*\Z", "", page[page.index("<article>") + 9 :].split("</article>")[0])
        body = re.sub(r"</?(h1|p|br)>", " ", body).replace("<b>", "").replace("</b>", "")
        assert text == " ".join(html.unescape(body).split())


def test_urls_without_links_follow_the_rules(spark, tables):
    got = by_id(run(spark, "op2_urls"), "page_id")
    for row, url in zip(got.itertuples(), by_id(tables["pages"], "page_id").url, strict=True):
        rest = url.split("://", 1)[1]
        host = rest[: min(rest.find(c) if c in rest else len(rest) for c in "/?#")]
        path = rest[len(host) :].split("?")[0].split("#")[0]
        assert (row.host, row.path) == (host.translate(brute.UPPER), path)
        rules = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}
        fits = [r for r in rules if f".{row.host}".endswith("." + r.split("/")[0]) and path.startswith(r[r.index("/") :])]
        best = max(fits, key=len, default=None)
        assert row.rule == best and row.verdict == (rules[best] if best else "allow")


def test_personal_data(spark, tables):
    got = by_id(run(spark, "op3_pii"), "doc_id")
    for row, text in zip(got.itertuples(), by_id(tables["documents"], "doc_id").text, strict=True):
        base = brute.pii(text)
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [
            sum(k == x for k, *_ in base) for x in ("email", "ip", "card", "phone")
        ]
        assert row.base_sha256 == brute.sha(brute.lines(base))
        assert set(brute.lines(base).split(",")) <= set(row.spans.split(","))


def test_language(spark, tables):
    got = by_id(run(spark, "op4_language"), "doc_id")
    docs = by_id(tables["documents"], "doc_id")
    assert list(got.held_out) == [zlib.crc32(str(i).encode()) % 5 == 0 for i in docs.doc_id]
    assert got.score.between(0, 1).all()
    right = (got.lang_pred == docs.lang)[got.held_out]
    assert right.mean() > 0.97


def test_decontamination(spark, tables):
    got = run(spark, "op5_decontamination")
    docs, items = tables["documents"], tables["benchmark"]
    want = brute.contaminated(docs[["doc_id", "text"]].values.tolist(), items[["item_id", "text"]].values.tolist())
    columns = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert sorted(got[columns].values.tolist()) == sorted(map(list, want))
    assert got.contaminated.any()


def test_embeddings(spark, tables):
    got = by_id(run(spark, "op6_embeddings"), "vec_id")
    v = by_id(tables["embeddings"], "vec_id")
    x = np.array(v.embedding.tolist(), np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    hit = (x @ x.T >= 0.93) & (v.label.values[:, None] == v.label.values[None, :])
    np.fill_diagonal(hit, False)
    links = [(a, b) for a, b in zip(*np.nonzero(hit), strict=True) if a < b]
    root = brute.components(range(len(v)), links)
    ids = v.vec_id.values
    assert list(got.n_links) == list(hit.sum(axis=1))
    assert list(got.component_id) == [ids[root[i]] for i in range(len(v))]
    assert list(got.kept) == [ids[root[i]] == ids[i] for i in range(len(v))]


def test_packing(spark, tables):
    import public_tokenizers
    from tokenizers import Tokenizer

    got = run(spark, "op7_packing")
    whole = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts = dict(tables["documents"][["doc_id", "text"]].values)
    pieces = defaultdict(list)
    bins = defaultdict(list)
    for r in got.itertuples():
        pieces[r.doc_id].append(r)
        bins[r.sequence_id].append((r.offset, r.length))
    assert set(pieces) == set(texts)
    for doc, text in texts.items():
        ids = [*whole.encode(text or "", add_special_tokens=False).ids, 0]
        cut = [ids[i : i + 2048] for i in range(0, len(ids), 2048)]
        for k, (r, part) in enumerate(zip(sorted(pieces[doc], key=lambda r: r.piece), cut, strict=True)):
            assert (r.piece, r.start, r.length) == (k, 2048 * k, len(part))
            assert r.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes())
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(bins) <= -(-got.length.sum() // 2048) + 1


def test_quality(spark, tables):
    got = run(spark, "op8_quality").set_index("doc_id")
    labels = tables["labels"]
    good = labels[(labels.quality == 1) & (labels.toxic == 0)].doc_id
    bad = labels[labels.quality == 0].doc_id
    assert got.kept[good].mean() > 0.98 and got.kept[bad].mean() < 0.2


def test_secrets(spark, tables):
    got = by_id(run(spark, "op9_secrets"), "doc_id")
    for row, text in zip(got.itertuples(), by_id(tables["documents"], "doc_id").text, strict=True):
        base = brute.secrets(text)
        assert [row.n_assign, row.n_access, row.n_hex] == [sum(k == x for k, *_ in base) for x in ("assign", "access", "hex")]
        assert row.base_sha256 == brute.sha(brute.lines(base))
        spans = row.spans.split(",") if row.spans else []
        assert set(spans) >= set(filter(None, brute.lines(base).split(",")))


def test_ngram_join(spark, tables):
    got = run(spark, "op10_ngram_join")
    want = brute.near_copies(tables["documents"][["doc_id", "text"]].values.tolist())
    assert sorted(got[["doc_id", "n_links", "component_id"]].values.tolist()) == sorted(map(list, want))
    assert got.kept.sum() == got.component_id.nunique()
    texts = dict(tables["documents"][["doc_id", "text"]].values)
    same = Counter(tuple(brute.words(t)) for t in texts.values())
    assert got.class_id.nunique() == len(same)


def test_pipeline(spark, tables):
    import corpus_pipeline

    documents = spark.read.parquet(f"{SF}/documents.parquet")
    judged = queries.QUERIES["op8_quality"](spark, SF).where("kept").toPandas()
    docs = documents
    texts = dict(tables["documents"][["doc_id", "text"]].values)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, SF)
        assert kept.columns == documents.columns
        rows = dict(kept.select("doc_id", "text").toPandas().values)
        if name == "quality_classifier":
            assert set(rows) == set(judged.doc_id)
        elif name == "ngram_jaccard_join":
            groups = brute.near_copies(list(texts.items()))
            assert set(rows) == {root for _, _, root in groups}
        elif name == "benchmark_decontamination":
            found = brute.contaminated(list(texts.items()), tables["benchmark"][["item_id", "text"]].values.tolist())
            assert set(rows) == {r[0] for r in found if not r[-1]}
        else:
            assert set(rows) == set(texts)
            for i, t in rows.items():
                assert not brute.secrets(t)
                assert (t == texts[i]) == (not brute.secrets(texts[i]))
        docs = spark.createDataFrame(kept.toPandas(), documents.schema)
        texts = rows
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF).toPandas()
    assert set(last.doc_id) == set(texts)
    assert json.loads(json.dumps(sorted(set(last.sequence_id.astype(int)))))
