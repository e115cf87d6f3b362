"""Blocked search against scoring every document."""

import re
from collections import Counter
from math import floor, log

import numpy as np
import pytest

from revenue_engine.llm import blocked_search as bs

PATTERN = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return PATTERN.findall((text or "").translate(LOWER))


def brute(docs, queries, k):
    counts = [(d, Counter(terms(t))) for d, t in docs]
    counts = [(d, c, sum(c.values())) for d, c in counts if c]
    n_docs, n_terms = len(counts), sum(n for *_, n in counts)
    df = Counter(t for _, c, _ in counts for t in c)
    out = []
    for q, text in set(queries):
        scored = []
        for d, c, n in counts:
            m = 100 - 50 + (50 * n * n_docs) // n_terms
            score = sum(floor(1000 * log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m))
                        for t in set(terms(text)) if t in c)
            if score > 0:
                scored.append((-score, d is None, d or 0, d))
        out += [(q, r, d, -s) for r, (s, _, _, d) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def corpus(n, seed=0):
    rng = np.random.default_rng(seed)
    words = [f"w{i}" if i % 3 else f"É{i}ß" for i in range(400)]
    p = 1 / np.arange(1, 401)
    p /= p.sum()
    docs = [(i, " ".join(rng.choice(words, rng.integers(1, 60), p=p))) for i in range(n)]
    queries = [(i, ", ".join(rng.choice(words, 12, p=None if i % 2 else p)).upper().replace("SS", "ß")) for i in range(25)]
    return docs, queries


def got(spark, docs, queries, k):
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as n", "2 as score", "'a' as query")
    q = spark.createDataFrame(queries, "item_id long, text string").selectExpr("*", "3 as id")
    return sorted((tuple(r) for r in bs.top_documents(d, q, k).select("id", "rank", "doc_id", "score").collect()), key=str)


def test_against_scoring_every_document(spark, monkeypatch):
    for name, v in (("SHARD_DOCS", 300), ("BLOCK_DOCS", 8)):
        monkeypatch.setattr(bs, name, v)
    docs, queries = corpus(2000)
    docs += [(10_000 + i, docs[0][1]) for i in range(300)]  # copies: ties at every rank
    assert got(spark, docs, queries, 10) == brute(docs, queries, 10)


def test_batches_of_queries(spark, monkeypatch):
    monkeypatch.setattr(bs, "BATCH_TERMS", 100)
    docs, queries = corpus(300, 4)
    assert got(spark, docs, queries, 7) == brute(docs, queries, 7)


def test_edge_cases(spark):
    docs = [(1, None), (2, ""), (3, "-- ,"), (4, "Alpha beta"), (4, "Alpha beta"), (4, "beta beta"), (None, "ALPHA beta"), (5, "x" * 3000),
            (6, "alpha\x00beta Été"), (7, "word " * 50_000 + "alpha")]
    queries = [(1, "alpha"), (1, "alpha"), (1, "Beta?"), (None, "été"), (2, None), (3, ""), (4, "nothing"), (5, "x" * 3000 + " été")]
    assert got(spark, docs, queries, 5) == brute(docs, [q for q in queries if q[1]], 5)


@pytest.mark.parametrize("docs,queries", [([], [(1, "a")]), ([(1, "a")], []), ([(1, None)], [(1, "a")]), ([(1, "a")], [(1, "?")])])
def test_empty(spark, docs, queries):
    assert got(spark, docs, queries, 5) == []


def test_long_texts_are_cut_between_terms(monkeypatch):
    text = "".join(np.random.default_rng(1).choice(["ab ", "c,", "Dé", "9"], 5000))
    whole = bs.term_counts(text)
    monkeypatch.setattr(bs, "PIECE", 37)
    assert bs.term_counts(text) == whole
    assert whole[0] == len(terms(text)) and whole[1] == Counter(t.encode() for t in terms(text))


def shard(n=3000, size=300, seed=0):
    rng = np.random.default_rng(seed)
    topics = [rng.choice(size, 40, replace=False) for _ in range(12)]
    rows = [np.unique(np.concatenate([rng.choice(topics[i % 12], 15), rng.integers(0, 20, 4)])) for i in range(n)]
    ptr = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    tid = np.concatenate(rows)
    df = np.bincount(tid, minlength=size)
    weights = np.array([bs.weight(n, int(x)) for x in df])
    return bs.build_shard(ptr, tid, rng.integers(300_000, 500_000, len(tid)), weights), weights, topics, rng


def test_summaries_bound_every_document():
    s, weights, _, _ = shard()
    dense = np.zeros((len(s.ptr) - 1, len(weights)), np.int64)
    dense[np.repeat(np.arange(len(s.ptr) - 1), np.diff(s.ptr)), s.tid] = s.imp
    held = [set() for _ in weights]
    for b, t in enumerate(s.block_term):
        docs = s.block_doc[s.block_ptr[b]:s.block_ptr[b + 1]]
        top = np.zeros(len(weights), np.int64)
        top[s.sum_tid[s.sum_ptr[b]:s.sum_ptr[b + 1]]] = s.sum_max[s.sum_ptr[b]:s.sum_ptr[b + 1]].astype(np.int64) * bs.UNIT
        most = dense[docs].max(axis=0)
        assert (top >= most).all() and (top < most + bs.UNIT).all()
        held[t] |= set(docs.tolist())
    assert all(held[t] == set(np.flatnonzero(dense[:, t])) for t in range(len(weights)))


def test_blocks_are_skipped(monkeypatch):
    monkeypatch.setattr(bs, "BLOCK_DOCS", 8)
    s, weights, topics, rng = shard()
    docs = np.stack([np.zeros(3000, np.int64), np.arange(3000)], axis=1)
    searcher = bs.Searcher(s, docs, weights)
    for topic in topics:
        terms_ = np.unique(np.concatenate([rng.choice(topic, 6, replace=False), rng.integers(0, 20, 4)]))
        best = bs.Best.none(10)
        searcher.search(terms_, best)
        scores = np.zeros(3000, np.int64)
        own = np.zeros(len(weights), np.int64)
        own[terms_] = weights[terms_]
        np.add.at(scores, np.repeat(np.arange(3000), np.diff(s.ptr)), own[s.tid] * s.imp)
        order = np.lexsort((np.arange(3000), -scores))[:10]
        assert best.docs[:, 1].tolist() == order.tolist() and best.scores.tolist() == scores[order].tolist()
    assert 0 < searcher.evaluated < 0.7 * searcher.blocks
