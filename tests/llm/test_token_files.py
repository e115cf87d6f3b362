"""Token files: optimal lengths, exact round trips, damaged blocks."""

import heapq
import os
import zlib

import numpy as np
import pytest

from revenue_engine.llm import token_files as tf

SCHEMA = "doc_id long, text string"


def tokenizer():
    import public_tokenizers as P
    from tokenizers import Tokenizer
    return Tokenizer.from_file(P.path("byte_bpe_50k.json"))


def huffman_cost(counts):
    heap, cost = [int(c) for c in counts if c], 0
    heapq.heapify(heap)
    while len(heap) > 1:
        pair = heapq.heappop(heap) + heapq.heappop(heap)
        cost += pair
        heapq.heappush(heap, pair)
    return cost


def test_lengths_are_optimal_and_limited():
    rng = np.random.default_rng(1)
    for n in (2, 3, 17, 300):
        counts = (rng.pareto(0.6, n) * 5 + 1).astype(np.int64)
        counts[rng.integers(0, n, n // 4)] = 0
        if np.count_nonzero(counts) < 2:
            counts[:2] = 1
        free = tf.code_lengths(counts, 40)
        assert int((free * counts).sum()) == huffman_cost(counts)
        limit = int(np.count_nonzero(counts) - 1).bit_length() + 1
        held = tf.code_lengths(counts, limit)
        assert held.max() <= limit and ((held > 0) == (counts > 0)).all()
        assert (0.5 ** held[held > 0].astype(float)).sum() <= 1
        assert int((held * counts).sum()) >= huffman_cost(counts)
    assert tf.code_lengths(np.array([0, 7, 0]), 18).tolist() == [0, 1, 0]
    with pytest.raises(ValueError):
        tf.code_lengths(np.ones(9, int), 3)


def best_limited(counts, limit):
    """Least cost of a prefix code of at most ``limit`` bits, over all length vectors."""
    counts = sorted((c for c in counts if c), reverse=True)
    best = [None]

    def go(i, low, room, cost):
        if i == len(counts):
            best[0] = cost if best[0] is None else min(best[0], cost)
            return
        for length in range(low, limit + 1):
            if room - 2.0 ** -length >= -1e-12:
                go(i + 1, length, room - 2.0 ** -length, cost + counts[i] * length)

    go(0, 1, 1.0, 0)
    return best[0]


def test_limited_lengths_against_all_codes():
    for counts, limit in (([100, 50, 20, 5, 1, 1], 3), ([64, 32, 16, 8, 4, 2, 1], 4), ([9, 9, 1, 1, 1], 3), ([5, 5, 5, 5], 2)):
        got = tf.code_lengths(np.array(counts), limit)
        assert int((got * np.array(counts)).sum()) == best_limited(counts, limit)


def test_blocks_decode_alone(monkeypatch):
    monkeypatch.setattr(tf, "BLOCK_IDS", 1000)
    rng = np.random.default_rng(2)
    counts = np.zeros(5000, np.int64)
    docs = [(k if k else None, (rng.pareto(0.7, n) * 3).astype(np.int64).clip(0, 4999)) for k, n in enumerate((1, 255, 256, 257, 1000, 1001, 3500))]
    for _, ids in docs:
        counts += np.bincount(ids, minlength=5000)
    book = tf.Book(tf.code_lengths(counts, 18), 18)
    book = tf.Book.from_bytes(book.to_bytes() + b"\n")
    got = tf.coded_blocks(docs, book, book.codes())
    symbols, lengths = book.table()
    content = b"".join(b + b"\n" for _, _, b in got)
    heads = list(tf.headers(content))
    assert (tf.decoded(content, heads, 18, symbols, lengths) == np.concatenate([d for _, d in docs])).all()
    for (k, b, _), h in zip(got, heads):  # each block without its neighbours
        part = docs[k][1][b * 1000:(b + 1) * 1000]
        assert (tf.decoded(content, [h], 18, symbols, lengths) == part).all() and h[0] == docs[k][0]
        assert h[1] == ((b + 1) * 1000 >= len(docs[k][1]))
    damaged = bytearray(content)
    damaged[heads[-1][4] + 40] ^= 0x55
    damaged[heads[-1][4] + 41] ^= 0xFF
    with pytest.raises(ValueError):
        out = tf.decoded(bytes(damaged), [heads[-1]], 18, symbols, lengths)
        raise ValueError if (out != docs[-1][1][-500:]).any() else AssertionError


def files(spark, tmpdir_path, rows, **kw):
    path = tmpdir_path + "/files"
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' as ids", "1 as uid")
    tf.write_token_files(df.repartition(3), path, **kw)
    return path, tf.read_token_files(spark, path).collect()


def test_round_trip_of_documents(spark, tmpdir_path):
    tok = tokenizer()
    long = "Lorem ipsum dolor sit amet, " * 30_000
    rows = [(5, "a b"), (3, None), (3, ""), (9, "naïve 漢字 🙂\x00\r\n"), (None, "last"), (1, long), (7, "<|endoftext|> x"),
            (5, "a b"), (5, "c"), (-4, "  first \t")]
    path, got = files(spark, tmpdir_path, rows, file_bytes=20_000)
    assert len([f for f in os.listdir(path + "/blocks") if f.startswith("part-")]) > 1
    want = {}
    for d, t in rows:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [0]
        want.setdefault(d, []).append(np.array(ids, "<u4").tobytes())
    back = {}
    for r in got:
        back.setdefault(r["doc_id"], []).append(bytes(r["ids"]))
    assert {k: sorted(v) for k, v in back.items()} == {k: sorted(v) for k, v in want.items()}
    at = 0
    for r in sorted(got, key=lambda r: r["start"]):
        assert r["start"] == at and r["n_tokens"] * 4 == len(r["ids"])
        at += r["n_tokens"]
    ordered = [r["doc_id"] for r in sorted(got, key=lambda r: r["start"])]
    assert ordered == [-4, 1, 3, 3, 5, 5, 5, 7, 9, None]


@pytest.mark.parametrize("rows", [[], [(1, None)], [(2, None), (1, ""), (1, "")]])
def test_tables_without_words(spark, tmpdir_path, rows):
    _, got = files(spark, tmpdir_path, rows)
    assert [(r["doc_id"], r["start"], r["n_tokens"], zlib.crc32(r["ids"])) for r in sorted(got, key=lambda r: r["start"])] == \
        [(d, i, 1, zlib.crc32(bytes(4))) for i, (d, _) in enumerate(sorted(rows, key=lambda r: r[0]))]


def test_whole_table(spark):
    from revenue_engine.llm.queries import QUERIES
    from tests.conftest import SF_SMALL
    tok, at = tokenizer(), 0
    got = {r["doc_id"]: r for r in QUERIES["op12_token_files"](spark, SF_SMALL).collect()}
    for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").orderBy("doc_id").collect():
        ids = np.array(tok.encode(r["text"] or "", add_special_tokens=False).ids + [0], "<u4")
        g = got.pop(r["doc_id"])
        assert (g["start"], g["n_tokens"], g["ids_crc32"]) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    assert not got
