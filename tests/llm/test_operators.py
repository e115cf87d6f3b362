"""The dealt operators against brute force, on rows with nulls, ties, repeats and clashing columns."""

import math
import random
import re
import time
import zlib

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from revenue_engine.llm import (line_dedup, mixing, nn_descent, packing, pii, pivot_search, queries, simhash,
                                suffix_dedup, toxicity, url_filter)
from revenue_engine.llm.common import connected_components
from revenue_engine.llm.vectors import clean_vectors
from tests.conftest import SF_SMALL

DOCS = "doc_id long, text string, lang string, source string, n_chars long, fp string, size string, _row int"
WORDS = [f"w{i}" for i in range(400)]


def _texts():
    r = random.Random(5)
    base = [" ".join(r.choice(WORDS) for _ in range(40)) for _ in range(12)]
    near = base[0].split()
    near[20] = "changed"
    long_text = " ".join(r.choice(WORDS) for _ in range(6000))
    return [None, "", " \n\t", "one", "two words", base[0], base[0], base[0].upper(), " ".join(near),
            base[1] + "\n" + base[2], base[3] + "\n" + base[2], "Zé " + base[4], base[4] + " ñ", long_text,
            "x" + long_text, *base[5:]]


@pytest.fixture(scope="module")
def rows():
    out = [(i * 3, t, "en", None if i % 5 == 0 else f"s{i % 3}", len(t or ""), "clash", "clash", 1)
           for i, t in enumerate(_texts())]
    return [*out, out[5], (None, "no id here at all", None, None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def _words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def test_mixing(docs, none, rows):
    out = mixing.balanced_copies(docs).collect()
    assert len(out) == len(rows) and mixing.balanced_copies(none).count() == 0
    sizes = {}
    for r in rows:
        sizes[r[3]] = sizes.get(r[3], 0) + len(_words(r[1]))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    want, left, free = {}, 1.5 * sum(sizes.values()), set(order)
    while True:
        level = left / sum(weight[s] for s in free)
        full = {s for s in free if level * weight[s] > 2 * sizes[s]}
        if not full:
            break
        for s in full:
            want[s] = 2.0 * sizes[s]
            left -= want[s]
        free -= full
    want |= {s: level * weight[s] for s in free}
    taken = {}
    for r in out:
        assert r.size == len(_words(rows_text(rows, r.doc_id))) and 0 <= r.taken <= 2 * r.size
        assert math.isclose(r.target, want[r.source], rel_tol=1e-9) and r.source_size == sizes[r.source]
        taken[r.source] = taken.get(r.source, 0) + r.taken
    for s in order:
        longest = max(len(_words(r[1])) for r in rows if r[3] == s)
        assert abs(taken[s] - want[s]) <= 2 * longest
    assert mixing.mixed(docs).columns == docs.columns


def rows_text(rows, doc_id):
    return next(r[1] for r in rows if r[0] == doc_id)


def _fingerprint(t, k=3):
    w = _words(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    hs = [xxhash.xxh64_intdigest(" ".join(w[i:i + k]).encode(), 42) for i in range(max(1, len(w) - k + 1))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def test_simhash(docs, none, rows):
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == len(rows) and simhash.near_duplicates(none).count() == 0
    fps = {r.doc_id: r.fp & (1 << 64) - 1 for r in got}
    assert fps == {r[0]: _fingerprint(r[1]) for r in rows}
    for r in got:
        if r.doc_id in (0, 3, 6):
            assert r.component_id == 0  # null, empty and blank
        if r.doc_id in (15, 18, 21):
            assert r.component_id == 15
    kept = simhash.keep_one_of_each(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert len(ids) == len(set(ids)) == len({r.component_id for r in got}) and None in ids


def test_simhash_signatures_are_not_broadcast(spark, monkeypatch):
    r, plans, write = random.Random(4), {}, simhash.stored

    def stored(df, name):
        plans[name] = df._jdf.queryExecution().sparkPlan().toString()
        return write(df, name)

    monkeypatch.setattr(simhash, "stored", stored)
    docs = spark.createDataFrame([(i, " ".join(r.choices("abcdefgh", k=9))) for i in range(300)], "doc_id long, text string")
    out = simhash.near_duplicates(docs)
    assert out.count() == 300
    # 66 signatures stand for each fingerprint of a file far below the threshold.
    assert "SortMergeJoin" in plans["simhash-met"] and "BroadcastHashJoin" not in plans["simhash-met"]
    # The table of all rows is not the one that is broadcast.
    top = next(x for x in out._jdf.queryExecution().sparkPlan().toString().splitlines() if "Join" in x)
    assert "SortMergeJoin" in top


@pytest.mark.parametrize("max_paired", [1, 1000])
def test_simhash_links_lose_nothing(spark, max_paired):
    r = random.Random(3)
    fps = {r.getrandbits(64) for _ in range(30)}
    for f in list(fps):
        fps |= {f ^ (1 << r.randrange(64)), f ^ (1 << r.randrange(64)) ^ (1 << r.randrange(64))}
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    pairs = {tuple(sorted(p)) for p in simhash.link_fingerprints(df, max_paired).collect()}
    roots = {x.node: x.root for x in connected_components(
        spark.createDataFrame(list(pairs), "a long, b long"), "t").collect()}
    for a in signed:
        for b in signed:
            if a < b and bin((a ^ b) & (1 << 64) - 1).count("1") <= 2:
                assert roots[a] == roots[b]


def test_suffix_dedup(docs, none, rows, monkeypatch):
    def brute():
        seen, out = {}, {}
        for i, t in sorted({(r[0] if r[0] is not None else 1 << 62, r[1] or "") for r in rows}):
            b = t.encode()
            gone = bytearray(len(b))
            for s in range(len(b) - 99):
                if b[s:s + 100] in seen:
                    gone[s:s + 100] = b"\1" * 100
                seen.setdefault(b[s:s + 100], i)
            out[i] = (len(b), sum(gone), bytes(x for x, g in zip(b, gone) if not g))
        return out

    want = brute()
    for bucket in (suffix_dedup.BUCKET_ROWS, 1):  # 1: every bucket is spread by suffix
        monkeypatch.setattr(suffix_dedup, "BUCKET_ROWS", bucket)
        got = suffix_dedup.without_repeats(docs).collect()
        assert len(got) == len(rows)
        for r in got:
            assert (r.n_bytes, r.n_removed, bytes(r.kept)) == want[r.doc_id if r.doc_id is not None else 1 << 62]
    assert suffix_dedup.without_repeats(none).count() == 0


def test_line_dedup(docs, none, rows):
    seen, want = [], {}
    for i, t in sorted({(r[0] if r[0] is not None else 1 << 62, r[1] or "") for r in rows}):
        for k, line in enumerate(t.split("\n")):
            w = _words(line.lower())
            if len(w) >= 5:
                s = {tuple(w[a:a + 5]) for a in range(len(w) - 4)}
                if any(len(s & o) >= 0.8 * len(s | o) - 1e-9 for o in seen):
                    want.setdefault(i, []).append(k)
                seen.append(s)
    got = {r.id: r.removed for r in line_dedup.removed_lines(docs).collect() if r.removed}
    assert got == want
    cut = line_dedup.without_repeated_lines(docs)
    assert cut.columns == docs.columns and cut.count() == len(rows)
    assert {r.doc_id: r.text for r in cut.collect()}[0] is None
    assert line_dedup.without_repeated_lines(none).count() == 0


def test_line_dedup_keeps_null_and_repeated_ids_apart(spark):
    data = [(None, "one a\nsame line\nfirst text"), (None, "two b\nsame line\nsecond text"), (7, "c\nd\nfifth line"), (7, "e\nc\nd")]
    df = spark.createDataFrame(data, "doc_id long, text string")
    got = [r.text for r in line_dedup.without_repeated_lines(df).collect()]
    lines = sorted(x for t in got for x in t.split("\n"))
    assert len(got) == 4 and lines == sorted({x for _, t in data for x in t.split("\n")})
    assert sorted(r.removed_lines for r in _query_on(spark, "op6_line_dedup", df)) in (["", "", "0,1", "1"], ["", "", "1", "1,2"])


def _query_on(spark, name, docs):
    import tempfile
    folder = tempfile.mkdtemp(prefix="run-")
    docs.write.parquet(f"{folder}/documents.parquet")
    return queries.QUERIES[name](spark, folder).collect()


def test_suffix_dedup_keeps_null_and_repeated_ids_apart(spark, monkeypatch):
    r = random.Random(8)
    own = ["".join(r.choice("abcdefghij ") for _ in range(n)) for n in (40, 900, 1500, 10)]
    shared = "".join(r.choice("klmnopqrst ") for _ in range(300))
    data = [(None, own[0] + shared), (None, own[1] + shared), (7, shared + own[2]), (7, own[3] + shared)]
    df = spark.createDataFrame(data, "doc_id long, text string")
    for bucket in (suffix_dedup.BUCKET_ROWS, 1):
        monkeypatch.setattr(suffix_dedup, "BUCKET_ROWS", bucket)
        got = {(x.doc_id, bytes(x.kept).decode()) for x in suffix_dedup.without_repeats(df).collect()}
        rest = {(None, own[0]), (None, own[1])}
        assert got in ({*rest, data[2], (7, own[3])}, {*rest, (7, own[2]), data[3]})


def test_suffix_dedup_writes_bytes_of_meeting_places_only(spark, monkeypatch):
    r = random.Random(12)
    phrases = ["".join(r.choice("abcdefgh ") for _ in range(n)) for n in (30, 40, 50, 52)]
    def apart(n):  # phrases repeat, no 62 bytes do
        return "".join(r.choice(phrases) + "".join(r.choice("ijklmnop") for _ in range(8)) for _ in range(n))
    sizes, keep = {}, suffix_dedup.stored
    def counted(df, name):
        out = keep(df, name)
        sizes[name] = out.count()
        return out
    monkeypatch.setattr(suffix_dedup, "stored", counted)
    plain = [(i, apart(12)) for i in range(20)]
    df = spark.createDataFrame(plain, "doc_id long, text string")
    assert all(x.n_removed == 0 for x in suffix_dedup.without_repeats(df).collect())
    assert sizes["suffix-classes"] > 100 and sizes["suffix-met"] == 0

    passages = [apart(3)[:n] for n in (99, 100, 101, 120, 170)]
    data = [(i, apart(2) + r.choice(passages) + apart(1) + r.choice(passages)) for i in range(40)]
    seen, want = set(), {}
    for i, t in data:
        b, gone = t.encode(), bytearray(len(t))
        for s in range(len(b) - 99):
            if b[s:s + 100] in seen:
                gone[s:s + 100] = b"\1" * 100
            seen.add(b[s:s + 100])
        want[i] = bytes(x for x, g in zip(b, gone) if not g)
    df = spark.createDataFrame(data, "doc_id long, text string")
    assert {x.doc_id: bytes(x.kept) for x in suffix_dedup.without_repeats(df).collect()} == want
    assert 0 < sizes["suffix-met"] < sizes["suffix-classes"]


def test_stored_leaves_no_shuffle_files(spark):
    from revenue_engine.llm.common import stored
    def shuffled():
        found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {f for f in (found.apply(i).getName() for i in range(found.size())) if f.startswith("shuffle_")}
    before = shuffled()
    assert len(stored(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "t").collect()) == 7
    for _ in range(50):  # deleted in the background
        if shuffled() <= before:
            break
        time.sleep(0.1)
    assert shuffled() <= before


def test_line_dedup_of_short_lines(spark):
    df = spark.createDataFrame([(1, "Home\n\nabout  us\nHome"), (2, "home\n \nabout us\nus about\nA b\tc D"), (3, "a b c d\nhomes")],
                               "doc_id long, text string")
    got = {r.id: r.removed for r in line_dedup.removed_lines(df).collect() if r.removed}
    assert got == {1: [3], 2: [0, 2], 3: [0]}
    assert {r.doc_id: r.text for r in line_dedup.without_repeated_lines(df).collect()}[3] == "homes"


def test_packing(docs, none, rows):
    tok = packing.load_tokenizer()
    from tokenizers import Tokenizer
    exact = Tokenizer.from_file(tok.json_path)
    texts = [r[1] or "" for r in rows] + ["<|endoftext|> é\u4e2d", "a" * 500, "  \n\n x"]
    assert [tok.encode(t) for t in texts] == [e.ids for e in exact.encode_batch(texts, add_special_tokens=False)]
    got = packing.pack_pieces(docs, 64).select("*", F.crc32("ids").alias("crc")).collect()
    ids = {r[0]: [*tok.encode(r[1] or ""), 0] for r in rows}
    for r in got:
        part = ids[r.doc_id][r.start:r.start + r.length]
        assert r.crc == zlib.crc32(np.array(part, "<u4").tobytes()) and r.doc_tokens == len(ids[r.doc_id])
    assert sum(r.length for r in got) == sum(len(ids[r[0]]) for r in rows)
    at = 0
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.sequence_id * 64 + r.offset == at
        at += r.length
    assert packing.pack_pieces(none).count() == 0


def test_pii_patterns_and_terms(spark, none):
    t = "mail a.b@x.org, 10.0.0.300 10.1.2.3 card 4111-1111-1111-1111 or 4111111111111112 call +1 (222) 555-0100 a@b@c.de @"
    spans = [(pii.KINDS[k], t[s:e]) for k, s, e in pii.base_spans(t)]
    assert spans == [("email", "a.b@x.org"), ("email", "b@c.de"), ("ip", "10.1.2.3"), ("card", "4111-1111-1111-1111"),
                     ("phone", "+1 (222) 555-0100")]
    told = [(i, f"note {i} says kestrelwood the mail q@z.org the end {i}") for i in range(4)]
    plain = [(100 + i, f"the quick note of day {i}") for i in range(30)] + [(200, None), (201, "")]
    df = spark.createDataFrame(told + plain, "doc_id long, text string")
    got = {r.doc_id: r for r in pii.find_spans(df).collect()}
    assert len(got) == 36 and got[200].spans == "" and got[1].n_email == 1
    words = [x.split(":") for x in got[1].spans.split(",")]
    terms = {told[1][1][int(s):int(e)] for k, s, e in words if k == "term"}
    assert "kestrelwood" in terms and "the" not in terms and "note" not in terms
    clean = {r.doc_id: r.text for r in pii.sanitise(df).collect()}
    assert "[EMAIL]" in clean[1] and "kestrelwood" not in clean[1] and clean[101] == plain[1][1]
    assert pii.find_spans(none).count() == 0


def test_pii_unique_values_and_classes_are_disclosed(spark):
    filler = " ".join(f"common{i}" for i in range(20))
    far = [(i, f"zebrawood {filler} call a{i}@unique{i}.org now") for i in range(1)]  # one text, the term far from the value
    firm = [(10 + i, f"the day {filler} ask p{i}@acme.net or quillfirm {'x' * (i + 3)}") for i in range(4)]  # one domain, four values
    plain = [(100 + i, f"the day {i} {filler} ask or call now") for i in range(40)]
    df = spark.createDataFrame(far + firm + plain, "doc_id long, text string")
    terms = {}
    for r in pii.find_spans(df).collect():
        text = dict(far + firm + plain)[r.doc_id]
        terms[r.doc_id] = {text[int(s):int(e)] for k, s, e in (x.split(":") for x in r.spans.split(",") if x) if k == "term"}
    assert terms[0] == {"zebrawood"}
    assert all("quillfirm" in terms[10 + i] and not terms[10 + i] & {"the", "day", "ask", "common3"} for i in range(4))
    assert not any(terms[100 + i] for i in range(40))


def test_toxicity(spark, none):
    r = random.Random(1)
    texts = [" ".join(r.choice(WORDS[:200]) for _ in range(30)) for _ in range(120)]
    data = [(i, t + (" grobnik" if i % 4 == 0 else "")) for i, t in enumerate(texts)]
    df = spark.createDataFrame(data, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(100)] + [(None, 1), (3, None)], "doc_id long, toxic int")
    model = toxicity.learn(df, labels)
    probe = spark.createDataFrame([(1, "grobnik"), (2, "a gr0bnik here"), (3, 'they said the word "grobnik" today'), (4, None),
                                   (5, ""), (6, "w1 w2 w3")], "doc_id long, text string")
    s = {x.doc_id: x.score for x in toxicity.score(probe, model).collect()}
    assert s[1] >= 0.3 and s[2] >= 0.3 and s[3] < s[1] and s[2] <= s[1]
    assert max(s[4], s[5], s[6]) < 0.3
    assert toxicity.learn(none, labels) is None and toxicity.score(none, None).count() == 0


def test_url_filter(spark):
    rules = spark.createDataFrame(queries.URL_RULES, "host string, path string, verdict string")
    urls = {"https://A.net/x": ("a.net", "/x", "net/", "block"), "http://m.example.net/en/1?q": ("m.example.net", "/en/1", "example.net/en/", "allow"),
            "http://x.net?p": ("x.net", "", None, "allow"), "nohost": ("", "", None, "allow"), None: ("", "", None, "allow"),
            "http://notexample.com/de/": ("notexample.com", "/de/", None, "allow"), "http://example.com/de/": ("example.com", "/de/", "example.com/de/", "block"),
            "x://net/": ("net", "/", "net/", "block"), "x://org/fr": ("org", "/fr", None, "allow")}
    df = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(urls)] + [(0, next(iter(urls)), "clash")],
                               "page_id long, url string, rule string")
    got = url_filter.judge_urls(df, rules).collect()
    assert len(got) == len(urls) + 1
    for r in got:
        assert (r.host, r.path, r.rule, r.verdict) == urls[r.url]
    assert url_filter.judge_urls(df.limit(0), rules).count() == 0
    assert {r.verdict for r in url_filter.judge_urls(df, rules.limit(0)).collect()} == {"allow"}


def _vectors(spark):
    r = np.random.default_rng(2)
    v = r.normal(size=(300, 8)).tolist()
    v[7] = v[3]
    extra = [(900, None), (901, [None] * 8), (902, [float("nan")] * 8), (903, [0.0] * 8), (None, v[0]), (5, v[5]), (950, v[3])]
    return [*enumerate(v), *extra], spark.createDataFrame([*enumerate(v), *extra], "vec_id long, embedding array<double>")


def test_pivot_search_is_exact(spark):
    data, df = _vectors(spark)
    ints = clean_vectors(df, True).select("id", F.transform("v", lambda x: F.floor(x * 256.0).cast("long")).alias("v"))
    got = {}
    for r in pivot_search.top_k(ints, ints.where("id % 50 = 0"), 5).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    clean = {i: [math.floor(256 * x) for x in v] for i, v in data
             if i is not None and v and all(x is not None and math.isfinite(x) for x in v)}
    for q in (i for i in clean if i % 50 == 0):
        best = sorted((-sum(a * b for a, b in zip(clean[q], v)), i) for i, v in clean.items() if i != q)[:5]
        assert sorted(got[q]) == [(n + 1, i, -s) for n, (s, i) in enumerate(best)]
    assert pivot_search.top_k(ints.limit(0), ints.limit(0), 5).count() == 0


def test_nn_descent_recall_and_scores(spark):
    data, df = _vectors(spark)
    rows = clean_vectors(df, False)
    got = nn_descent.nearest(rows, F.col("id") % 20 == 0, 10).collect()
    clean = {i: v for i, v in data if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    hit = total = 0
    for q in (i for i in clean if i % 20 == 0):
        best = {i for _, i in sorted((-np.dot(clean[q], v), i) for i, v in clean.items() if i != q)[:10]}
        mine = [r for r in got if r.query_id == q]
        assert sorted(r["rank"] for r in mine) == list(range(1, 11)) and q not in {r.vec_id for r in mine}
        assert all(abs(r.score - np.dot(clean[q], clean[r.vec_id])) < 1e-9 for r in mine)
        hit, total = hit + len(best & {r.vec_id for r in mine}), total + 10
    assert hit / total >= 0.9
    assert nn_descent.nearest(rows.limit(0), F.col("id") % 20 == 0, 10).count() == 0


def test_nn_descent_blocks_send_rows_of_many_nodes(spark, monkeypatch):
    tables, write = {}, nn_descent.stored

    def stored(df, name):
        out = write(df, name)
        tables.setdefault(name, []).append(out.count())
        return out

    monkeypatch.setattr(nn_descent, "stored", stored)
    # Many blocks, and groups that are split by hash.
    for name, value in (("CELL", 100), ("BLOCK", 150), ("GROUP", 200)):
        monkeypatch.setattr(nn_descent, name, value, raising=False)
    v = np.random.default_rng(8).normal(size=(3000, 12))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(v.tolist())], "id long, v array<double>")
    got = {}
    for r in nn_descent.nearest(rows, F.col("id") % 20 == 0, 10).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert sorted(got) == list(range(0, 3000, 20))
    hit = 0
    for q, found in got.items():
        s = v @ v[q]
        assert [n for n, _, _ in sorted(found)] == list(range(1, 11)) and all(abs(s[i] - x) < 1e-9 for _, i, x in found)
        s[q] = -np.inf
        hit += len(set(np.argsort(-s)[:10].tolist()) & {i for _, i, _ in found})
    assert hit / (10 * len(got)) >= 0.9
    # A row for a block, or for two that meet, where each node and each link had one.
    assert len(tables["ann-graph"]) > 2 and max(tables["ann-graph"]) <= 60 and max(tables["ann-state"]) <= 60 * 60


def test_url_query_matches_its_oracle(spark):
    con = duckdb.connect()
    con.execute(f"create view pages as select * from read_parquet('{SF_SMALL}/pages.parquet')")
    want = sorted(con.execute("select page_id, host, path, rule, verdict from (" + queries.ORACLES["op7_url_rules"] + ")").fetchall(), key=str)
    assert sorted(map(tuple, queries.QUERIES["op7_url_rules"](spark, SF_SMALL).collect()), key=str) == want


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    toxic = {r.doc_id for r in toxicity.score(docs, toxicity.learn(docs, toxicity.training_labels(
        spark.read.parquet(f"{SF_SMALL}/labels.parquet")))).where("score >= 0.3").collect()}
    kept = corpus_pipeline.drop_toxic(spark, docs, SF_SMALL)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in docs.collect()} - toxic
    pieces = corpus_pipeline.run(spark, SF_SMALL).collect()
    assert pieces and {r.doc_id for r in pieces}.isdisjoint(toxic)
    assert max(r.offset + r.length for r in pieces) <= 1024


def test_line_dedup_with_a_frequent_passage(spark, monkeypatch):
    """Lines that share a passage, with every share of own words, meet in few pairs and lose none that match."""
    r = random.Random(11)
    passage = [f"p{i}" for i in range(40)]
    texts = []
    for n in range(1200):
        own = [f"u{r.randrange(1 << 40)}" for _ in range(r.choice([0, 1, 2, 3, 5, 8, 13, 20, 40]))]
        at = r.randrange(41)
        texts.append(" ".join(passage[:at] + own + passage[at:]))
        if n % 50 == 0:
            texts.append(texts[-1] + " tail")
    met, pairs = [], line_dedup.candidate_pairs

    def counted(posts, others, similarity):
        out = pairs(posts, others, similarity).distinct()
        met.append(out.count())
        return out

    monkeypatch.setattr(line_dedup, "candidate_pairs", counted)
    seen, want = [], set()
    for i, t in enumerate(texts):
        w = t.split()
        s = {tuple(w[a:a + 5]) for a in range(len(w) - 4)}
        if any(len(s & o) >= 0.8 * len(s | o) - 1e-9 for o in seen):
            want.add(i)
        seen.append(s)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    assert {x.id for x in line_dedup.removed_lines(df).collect()} == want and 24 < len(want) < len(texts)
    assert len(met) == 2 and sum(met) < 20 * len(texts), met


def test_line_dedup_holds_no_more_tables_than_it_reads(spark, docs, monkeypatch):
    import os
    made, held, keep = {}, {}, line_dedup.stored

    def counted(df, name):
        held[name] = {n for n, path in made.items() if os.path.exists(path.removeprefix("file:"))}
        out = keep(df, name)
        made[name] = out._stored_path
        return out

    monkeypatch.setattr(line_dedup, "stored", counted)
    line_dedup.removed_lines(docs).collect()
    assert "line-prefixes" in held["line-near"] and held["line-matchable"] == {"line-keys", "line-near"}
    assert held["line-postings"] == {"line-keys", "line-matchable", "line-counts"}
    assert held["line-removed"] == {"line-keys", "line-matchable", "line-matched"}


def test_line_dedup_leaves_lines_of_one_common_shingle_early(spark, monkeypatch):
    """Tables after the first prefixes hold the lines that match, not those that share a shingle now and then."""
    r = random.Random(13)
    def own(n):
        return [f"w{r.randrange(1 << 40)}" for _ in range(n)]
    common = [own(5) for _ in range(30)]
    texts = [" ".join(own(30) + r.choice(common) + own(30)) for _ in range(600)]
    texts += [t + " tail" for t in texts[:20]]
    sizes, keep = {}, line_dedup.stored

    def counted(df, name):
        out = keep(df, name)
        sizes[name] = out.count()
        return out

    monkeypatch.setattr(line_dedup, "stored", counted)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    assert {x.id for x in line_dedup.removed_lines(df).collect()} == set(range(600, 620))
    assert 40 <= sizes["line-matchable"] <= 60, sizes


def test_line_dedup_of_small_sets_and_odd_spaces(spark):
    """Against brute force: few shingles, of which all must be shared, copies, repeated rows, spaces of every kind."""
    r = random.Random(14)
    base = [[r.choice("abcdef") + str(r.randrange(3)) for _ in range(r.randrange(1, 22))] for _ in range(60)]
    def line():
        w = list(r.choice(base))
        if r.random() < 0.6:
            w = r.choice([w + ["z"], ["z"] + w, w[1:], w[:-1], w + w[:3]])
        gap = r.choice([" ", " ", "  ", "\t", " \r", "\x0b ", "\x0c"])
        return r.choice(["", " ", "\t"]) + gap.join(w) + r.choice(["", " ", "\r", "  "])
    rows = [(i, "\n".join(line() for _ in range(r.randrange(1, 6)))) for i in range(80)]
    rows += [rows[3], rows[4], (90, None), (91, " \t\n\r\n"), (92, rows[5][1].upper())]
    seen, short, want = [], set(), {}
    for i, t in sorted({(i, t) for i, t in rows if t}):
        for k, x in enumerate(t.split("\n")):
            w = _words(x.lower())
            if len(w) >= 5:
                s = {tuple(w[a:a + 5]) for a in range(len(w) - 4)}
                gone = any(len(s & o) >= 0.8 * len(s | o) - 1e-9 for o in seen)
                seen.append(s)
            else:
                gone = tuple(w) in short
                short |= {tuple(w)} if w else set()
            if gone:
                want.setdefault(i, []).append(k)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert {x.id: x.removed for x in line_dedup.removed_lines(df).collect()} == want and len(want) > 40


def test_line_dedup_writes_shared_tokens_before_postings_are_shuffled(spark, docs, monkeypatch):
    held, keep = [], line_dedup.stored

    def noted(df, name):
        held.append(name)
        return keep(df, name)

    monkeypatch.setattr(line_dedup, "stored", noted)
    line_dedup.removed_lines(docs).collect()
    assert held[:5] == ["line-prefixes", "line-keys", "line-shared", "line-near", "line-matchable"]
