"""The five stages of the pipeline against brute force, on rows with nulls, empties, ties, repeats and clashing columns."""

import math
import os
import random
import re
import zlib
from collections import Counter

import public_tokenizers
import pytest
import tokenizers
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline as cp
from revenue_engine.llm import common
from revenue_engine.session import shared_dir

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp string, score double, removed int, size string, tkey string"


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def made():
    r = random.Random(11)
    free = [f"w{i}" for i in range(900)]

    def line(n=12):
        return " ".join(r.choice(free) for _ in range(n))

    texts, labels = [], []
    for i in range(60):
        texts.append(line(30) + (" you worthless scum " if i % 2 else " ") + line(10))
        labels.append((i, 0, i % 2))
    shared = line(14)
    changed = shared.split()
    changed[0] = "else"
    long_text = "\n".join(line(400) for _ in range(10))
    copy = "\n".join(line() for _ in range(6))
    texts += [None, "", " \n\t", "Menu", "menu\n" + line(), shared + "\n" + line(), line() + "\n" + shared.upper(), line() + "\n" + " ".join(changed),
              long_text, copy, copy, "é " + line(), "one two"]
    rows = [(i, t, "en", None if i % 5 == 0 else f"s{i % 4}", len(t or ""), "f", 0.5, 7, "x", "k") for i, t in enumerate(texts)]
    rows += [rows[65], rows[65], (None, line(), None, None, None, None, None, None, None, None), (None, None, *[None] * 8)]
    return rows, labels


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("pipeline"))
    rows, labels = made()
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(path + "/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(path + "/labels.parquet")
    return path


def shingles(line):
    w = words(re.sub("[A-Z]", lambda m: m[0].lower(), line))
    return frozenset(" ".join(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def without_lines(rows):
    keyed = {}
    for r in rows:
        keyed.setdefault((r.doc_id is None, r.doc_id or 0, r.text), r)
    places = [((*k[:2], xxhash.xxh64_intdigest((k[2] or "").encode(), 42), n), k, n, shingles(x))
              for k in keyed for n, x in enumerate((k[2] or "").split("\n"))]
    places.sort(key=lambda p: p[0])
    gone = set()
    for j, (_, k, n, s) in enumerate(places):
        if s and any(t and len(s & t) >= 0.8 * len(s | t) - 1e-9 for _, _, _, t in places[:j]):
            gone.add((k, n))
    out = []
    for r in rows:
        k = (r.doc_id is None, r.doc_id or 0, r.text)
        kept = [x for n, x in enumerate((r.text or "").split("\n")) if (k, n) not in gone]
        out.append((r.doc_id, None if r.text is None else "\n".join(kept), r.source, r.fp, r.score))
    return Counter(out)


def fingerprint(t):
    w = words(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    grams = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(rows):
    fps = [fingerprint(r.text) for r in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 2:
                root[find(i)] = find(j)
    groups = {}
    for i, r in enumerate(rows):
        groups.setdefault(find(i), []).append(r)
    return [min(g, key=lambda r: (r.doc_id is None, r.doc_id or 0)).doc_id for g in groups.values()]


def targets(rows):
    held = Counter()
    for r in rows:
        held[r.source] += len(words(r.text))
    sources = sorted(held, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sources)}
    left, open_, got = 1.5 * sum(held.values()), set(sources), {}
    while open_:
        w = sum(weight[s] for s in open_)
        over = [s for s in open_ if left * weight[s] / w > 2 * held[s]]
        if not over:
            got |= {s: left * weight[s] / w for s in open_}
            break
        for s in over:
            got[s] = 2.0 * held[s]
            open_.remove(s)
        left -= sum(2.0 * held[s] for s in over)
    return got


def test_stages_against_brute_force(spark, folder):
    docs = spark.read.parquet(folder + "/documents.parquet")
    rows = docs.collect()
    def settled(df):
        out = spark.createDataFrame(df.collect(), df.schema)
        assert df.columns == docs.columns
        return out, out.collect()

    clean, got = settled(cp.drop_toxic(spark, docs, folder))
    assert Counter(got) == Counter(r for r in rows if "scum" not in (r.text or ""))

    lean, got = settled(cp.drop_lines(spark, clean, folder))
    assert Counter((r.doc_id, r.text, r.source, r.fp, r.score) for r in got) == without_lines(clean.collect())
    assert all(r.n_chars == len(r.text or "") for r in got if r.n_chars is not None)

    one, got = settled(cp.drop_near_copies(spark, lean, folder))
    assert Counter(r.doc_id for r in got) == Counter(components(lean.collect()))
    assert not Counter(got) - Counter(lean.collect())

    mix, got = settled(cp.mix_sources(spark, one, folder))
    assert max(Counter(got).values()) <= 2 and not set(got) - set(one.collect())
    taken = Counter()
    for r in got:
        taken[r.source] += len(words(r.text))
    longest = max(len(words(r.text)) for r in one.collect())
    for source, target in targets(one.collect()).items():
        assert abs(taken[source] - target) <= longest

    pieces = cp.pack(spark, mix, folder).collect()
    tokenizer = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = [(r.doc_id, [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 0]) for r in got]
    want = {}
    for doc_id, x in ids:
        want.setdefault((doc_id, len(x)), []).append(x)
    for p in pieces:
        assert any(zlib.crc32(b"".join(i.to_bytes(4, "little") for i in x[p.start:p.start + p.length])) == p.ids_crc32
                   for x in want[p.doc_id, p.doc_tokens])
    assert Counter((p.doc_id, p.doc_tokens) for p in pieces if p.start == 0) == Counter((d, len(x)) for d, x in ids)
    assert sum(p.length for p in pieces) == sum(len(x) for _, x in ids)
    filled = {}
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        assert p.offset == filled.get(p.sequence_id, 0)
        filled[p.sequence_id] = p.offset + p.length
    assert max(filled.values()) <= 1024 and len(filled) == math.ceil(sum(filled.values()) / 1024)


def test_only_the_last_input_stays_in_the_shared_folder(spark, folder):
    tables = shared_dir(spark).removeprefix("file:") + "/tables"
    before = set(os.listdir(tables)) if os.path.isdir(tables) else set()
    assert cp.run(spark, folder).count() > 0
    new = {name for name in set(os.listdir(tables)) - before if not name.startswith("pack")}
    assert [name.rsplit("-", 1)[0] for name in new] == ["pipeline-mix_sources"]
    for name in ("documents", "labels"):
        spark.read.parquet(f"{folder}/{name}.parquet").where(F.lit(False)).write.parquet(f"{folder}/none/{name}.parquet")
    assert cp.run(spark, folder + "/none").collect() == []


def _broadcasts_exploded(plan):
    """Whether a side that is broadcast is made by an explode, which Spark sizes as if each row stayed one."""
    lines = plan.splitlines()
    for i, x in enumerate(lines):
        depth = x.find("BroadcastExchange")
        for below in lines[i + 1:] if depth >= 0 else ():
            if len(re.match(r"[\s:+\-|]*", below)[0]) <= depth:
                break
            if "Generate explode" in below:
                return True
    return False


def test_no_exploded_table_is_broadcast(spark, folder, monkeypatch):
    plans, write = {}, common.stored

    def stored(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return write(df, name)

    for module in (common, cp.line_dedup, cp.mixing, cp.packing, cp.simhash, cp.toxicity):
        if hasattr(module, "stored"):
            monkeypatch.setattr(module, "stored", stored)
    docs = spark.read.parquet(folder + "/documents.parquet")
    for name, stage in cp.STAGES:
        docs = common.stored(stage(spark, docs, folder), name)
    assert {"simhash-met", *[name for name, _ in cp.STAGES]} <= plans.keys()
    assert [name for name, plan in plans.items() if _broadcasts_exploded(plan)] == []
