"""Digests of files of several splits, of one, and of files the text source gives no line of."""

import hashlib
import random

from revenue_engine.sources import manifest as mf
from tests.conftest import write_file


def contents():
    rnd = random.Random(5)
    noise = bytes(rnd.choice(b"\nab\r\xff\xc3,\"") for _ in range(40_000))
    return {"empty": b"", "mark": mf.MARK, "mark_line": mf.MARK + b"\n", "marked": mf.MARK + b"a,b\n1,2", "twice": mf.MARK * 2 + b"x\n",
            "one": b"x", "feed": b"\n", "feeds": b"\n" * 9_000, "ended": b"a\r\nb\n", "open": b"a\nb", "noise": noise,
            "long_line": b"z" * 50_000 + b"\n" + b"y" * 30_000, "marked_noise": mf.MARK + noise, "a b%20+é[1]": b"q\n" * 4_000}


def test_digests_over_split_edges(spark, tmpdir_path, monkeypatch):
    files = contents()
    for name, data in files.items():
        write_file(tmpdir_path, f"s/{name}.csv", data)
    want = {name: (len(data), hashlib.sha256(data).hexdigest()) for name, data in files.items()}
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for split in ("1009", "4096", old):
            spark.conf.set("spark.sql.files.maxPartitionBytes", split)
            got = mf.file_manifest(spark, tmpdir_path).collect()
            assert {r.file_path.rsplit("/", 1)[1][:-4]: (r.size, r.checksum) for r in got} == want
            assert len(got) == len(files)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def parts(data, cuts, chunk, monkeypatch):
    """The digest through chunks of ``chunk`` bytes of the lines of ``data``, in batches cut at ``cuts``."""
    import pyarrow as pa
    monkeypatch.setattr(mf, "CHUNK_BYTES", chunk)
    lines = data.split(b"\n")
    lines = lines[:-1] if lines[-1] == b"" else lines
    size = len(data)

    def batches(block_length):
        for a, b in zip([0, *cuts], [*cuts, len(lines)]):
            x = lines[a:b]
            yield pa.RecordBatch.from_pydict({"file_path": ["f"] * len(x), "file_size": [size] * len(x), "block_start": [0] * len(x),
                                              "block_length": [block_length] * len(x), "line": pa.array(x, pa.binary())})

    whole = [r for b in mf._split_parts(batches(size)) for r in b.to_pylist()]
    cut = [r for b in mf._whole_or_joined(mf._split_parts(batches(size - 1))) for r in b.to_pylist()]
    return [r["checksum"] for r in whole], [r["checksum"] for r in cut]


def test_chunks_hold_a_bounded_number_of_bytes(monkeypatch):
    for data in (b"abc\n\ndef\n" * 50, b"abc\n" * 50 + b"e", b"x" * 1000 + b"\n\n"):
        want = [hashlib.sha256(data).hexdigest()]
        for chunk in (1, 7, 4096):
            assert parts(data, [1, 2], chunk, monkeypatch) == (want, want)
