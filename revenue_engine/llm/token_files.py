"""Token ids as binary files: canonical length-limited Huffman codes in independent blocks.

Writing takes two passes over the stored ids. The first counts every id of the
corpus; the counts (as many as the vocabulary has ids) give code lengths of at
most ``limit`` bits by package-merge, and lengths alone give the canonical
codes. The second codes the ids of each document, cut into blocks; the blocks
are sorted by document over the cluster and written by Spark's own writer, so
a lost task leaves no partial file.

File format (little-endian). A folder holds ``book`` and ``blocks``:

* ``book``: one file, ``b"TK"``, number of code lengths u32, limit u8, then the
  code length of every id from 0 (0: never used), deflated, then a line feed.
* ``blocks``: files ``part-NNNNN``, in order of N; each is a sequence of blocks
  in ascending order of documents, each followed by a line feed. A block has
  the header ``b"TB"``, flags u8 (1: the document has no id, 2: its last
  block), document id i64, number of ids u32, bytes of code u32; then the bit
  offset u32 of every ``STEP``-th id after the first (the checkpoints); then
  the code bits, highest first. A block needs only the book to be decoded, and
  from every checkpoint decoding can start on its own.

Decoding looks up ``limit`` bits at once in a table of 2^limit entries, for the
stretches between all checkpoints of many blocks side by side, and holds the
end of each stretch against the next checkpoint.

Defined results: a null text is empty and gives the end id alone; documents go
by ascending id, those without one last, rows that repeat an id by a hash of
their ids, and each row is a document of its own; a long text fills as many
blocks as it needs, in one file; an empty table gives a folder without blocks
and no rows; other columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from revenue_engine.llm.common import drop_stored, stored
from revenue_engine.llm.packing import END_ID, load_tokenizer

STEP = 256  # ids between checkpoints
BLOCK_IDS = 1 << 16
GROUP_IDS = 1 << 20  # ids coded or decoded side by side
FILE_BYTES = 16 << 20
LIMIT_BITS = 18  # longest code, more only for vocabularies that need it
BATCH_CHARS = 4_000_000
HEADER, BOOK = "<2sBqII", "<2sIB"  # layouts of the fixed parts
HEADER_BYTES, BOOK_BYTES = struct.calcsize(HEADER), struct.calcsize(BOOK)


# ---- codes ------------------------------------------------------------------

def code_lengths(counts: np.ndarray, limit: int) -> np.ndarray:
    """Lengths of an optimal prefix code of at most ``limit`` bits, 0 for ids that never occur (package-merge)."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    if len(used) == 1:
        lengths[used] = 1
    if len(used) < 2:
        return lengths
    if len(used) > 1 << limit:
        raise ValueError(f"{len(used)} ids need codes of more than {limit} bits")
    leaves = used[np.argsort(counts[used], kind="stable")]
    weight = counts[leaves].astype(np.float64)
    merged, is_leaf = weight, [np.ones(len(leaves), bool)]
    for _ in range(limit - 1):
        pairs = merged[:len(merged) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([weight, pairs])
        order = np.argsort(both, kind="stable")
        merged = both[order]
        is_leaf.append(order < len(weight))
    take, out = 2 * len(leaves) - 2, np.zeros(len(leaves), np.uint8)
    for level in reversed(is_leaf):  # every leaf taken on a level makes its code a bit longer
        n = int(level[:take].sum())
        out[:n] += 1
        take = 2 * (take - n)
    lengths[leaves] = out
    return lengths


@dataclass(frozen=True)
class Book:
    """Canonical codes: by length, then by id."""
    lengths: np.ndarray
    limit: int

    def order(self) -> np.ndarray:
        used = np.flatnonzero(self.lengths)
        return used[np.argsort(self.lengths[used], kind="stable")]

    def codes(self) -> np.ndarray:
        ids = self.order()
        size = np.int64(1) << (self.limit - self.lengths[ids].astype(np.int64))
        out = np.zeros(len(self.lengths), np.uint32)
        out[ids] = (np.cumsum(size) - size) >> (self.limit - self.lengths[ids].astype(np.int64))
        return out

    def table(self) -> tuple[np.ndarray, np.ndarray]:
        """Id and code length for every value of the next ``limit`` bits."""
        ids = self.order()
        size = np.int64(1) << (self.limit - self.lengths[ids].astype(np.int64))
        symbols, lengths = np.zeros(1 << self.limit, np.uint32), np.zeros(1 << self.limit, np.uint8)
        symbols[:size.sum()], lengths[:size.sum()] = np.repeat(ids, size), np.repeat(self.lengths[ids], size)
        return symbols, lengths

    def to_bytes(self) -> bytes:
        return struct.pack(BOOK, b"TK", len(self.lengths), self.limit) + zlib.compress(self.lengths.tobytes(), 9)

    @staticmethod
    def from_bytes(data: bytes) -> Book:
        magic, n, limit = struct.unpack_from(BOOK, data)
        lengths = np.frombuffer(zlib.decompressobj().decompress(data[BOOK_BYTES:]), np.uint8)
        if magic != b"TK" or len(lengths) != n:
            raise ValueError("not a code book")
        return Book(lengths, limit)


# ---- blocks -----------------------------------------------------------------

def coded_blocks(docs: list[tuple], book: Book, codes: np.ndarray) -> list[tuple[int, int, bytes]]:
    """(document's place in ``docs``, number of the block, block) of documents (id, ids)."""
    cuts = [(k, b, ids[a:a + BLOCK_IDS], a + BLOCK_IDS >= len(ids)) for k, (_, ids) in enumerate(docs)
            for b, a in enumerate(range(0, len(ids), BLOCK_IDS))]
    ids = np.concatenate([c[2] for c in cuts])
    count = np.array([len(c[2]) for c in cuts])
    bits = book.lengths[ids].astype(np.int64)
    ends = np.cumsum(bits)
    first = np.cumsum(count) - count  # of each block, in ids
    before = ends[first] - bits[first]
    n_bytes = (ends[first + count - 1] - before + 7) >> 3
    base = np.cumsum(n_bytes) - n_bytes
    at = ends - bits - np.repeat(before, count)  # bit offset in its block
    place = at + np.repeat(base << 3, count)
    value = codes[ids].astype(np.uint64) << (64 - bits - (place & 31)).astype(np.uint64)
    word, n_words = place >> 5, (int(n_bytes.sum()) + 3) // 4 + 1
    # Codes share no bits, so the sums are the words; as numbers below 2^32 they are exact in doubles.
    words = np.bincount(word, (value >> np.uint64(32)).astype(np.float64), n_words)
    words += np.bincount(word + 1, (value & np.uint64(0xFFFFFFFF)).astype(np.float64), n_words + 1)[:n_words]
    raw = words.astype(np.uint32).astype(">u4").tobytes()
    out = []
    for (k, b, part, last), f, start, size in zip(cuts, first.tolist(), base.tolist(), n_bytes.tolist()):
        doc_id = docs[k][0]
        head = struct.pack(HEADER, b"TB", (doc_id is None) | 2 * last, doc_id or 0, len(part), size)
        marks = at[f + STEP:f + len(part):STEP].astype("<u4").tobytes()
        out.append((k, b, head + marks + raw[start:start + size]))
    return out


def headers(content: bytes) -> Iterator[tuple]:
    """(id, last, number of ids, where the checkpoints start, where the bits start, bytes of code) of each block."""
    at = 0
    while at < len(content):
        magic, flags, doc_id, n, size = struct.unpack_from(HEADER, content, at)
        bits = at + HEADER_BYTES + 4 * ((n - 1) // STEP)
        if magic != b"TB" or content[bits + size:bits + size + 1] != b"\n":
            raise ValueError("not a block of token ids")
        yield None if flags & 1 else doc_id, bool(flags & 2), n, at + HEADER_BYTES, bits, size
        at = bits + size + 1


def decoded(content: bytes, heads: list[tuple], limit: int, symbols: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Ids of neighbouring blocks, one after the other."""
    low, high = heads[0][4], heads[-1][4] + heads[-1][5]
    raw = np.zeros(high - low + 4, np.uint32)
    raw[:high - low] = np.frombuffer(content, np.uint8, high - low, low)
    window = raw[:-3] << 24 | raw[1:-2] << 16 | raw[2:-1] << 8 | raw[3:]  # 32 bits from every byte on
    starts, counts, ends = [], [], []
    for _, _, n, marks, bits, size in heads:
        lanes = (n - 1) // STEP + 1
        begin = np.zeros(lanes, np.int64)
        begin[1:] = np.frombuffer(content, "<u4", lanes - 1, marks)
        begin += (bits - low) << 3
        starts.append(begin)
        counts.append(np.minimum(n - STEP * np.arange(lanes), STEP))
        ends.append(np.append(begin[1:], -1 - ((bits - low + size) << 3)))
    start, count, end = np.concatenate(starts), np.concatenate(counts), np.concatenate(ends)
    place = np.cumsum(count) - count
    order = np.argsort(-count, kind="stable")
    pos, to = start[order], place[order]
    active = np.searchsorted(-count[order], -np.arange(STEP), side="left")  # lanes that have an i-th id
    out = np.empty(int(count.sum()), np.uint32)
    mask, room = np.uint32((1 << limit) - 1), 32 - limit
    for i in range(int(count.max())):
        a = active[i]
        p = pos[:a]
        peek = (window[p >> 3] >> (room - (p & 7)).astype(np.uint32)) & mask
        out[to[:a] + i] = symbols[peek]
        p += lengths[peek]
    stop = end[order]
    # A stretch ends at the next checkpoint, the last one of a block in its last byte.
    if not np.where(stop >= 0, pos == stop, (pos + 7) >> 3 << 3 == -1 - stop).all():
        raise ValueError("code bits do not end at their checkpoint")
    return out


# ---- tables and files -------------------------------------------------------

def tokenized(docs: DataFrame, json_path: str | None = None, ranks_path: str | None = None) -> DataFrame:
    """Stored (doc_id, uid, n, ids): ids of whole texts and the end id, unsigned 16-bit where they fit, else 32-bit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok, uid = load_tokenizer(json_path, ranks_path), TaskContext.get().partitionId() << 40

        def batch(rows):
            return pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
                 pa.array([len(r[2]) for r in rows], pa.int64()), pa.array([r[2].dtype.itemsize for r in rows], pa.int32()),
                 pa.array([r[2].tobytes() for r in rows], pa.binary())], names=["doc_id", "uid", "n", "width", "ids"])

        for b in batches:
            rows, chars = [], 0
            for doc_id, text in zip(b.column(0), b.column(1)):
                text = text.as_py() or ""
                ids = np.array(tok.encode(text) + [END_ID], "<u4")
                rows.append((doc_id.as_py(), uid, ids.astype("<u2") if ids.max() < 1 << 16 else ids))
                uid += 1
                chars += len(text)
                if chars > BATCH_CHARS:
                    yield batch(rows)
                    rows, chars = [], 0
            if rows:
                yield batch(rows)

    return stored(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, uid long, n long, width int, ids binary"), "token-ids")


def _ids(width, raw) -> np.ndarray:
    return np.frombuffer(raw, f"<u{width}")


def id_counts(ids: DataFrame) -> np.ndarray:
    """How often each id occurs in the whole corpus."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for b in batches:
            for width, raw in zip(b.column(0).to_pylist(), b.column(1)):
                n = np.bincount(_ids(width, raw.as_buffer()))
                if len(n) > len(total):
                    total, n = n, total
                total[:len(n)] += n
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], names=["id", "n"])

    rows = ids.select("width", "ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(max((r["id"] for r in rows), default=-1) + 1, np.int64)
    for r in rows:
        out[r["id"]] = r["n"]
    return out


def _as_file_rows(df: DataFrame, column: str) -> DataFrame:
    # The text writer puts the bytes of a string out as they are, each row with a line feed.
    return df.select(F.col(column).cast("string").alias("value"))


def write_token_files(docs: DataFrame, path: str, limit: int = LIMIT_BITS, file_bytes: int = FILE_BYTES,
                      json_path: str | None = None, ranks_path: str | None = None) -> None:
    """Token ids of ``docs`` (doc_id, text) as files in the folder ``path``."""
    spark = docs.sparkSession
    ids = tokenized(docs, json_path, ranks_path)
    counts = id_counts(ids)
    limit = max(limit, int(np.count_nonzero(counts) - 1).bit_length() + 1)
    book = Book(code_lengths(counts, limit), limit)
    codes = book.codes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            docs_, keys, n = [], [], 0
            rows = zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(3).to_pylist(), b.column(4))
            for k, (doc_id, rk, uid, width, raw) in enumerate(rows, 1):
                docs_.append((doc_id, _ids(width, raw.as_buffer())))
                keys.append((doc_id, rk, uid))
                n += len(docs_[-1][1])
                if n >= GROUP_IDS or k == b.num_rows:
                    got = coded_blocks(docs_, book, codes)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([keys[g[0]][0] for g in got], pa.int64()), pa.array([keys[g[0]][1] for g in got], pa.int64()),
                         pa.array([keys[g[0]][2] for g in got], pa.int64()), pa.array([g[1] for g in got], pa.int32()),
                         pa.array([g[2] for g in got], pa.binary())], names=["doc_id", "rk", "uid", "block", "bytes"])
                    docs_, keys, n = [], [], 0

    blocks = stored(ids.select("doc_id", F.xxhash64("ids").alias("rk"), "uid", "width", "ids").mapInArrow(
        run, "doc_id long, rk long, uid long, block int, bytes binary"), "token-blocks")
    drop_stored(ids)
    total = int((counts * book.lengths).sum()) // 8
    order = [F.col("doc_id").asc_nulls_last(), F.col("rk"), F.col("uid")]
    # Blocks of a document share its key and so its file; other rows of a frequent id differ in rk or uid.
    placed = blocks.repartitionByRange(max(1, -(-total // file_bytes)), *order).sortWithinPartitions(*order, "block")
    _as_file_rows(placed, "bytes").write.text(f"{path}/blocks")
    drop_stored(blocks)
    _as_file_rows(spark.createDataFrame([(bytearray(book.to_bytes()),)], "b binary"), "b").coalesce(1).write.text(f"{path}/book")


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document: ids little-endian unsigned 32-bit, start counts all ids before it."""
    book = Book.from_bytes(bytes(spark.read.format("binaryFile").load(f"{path}/book/part-*").select("content").first()["content"]))
    limit = book.limit
    files = (spark.read.schema("path string, modificationTime timestamp, length long, content binary").format("binaryFile")
             .load(f"{path}/blocks").select(F.regexp_extract("path", r"part-([0-9]+)[^/]*$", 1).cast("long").alias("file"), "content"))

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            total = [sum(h[2] for h in headers(c.as_buffer().to_pybytes())) for c in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(total, pa.int64())], names=["file", "total"])

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        symbols, lengths = book.table()
        for b in batches:
            for file, c in zip(b.column(0).to_pylist(), b.column(1)):
                yield from _documents(file, c.as_buffer().to_pybytes(), limit, symbols, lengths)

    # One row a file, and their running sum.
    totals = files.mapInArrow(sizes, "file long, total long").groupBy("file").agg(F.sum("total").alias("total"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    base = totals.select("file", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    rows = files.mapInArrow(decode, "file long, doc_id long, at long, n_tokens long, ids binary")
    return rows.join(F.broadcast(base), "file").select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids")


def _documents(file: int, content: bytes, limit: int, symbols: np.ndarray, lengths: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Documents of one file; ``at`` counts the ids before them in the file."""
    group, n, at, open_ = [], 0, 0, []

    def flush():
        nonlocal at
        ids, rows, k = decoded(content, group, limit, symbols, lengths), [], 0
        for doc_id, last, size, *_ in group:
            open_.append(ids[k:k + size])
            k += size
            if last:
                whole = open_[0] if len(open_) == 1 else np.concatenate(open_)
                rows.append((doc_id, at, len(whole), whole.astype("<u4").tobytes()))
                at += len(whole)
                open_.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array([file] * len(rows), pa.int64()), pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
             pa.array([r[2] for r in rows], pa.int64()), pa.array([r[3] for r in rows], pa.binary())],
            names=["file", "doc_id", "at", "n_tokens", "ids"])

    for h in headers(content):
        group.append(h)
        n += h[2]
        if n >= GROUP_IDS:
            yield flush()
            group, n = [], 0
    if group:
        yield flush()
    if open_:
        raise ValueError("a document has no last block")
