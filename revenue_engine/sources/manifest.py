"""File manifest with SHA-256 checksums (S5) and the checksum audit.

Files of every size take one path: the bytes are read by Spark's text source,
split at line feeds only, through the file systems that all scans use. A split
that is a whole file is hashed where it is read. Splits of larger files are cut
into chunks of ``CHUNK_BYTES``, which meet by file in order of their offset, as
the digest of a file is sequential; a task holds one chunk and one hash state.

The text source drops a byte order mark and does not tell whether the last
line is ended. Both are found again from the file's size: the lines, each with
its line feed, make one byte more than the file if the last is not ended, and
three fewer if a mark was dropped.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revenue_engine.session import listing_parallelism
from revenue_engine.sources.landing import decoded_path, list_files

# Functions for Python workers travel by value: executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

CHUNK_BYTES = 1024 * 1024
MARK = b"\xef\xbb\xbf"  # the byte order mark of UTF-8
_PART_SCHEMA = "file_path string, file_size long, block_start long, n long, chunk binary, checksum string"


class _Digest:
    """SHA-256 of a file given as lines that all end with a line feed, and its size."""

    def __init__(self) -> None:
        self.plain, self.marked = hashlib.sha256(), hashlib.sha256(MARK)
        self.given, self.held = 0, b""

    def update(self, data: bytes) -> None:
        # The last byte is held back: it may be a line feed that the file does not have.
        for part in (self.held, data[:-1]):
            self.plain.update(part)
            self.marked.update(part)
        self.given += len(data)
        self.held = data[-1:]

    def of_file(self, path: str, size: int) -> str:
        lacks = size - self.given  # -1, 0: as read; 2, 3: a mark was dropped
        if lacks not in (-1, 0, len(MARK) - 1, len(MARK)):
            raise ValueError(f"{path}: {self.given} bytes read of {size}, the file changed")
        digest = self.marked if lacks > 0 else self.plain
        if lacks in (0, len(MARK)):
            digest.update(self.held)
        return digest.hexdigest()


def _runs(batch: pa.RecordBatch, *names: str) -> Iterator[tuple[int, int]]:
    """Start and length of the runs of rows that agree in ``names``."""
    cuts = {0, batch.num_rows}
    for name in names:
        ends = pc.run_end_encode(batch.column(name)).run_ends
        cuts.update(ends.to_pylist())
    cuts = sorted(cuts)
    yield from ((a, b - a) for a, b in zip(cuts, cuts[1:]))


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.string())
    names = ("file_path", "file_size", "block_start", "n", "chunk", "checksum")
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=list(names))


def _split_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines of splits, in order: the digest of a split that is a whole file, chunks of any other."""
    split, digest, chunk, n = None, None, bytearray(), 0
    for batch in batches:
        for at, length in _runs(batch, "file_path", "block_start"):
            now = tuple(batch.column(c)[at].as_py() for c in ("file_path", "file_size", "block_start", "block_length"))
            if now != split:
                if split is not None:
                    yield _split_end(split, digest, chunk, n)
                split, chunk, n = now, bytearray(), 0
                digest = _Digest() if now[2] == 0 and now[3] >= now[1] else None
            for line in batch.column("line").slice(at, length):
                chunk += line.as_buffer()
                chunk += b"\n"
                while len(chunk) >= CHUNK_BYTES:
                    if digest is not None:
                        digest.update(bytes(chunk[:CHUNK_BYTES]))
                    else:
                        yield _rows([(*split[:3], n, bytes(chunk[:CHUNK_BYTES]), None)])
                    del chunk[:CHUNK_BYTES]
                    n += 1
    if split is not None:
        yield _split_end(split, digest, chunk, n)


def _split_end(split: tuple, digest: _Digest | None, chunk: bytearray, n: int) -> pa.RecordBatch:
    if digest is None:
        return _rows([(*split[:3], n, bytes(chunk), None)])
    if chunk:
        digest.update(bytes(chunk))
    return _rows([(*split[:3], n, None, digest.of_file(*split[:2]))])


def _joined_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of every file, from its chunks in order."""
    file, digest = None, None
    for batch in batches:
        for row in batch.select(["file_path", "file_size", "chunk"]).to_pylist():
            now = (row["file_path"], row["file_size"])
            if now != file:
                if file is not None:
                    yield _rows([(*file, 0, 0, None, digest.of_file(*file))])
                file, digest = now, _Digest()
            if row["chunk"]:
                digest.update(row["chunk"])
    if file is not None:
        yield _rows([(*file, 0, 0, None, digest.of_file(*file))])


def file_digests(spark: SparkSession, paths) -> DataFrame:
    """``(file_path, checksum)`` of every file of which the text source gives a line; each byte is read once.

    Only bytes of files of several splits are shuffled. A line must fit a row, as in every scan.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    with listing_parallelism(spark):
        text = spark.read.option("lineSep", "\n").option("recursiveFileLookup", "true").text(paths)
    lines = text.select(decoded_path(F.col("_metadata.file_path")).alias("file_path"),
                        F.col("_metadata.file_size").alias("file_size"),
                        F.col("_metadata.file_block_start").alias("block_start"),
                        F.col("_metadata.file_block_length").alias("block_length"),
                        F.col("value").cast("binary").alias("line"))
    parts = lines.mapInArrow(_split_parts, _PART_SCHEMA)
    # One branch: whole files come as one row without bytes, and take the same exchange.
    ordered = parts.repartition("file_path").sortWithinPartitions("file_path", "block_start", "n")
    return ordered.mapInArrow(_whole_or_joined, _PART_SCHEMA).select(_uri("file_path").alias("file_path"), "checksum")


def _whole_or_joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests as they are, and those of files that came in chunks."""
    def chunks() -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = pc.is_valid(batch.column("checksum"))
            done.append(batch.filter(whole))
            yield batch.filter(pc.invert(whole))

    done: list[pa.RecordBatch] = []
    for out in _joined_digests(chunks()):
        yield out
        yield from done
        done.clear()
    yield from done


def _uri(path):
    """File metadata gives ``file:///x``; listings give ``file:/x``."""
    return F.regexp_replace(path, r"^([A-Za-z][A-Za-z0-9+.-]*):///", "$1:/")


def file_manifest(spark: SparkSession, paths) -> DataFrame:
    """``(file_path, size, modified_at, checksum)`` for every landed file."""
    empty, mark = (hashlib.sha256(b).hexdigest() for b in (b"", MARK))
    # Files without a line: empty ones, and those of a byte order mark alone.
    bare = F.when(F.col("size") == 0, F.lit(empty)).when(F.col("size") == len(MARK), F.lit(mark))
    return (list_files(spark, paths).join(file_digests(spark, paths), "file_path", "left")
            .withColumn("checksum", F.coalesce("checksum", bare)))


def checksum_audit(ledger: DataFrame, manifest: DataFrame, keys=("source_id", "file_date")) -> DataFrame:
    """Compare stored checksums with the bytes on disk.

    ``ledger`` has ``keys`` + ``checksum``; ``manifest`` has ``keys`` +
    ``checksum``. Outcome: match, mismatch, missing_file (registered, not
    landed) or unregistered (landed, not registered).
    """
    l = ledger.select(*keys, F.col("checksum").alias("expected"))
    m = manifest.select(*keys, F.col("checksum").alias("actual"))
    j = l.join(m, list(keys), "full_outer")
    outcome = (F.when(F.col("actual").isNull(), F.lit("missing_file"))
               .when(F.col("expected").isNull(), F.lit("unregistered"))
               .when(F.col("expected") == F.col("actual"), F.lit("match"))
               .otherwise(F.lit("mismatch")))
    return j.select(*keys, "expected", "actual", outcome.alias("outcome"))


def content_checksum(df: DataFrame, key: str, text_col: str) -> DataFrame:
    """SHA-256 and UTF-8 byte length of a text column (the checksum of in-table content)."""
    return df.select(key, F.octet_length(text_col).cast("long").alias("n_bytes"),
                     F.sha2(F.col(text_col), 256).alias("checksum"))
