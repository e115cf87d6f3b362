"""SimHash near-duplicates by deletion-variant signatures.

The 64-bit fingerprint is cut into two segments. Two fingerprints within two
bits differ by at most one bit in one of them, so they share that segment, or
the segment with one bit wildcarded. Each fingerprint is indexed under its
exact segments and all one-wildcard variants; an equality join finds
candidates and the bit distance of the whole fingerprints decides. Equal
fingerprints are one node, so exact copies never meet in pairs; wildcard
variants join only fingerprints that differ in the wildcarded bit.

A signature held by more than ``MAX_PAIRED`` fingerprints is not paired: its
fingerprints are indexed under all two-wildcard signatures of the whole
fingerprint, where equality alone proves a link and at most four fingerprints
share a signature. Nothing is lost by that, and work stays linear.

Defined results: a null, empty or blank text has fingerprint zero, which links
like any other; fewer words than a shingle give one shingle of all words;
A-Z only are lower-cased; repeated rows get equal results; of null ids a
component has none to be named by, so its id is the smallest that is not null;
empty tables give empty results. Other columns are returned untouched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revenue_engine.llm.common import connected_components, drop_stored, stored

SEED = 42
MAX_PAIRED = 1000


def fingerprint_bytes(text: str | None, shingle: int = 3) -> bytes:
    """Eight little-endian bytes of the fingerprint of one text."""
    import xxhash

    h = xxhash.xxh64_intdigest
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return bytes(8)
    if len(words) <= shingle:
        hashes = [h(b" ".join(words), SEED)]
    else:
        hashes = [h(b" ".join(s), SEED) for s in zip(*(words[i:] for i in range(shingle)))]
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65536):
        part = np.array(hashes[at:at + 65536], dtype="<u8")
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return np.packbits((2 * ones > len(hashes)).astype(np.uint8), bitorder="little").tobytes()


def with_fingerprint(docs: DataFrame, shingle: int = 3, text: str = "text") -> DataFrame:
    """(_row, fp): the input row as a struct and its fingerprint as a signed long."""
    cols = [F.col(f"`{c}`") for c in docs.columns]
    row = docs.select(F.struct(*cols).alias("_row"), F.col(f"`{text}`").cast("string").alias("_text"))

    @F.pandas_udf("long")
    def fp(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            raw = b"".join(fingerprint_bytes(t, shingle) for t in batch)
            yield pd.Series(np.frombuffer(raw, dtype="<i8"))

    return row.select("_row", fp("_text").alias("fp"))


def link_fingerprints(fps: DataFrame, max_paired: int = MAX_PAIRED) -> DataFrame:
    """Links (a, b) that connect every two distinct fingerprints within two bits; ``fps``: distinct ``fp``."""
    k = F.col("k")
    keyed = (fps.select("fp", F.explode(F.sequence(F.lit(0), F.lit(65))).alias("k"))
             .withColumn("j", (k % 33))
             .withColumn("seg", F.when(k < 33, F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF)))
                         .otherwise(F.shiftrightunsigned("fp", 32)))
             .withColumn("bit", F.when(F.col("j") < 32, F.expr("cast(shiftright(seg, j) & 1 as int)")).otherwise(-1))
             .select("fp", "bit", F.expr("shiftleft(cast(k as bigint), 32) | "
                                         "if(j < 32, seg & ~shiftleft(1L, j), seg)").alias("sig")))
    groups = (keyed.groupBy("sig").agg(F.count(F.lit(1)).alias("n"), F.min("bit").alias("lo"), F.max("bit").alias("hi"))
              .where("n > 1 and (lo <> hi or hi = -1)").select("sig", "n"))
    # Spark sizes an exploded table as if each row stayed one, and would broadcast all signatures of a small file of
    # fingerprints from the driver; merged, neither side passes through it.
    met = stored(keyed.hint("merge").join(groups, "sig"), "simhash-met")
    few = met.where(F.col("n") <= max_paired)
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= 2
    left = few.select("sig", F.col("fp").alias("a"), F.col("bit").alias("abit"))
    right = few.select("sig", F.col("fp").alias("b"), F.col("bit").alias("bbit"))
    # Wildcarded bit 0 against 1; for exact segments (-1) the smaller fingerprint first.
    pairs = (left.hint("merge").join(right, "sig")
             .where(((F.col("abit") == 0) & (F.col("bbit") == 1))
                    | ((F.col("abit") == -1) & (F.col("a") < F.col("b"))))
             .where(near).select("a", "b"))
    hot = met.where(F.col("n") > max_paired).select("fp").distinct()
    masks = F.expr("flatten(transform(sequence(0, 62), i -> transform(sequence(i + 1, 63), j -> "
                   "struct(i * 64 + j as c, ~(shiftleft(1L, i) | shiftleft(1L, j)) as m))))")
    signed = hot.select("fp", F.explode(masks).alias("w")).select("fp", F.col("w.c").alias("c"),
                                                                  F.col("fp").bitwiseAND(F.col("w.m")).alias("v"))
    # At most four fingerprints agree outside two bits, so the collected sets are bounded.
    shared = (signed.groupBy("c", "v").agg(F.min("fp").alias("a"), F.collect_set("fp").alias("all"))
              .where(F.size("all") > 1).select("a", F.explode("all").alias("b")).where("a <> b"))
    return pairs.unionByName(shared).distinct()


def simhash_components(fps: DataFrame, max_paired: int = MAX_PAIRED) -> DataFrame:
    """(fp, component_id) for every distinct fingerprint of ``fps`` (doc_id, fp)."""
    ids = stored(fps.groupBy("fp").agg(F.min("doc_id").alias("min_id")), "simhash-nodes")
    links = link_fingerprints(ids.select("fp"), max_paired)
    nodes = connected_components(links, "simhash")
    rooted = (ids.join(nodes.withColumnRenamed("node", "fp"), "fp", "left")
              .select("fp", "min_id", F.coalesce("root", "fp").alias("root")))
    best = rooted.groupBy("root").agg(F.min("min_id").alias("component_id"))
    return rooted.join(best, "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, shingle: int = 3, text: str = "text", max_paired: int = MAX_PAIRED) -> DataFrame:
    """(doc_id, fp, component_id) for every row of ``docs``."""
    fps = stored(with_fingerprint(docs, shingle, text)
                 .select(F.col("_row.doc_id").cast("long").alias("doc_id"), "fp"), "simhash-fps")
    comp = simhash_components(fps, max_paired)
    # Ids in order take next to nothing in the file by which Spark would choose to broadcast them.
    return fps.hint("merge").join(comp, "fp").select("doc_id", "fp", "component_id")


def keep_one_of_each(docs: DataFrame, shingle: int = 3, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay: of each component the row with the smallest id.

    Rows that repeat an id stay once; of different texts with that id, the one with the smallest hash.
    A component without any id keeps one row in the same way.
    """
    fps = stored(with_fingerprint(docs, shingle, text)
                 .select(F.col("_row.doc_id").cast("long").alias("doc_id"), "fp"), "simhash-fps")
    comp = stored(simhash_components(fps), "simhash-comp")
    repeats = fps.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 or doc_id is null")
    if repeats.isEmpty():
        named = comp.select("component_id").distinct()
        return docs.join(named, docs["doc_id"] == named["component_id"], "left_semi")
    rows = with_fingerprint(docs, shingle, text).join(comp, "fp")
    return (rows.where(F.col("_row.doc_id").eqNullSafe(F.col("component_id")))
            .groupBy("root").agg(F.min_by("_row", F.struct(F.xxhash64("_row.text"), F.col("_row.text"))).alias("_row"))
            .select("_row.*"))
