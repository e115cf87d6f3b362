"""Corpus pipeline: toxicity, line dedup, SimHash near-dedup, source mixing, packing.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor
kept; all but the last return the columns of ``documents``. ``run`` writes each
stage as Parquet in the cluster-shared folder and reads it again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revenue_engine.llm import line_dedup, mixing, packing, simhash, toxicity
from revenue_engine.llm.common import drop_stored, stored_alone, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the model does not take for toxic.

    Null and empty texts, null ids and repeated rows stay; long texts are read whole; a text gets one score wherever
    it stands. Columns of any name pass unchanged. Where ``labels`` has no row of one of the classes, all rows stay.
    """
    model = toxicity.learn(docs, toxicity.training_labels(table(spark, sf_dir, "labels")))
    scored = toxicity.score(docs.select(F.struct(*docs.columns).alias("_row"), F.col("text").alias("_text")), model, "_text")
    return scored.where(F.col("score") < toxicity.THRESHOLD).select("_row.*")


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that repeat an earlier one.

    No row is lost: null texts stay null, and a text of repeated lines alone becomes empty. Rows that repeat an id
    and its text lose the same lines; of equal lines the one with the smallest (doc_id, text hash, line) stays, null
    ids last. ``n_chars`` follows the text; all other columns pass unchanged.
    """
    return line_dedup.without_repeated_lines(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group, the one with the smallest id.

    Null, empty and blank texts are one group, as their fingerprint is zero, so one of them stays. Repeated rows stay
    once; of several texts with the smallest id, or without ids, the one with the smallest hash stays. Columns pass unchanged.
    """
    return simhash.keep_one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, from zero to two times.

    A null source is a source of its own, after all others. Texts without words weigh nothing and stay once. Null ids
    and repeated rows are rows like any other; columns pass unchanged.
    """
    return mixing.mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 1024 tokens.

    A null text is empty and has its end id alone. Each row is packed, repeats included; long texts are cut over
    sequences. No input column passes but ``doc_id``, so names cannot clash.
    """
    return packing.pack_pieces(docs).select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
                                            "doc_tokens", "sequence_id", "offset")


STAGES = [("toxicity", drop_toxic), ("line_dedup", drop_lines), ("simhash_near_dedup", drop_near_copies),
          ("mix_sources", mix_sources), ("packing", pack)]

# Fingerprint components, tilted rates and token ids are beyond SQL; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the last stage over ``documents``; an empty table gives none.

    Of each stage only its result stays in the shared folder, until the next one is written.
    """
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        new = stored_alone(spark, lambda: stage(spark, docs, sf_dir), f"pipeline-{name}")
        drop_stored(docs)
        docs = new
    return STAGES[-1][1](spark, docs, sf_dir)
