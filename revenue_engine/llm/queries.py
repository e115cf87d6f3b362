"""The dealt operators as queries over the driver's tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revenue_engine.llm import (blocked_search, line_dedup, mixing, nn_descent, packing, pii, pivot_search, simhash, suffix_dedup, token_files, toxicity,
                                url_filter, whitening)
from revenue_engine.llm.common import table
from revenue_engine.llm.vectors import clean_vectors
from revenue_engine.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op3_entropy_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to source weights 5, 2, 1 at 150 % of all words."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.balanced_copies(docs).select("doc_id", "size", "source_size", "target", "taken", "copies")


@query
def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document: 3-word shingles, two bits."""
    out = simhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


# Fixed values of the contract: host, path, verdict.
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"),
             ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


@query
def op7_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of every page's url under the four rules."""
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter.judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"), rules) \
        .select("page_id", "host", "path", "rule", "verdict")


ORACLES["op7_url_rules"] = r"""
with r as (select page_id, case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest
           from pages),
u as (select page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                'abcdefghijklmnopqrstuvwxyz') as host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from r),
v as (select page_id, host, path, case
        when ('.' || host) like '%.example.net' and starts_with(path, '/en/') then 'example.net/en/'
        when ('.' || host) like '%.example.com' and starts_with(path, '/de/') then 'example.com/de/'
        when ('.' || host) like '%.org' and starts_with(path, '/fr/') then 'org/fr/'
        when ('.' || host) like '%.net' and starts_with(path, '/') then 'net/' end as rule from u)
select page_id, host, path, rule,
       case when rule in ('net/', 'example.com/de/') then 'block' else 'allow' end as verdict from v
"""


@query
def op9_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 1024 tokens."""
    pieces = packing.pack_pieces(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset")


@query
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document; learned from the labels that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.learn(docs, toxicity.training_labels(table(spark, sf_dir, "labels")))
    held = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    return toxicity.score(docs, model).select(
        "doc_id", held.alias("held_out"), "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


@query
def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: base spans and terms that reveal them."""
    found = pii.find_spans(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone",
                        F.sha2("base", 256).alias("base_sha256"), "spans")


@query
def op2_pivot_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five highest integer inner products of every 50th vector, against all vectors."""
    rows = clean_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), allow_zero=True)
    rows = rows.select("id", F.transform("v", lambda x: F.floor(x * 256.0).cast("long")).alias("v"))
    return pivot_search.top_k(rows, rows.where("id % 50 = 0"), 5)


@query
def op1_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twenty nearest found, by inner product, of every 20th vector."""
    rows = clean_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), allow_zero=False)
    return nn_descent.nearest(rows, F.col("id") % 20 == 0, 20)


@query
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of every document, and the numbers of those that repeat an earlier line at Jaccard 0.8 of 5-word shingles."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    gone = line_dedup.removed_lines(docs)
    n_lines = F.size(F.split(F.coalesce("text", F.lit("")), "\n")).cast("long")
    return docs.select("doc_id", n_lines.alias("n_lines"), *line_dedup.row_key(docs)).join(gone, ["id", "rk"], "left").select(
        "doc_id", "n_lines", F.coalesce(F.size("removed").cast("long"), F.lit(0).cast("long")).alias("n_removed"),
        F.coalesce(F.array_join(F.transform("removed", lambda x: x.cast("string")), ","), F.lit("")).alias("removed_lines"))


@query
def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the bytes of 100-byte strings that start earlier too."""
    out = suffix_dedup.without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector on the eight leading components, whitened, with the exact deviation and the shares explained."""
    out = whitening.whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), 8)
    return out.select(F.col("id").alias("vec_id"), "component", "n", F.expr("try_cast(deviation as long)").alias("deviation"),
                      "whitened", "explained", "identity_error")


@query
def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of all documents, written as coded files in order of doc_id and read back."""
    path = scratch_path(spark, "token-files")
    token_files.write_token_files(table(spark, sf_dir, "documents").select("doc_id", "text"), path)
    back = token_files.read_token_files(spark, path)
    return back.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op13_blocked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fifty best documents of every benchmark item by weighted terms."""
    found = blocked_search.top_documents(table(spark, sf_dir, "documents").select("doc_id", "text"),
                                         table(spark, sf_dir, "benchmark").select("item_id", "text"), 50)
    return found.select(F.col("id").alias("item_id"), "rank", "doc_id", "score")


ORACLES["op13_blocked_search"] = r"""
with d as (select doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as terms from documents),
c as (select cast(count(*) as bigint) as n_docs, cast(sum(len(terms)) as bigint) as n_terms from d where len(terms) > 0),
tf as (select doc_id, n, term, count(*) as tf
       from (select doc_id, cast(len(terms) as bigint) as n, unnest(terms) as term from d) group by doc_id, n, term),
df as (select term, cast(floor(1000 * ln(cast(2 * n_docs + 2 as double) / (2 * df + 1))) as bigint) as w
       from (select term, count(*) as df from tf group by term), c),
q as (select distinct item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from benchmark),
s as (select item_id, doc_id, cast(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_terms)))) as bigint) as score
      from q join tf using (term) join df using (term), c group by item_id, doc_id),
r as (select *, row_number() over (partition by item_id order by score desc, doc_id) as rank from s where score > 0)
select item_id, cast(rank as integer) as rank, doc_id, score from r where rank <= 50
"""
