"""Personal data: patterns, and terms that reveal them by corpus co-occurrence.

Base spans come from patterns (email, ip, card, phone). Their values are the
protected entities, and so are the classes of a value: its mail domain, network,
issuer or phone prefix, and its kind. The corpus then tells how strongly a term
reveals an entity whose texts it shares: with ``N`` documents, the entity in
``N(e)`` of them, the term in ``N(t)`` and both in ``N(t, e)``, the information
about the entity that is left once the term is known is

    IC(e) - PMI(t, e) = -log2(N(t, e) / N(t))  bits.

A term that leaves at most ``RESIDUAL_BITS``, and at most half of IC(e),
exceeds the disclosure threshold; wherever it stands in a text of the entity it
becomes a span of kind ``term``. Sanitising replaces base spans by their kind
and removes terms.

Counts are over all documents and whole texts. The term must share
``MIN_TEXTS`` distinct texts with the entity, or all of the entity's texts if
it has fewer: copies alone are no evidence for what recurs, and a value of one
text is revealed by the terms that single that text out.

Defined results: a null text is empty and has no spans; very long texts are
read whole; repeated rows get equal results; a failing match is dropped and
not tried again; an empty table gives an empty result; other columns are
ignored by ``find_spans`` and kept by ``sanitise``.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revenue_engine.llm.common import ascii_lower, stored

KINDS = ("email", "ip", "card", "phone")
TERM = "term"
MIN_TEXTS = 3       # distinct texts that must show the term with an entity that has so many
RESIDUAL_BITS = 1.0
MIN_LETTERS = 3
WORD = r"[^\x20\x09-\x0D.,;:!?()\[\]\"']+"

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A start inside a run of digits fails where the run's first digit fails, hence the look-behind.
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_WORD = re.compile(WORD)
_LOWER = {c: c + 32 for c in range(65, 91)}


def _emails(text: str) -> Iterator[tuple[int, int]]:
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            end = m.end()
            yield start, end
        at = text.find("@", max(end, at + 1))


def _is_ip(s: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in s.split("."))


def _is_card(s: str) -> bool:
    d = [ord(c) - 48 for c in s if "0" <= c <= "9"]
    if not 16 <= len(d) <= 19:
        return False
    doubled = (x * 2 - 9 if x > 4 else x * 2 for x in d[-2::-2])
    return (sum(d[-1::-2]) + sum(doubled)) % 10 == 0


def _is_phone(s: str) -> bool:
    return 8 <= sum("0" <= c <= "9" for c in s) <= 15


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(index in KINDS, start, end), ordered; code points, end exclusive."""
    out = [(0, s, e) for s, e in _emails(text)]
    for kind, pattern, valid in ((1, _IP, _is_ip), (2, _CARD, _is_card), (3, _PHONE, _is_phone)):
        out += [(kind, m.start(), m.end()) for m in pattern.finditer(text) if valid(m[0])]
    return out


def entities(kind: int, value: str) -> list[str]:
    """The protected value and the classes it belongs to."""
    digits = "".join(c for c in value if "0" <= c <= "9")
    group = (value.rpartition("@")[2].translate(_LOWER), value.rpartition(".")[0], digits[:6], digits[:4])[kind]
    name = KINDS[kind]
    return [f"{name}:{value}", f"{name} of:{group}", name]


def _free_words(text: str, spans: list) -> list[dict]:
    """The distinct words outside all base spans, each with its places."""
    taken = sorted((s, e) for _, s, e in spans)
    reach = list(accumulate((e for _, e in taken), max))
    places: dict[str, list] = {}
    for m in _WORD.finditer(text):
        a, b = m.span()
        before = bisect_left(taken, (b, -1))  # spans that start before the word's end
        if b - a >= MIN_LETTERS and not (before and reach[before - 1] > a):
            places.setdefault(m[0].translate(_LOWER), []).append({"s": a, "e": b})
    return [{"t": t, "at": at} for t, at in places.items()]


_BASE_SCHEMA = ("rid long, doc_id long, tkey string, n_email long, n_ip long, n_card long, n_phone long, base string, "
                "ents array<string>, words array<struct<t: string, at: array<struct<s: long, e: long>>>>")


def base_table(docs: DataFrame) -> DataFrame:
    """Stored table: base spans of each row, and of rows that have some the entities and all other words."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rid = TaskContext.get().partitionId() << 33
        for b in batches:
            rows = []
            for doc_id, text, key in zip(b["doc_id"], b["text"], b["tkey"]):
                rid += 1
                spans = base_spans(text or "")
                n = [sum(k == i for k, _, _ in spans) for i in range(len(KINDS))]
                ents = sorted({x for k, s, e in spans for x in entities(k, text[s:e])})
                rows.append((rid, doc_id, key, *n, ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in spans),
                             ents, _free_words(text, spans) if spans else []))
            yield pd.DataFrame(rows, columns=["rid", "doc_id", "tkey", *(f"n_{k}" for k in KINDS), "base", "ents", "words"]) \
                .astype({"doc_id": "Int64"})

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return stored(docs.select(F.col("doc_id").cast("long"), text.alias("text"), F.sha2(text, 256).alias("tkey"))
                  .mapInPandas(run, _BASE_SCHEMA), "pii-base")


def disclosing_terms(docs: DataFrame, base: DataFrame, min_texts: int = MIN_TEXTS,
                     residual_bits: float = RESIDUAL_BITS) -> DataFrame:
    """(tkey, t): of every text with entities the terms that disclose one of them."""
    total = base.count()
    marked = base.where(F.size("ents") > 0)
    # Of the rows of one text, ``n`` in number, one stands for all.
    copies = marked.groupBy("tkey").agg(F.min("rid").alias("rid"), F.count(F.lit(1)).alias("n"))
    texts = stored(marked.select("rid", "ents", "words").join(copies, "rid"), "pii-texts")
    held = texts.select("tkey", "n", F.explode("ents").alias("e"))
    facts = held.groupBy("e").agg(F.sum("n").alias("n_ent"), F.count(F.lit(1)).alias("texts"))
    # At most half of IC(e) may be left, which matters for an entity in more than a quarter of the documents.
    information = F.log2(F.lit(float(total)) / F.col("n_ent"))
    facts = facts.withColumn("most", F.least(F.lit(float(residual_bits)), information / 2)).where(information > 0)
    held = stored(held.join(facts, "e"), "pii-held")
    words = texts.select("tkey", "n", F.explode("words.t").alias("t"))
    # Documents with the term and any entity: a lower bound of N(t), which spares common words the count.
    least = stored(words.groupBy("t").agg(F.sum("n").alias("n_near")), "pii-near")

    def close(both, all_):
        return -F.log2(F.least(both / all_, F.lit(1.0))) <= F.col("most") + 1e-9

    # All entities that stand in one text only have the same terms: the text stands for them.
    alone = held.where("texts = 1").groupBy("tkey").agg(F.max("most").alias("most"))
    alone = (words.join(alone, "tkey").join(least, "t").where(close(F.col("n"), F.col("n_near")))
             .select("tkey", F.lit(None).cast("string").alias("e"), "t", F.col("n").alias("n_both"), "most"))
    shared = (texts.join(held.where("texts > 1").groupBy("tkey").agg(F.collect_list(F.struct("e", "texts", "most")).alias("es")), "tkey")
              .select("n", "es", F.explode("words.t").alias("t")).select("n", "t", F.explode("es").alias("x"))
              .select("n", "t", "x.*").groupBy("e", "t", "texts", "most")
              .agg(F.sum("n").alias("n_both"), F.count(F.lit(1)).alias("seen"))
              .where(F.col("seen") >= F.least(F.lit(min_texts), F.col("texts"))).join(least, "t")
              .where(close(F.col("n_both"), F.col("n_near")))
              .select(F.lit(None).cast("string").alias("tkey"), "e", "t", "n_both", "most"))
    joint = stored(alone.unionByName(shared), "pii-joint")
    every = F.array_distinct(F.regexp_extract_all(ascii_lower(F.col("text").cast("string")), F.lit(WORD), F.lit(0)))
    # Counted before the join, so that only each task's distinct words are shuffled.
    seen = docs.select(F.explode(every).alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("n_term"))
    seen = seen.join(joint.select("t").distinct(), "t", "left_semi")
    told = stored(joint.join(seen, "t").where(close(F.col("n_both"), F.col("n_term"))).select("tkey", "e", "t"), "pii-told")
    where = (texts.select("tkey", "ents", F.explode("words.t").alias("t"))
             .join(told.where("e is not null").select("t").distinct(), "t", "left_semi")
             .select("tkey", "t", F.explode("ents").alias("e")))
    return (where.join(told.where("e is not null").select("e", "t"), ["e", "t"]).select("tkey", "t")
            .unionByName(told.where("e is null").select("tkey", "t")).distinct())


def find_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, tkey, n_email, n_ip, n_card, n_phone, base, spans) for every row; ``tkey`` is the text's SHA-256."""
    base = base_table(docs)
    told = disclosing_terms(docs, base)
    spots = (base.where(F.size("ents") > 0).select("rid", "tkey", F.explode("words").alias("w"))
             .select("rid", "tkey", F.col("w.t").alias("t"), F.col("w.at").alias("at"))
             .join(told, ["tkey", "t"]).select("rid", F.explode("at").alias("x")).select("rid", "x.s", F.col("x.e").alias("end")))
    # The spots of one text are fewer than its words, so their list fits a row.
    extra = (spots.groupBy("rid").agg(F.array_sort(F.collect_list(F.struct("s", "end"))).alias("spots"))
             .select("rid", F.array_join(F.transform("spots", lambda x: F.concat_ws(
                 ":", F.lit(TERM), x["s"].cast("string"), x["end"].cast("string"))), ",").alias("terms")))
    spans = F.when(F.col("terms").isNull(), F.col("base")).when(F.col("base") == "", F.col("terms")) \
        .otherwise(F.concat_ws(",", "base", "terms"))
    return base.drop("ents", "words").join(extra, "rid", "left").withColumn("spans", spans).drop("terms", "rid")


def sanitised_text(text: str | None, spans: str) -> str:
    """``text`` with base spans replaced by their kind in brackets, and terms removed."""
    out, at, text = [], 0, text or ""
    parsed = sorted((int(s), int(e), k) for k, s, e in (x.split(":") for x in spans.split(",") if x))
    for s, e, kind in parsed:
        if s < at:
            continue  # overlaps the span before it
        out += [text[at:s], "" if kind == TERM else f"[{kind.upper()}]"]
        at = e
    return "".join([*out, text[at:]])


def sanitise(docs: DataFrame) -> DataFrame:
    """``docs`` with the spans of every text replaced or removed."""
    keyed = docs.withColumn("_tkey", F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")), 256))
    spans = find_spans(docs).groupBy("tkey").agg(F.first("spans").alias("_spans"))

    @F.pandas_udf("string")
    def clean(text: pd.Series, found: pd.Series) -> pd.Series:
        return pd.Series([sanitised_text(t, s) for t, s in zip(text, found)], dtype=object)

    joined = keyed.join(spans, F.col("_tkey") == F.col("tkey"))
    return joined.select(*[clean(F.col("text"), F.col("_spans")).alias(c) if c == "text" else F.col(f"`{c}`")
                           for c in docs.columns])


def digest(spans: str) -> str:
    return hashlib.sha256(spans.encode()).hexdigest()
