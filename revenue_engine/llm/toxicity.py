"""Toxicity: a learned lexicon in a trie, met by Levenshtein automata, weighed by context.

The lexicon is learned from labelled rows: words, and stems that many
different words begin with, which toxic documents hold far more often than
clean ones. It is stored as a trie. Every token of a text runs through the
intersection of its edit-distance-one automaton with that trie, so misspelled
terms are caught at one edit; spellings that clean documents use are learned as
exceptions (``oron`` is not a misspelled ``moron``). Each hit is weighed by the
window of tokens around it: inside quotation marks or after a word of
reporting it counts as quotation, else as abuse. A document's strongest
weight for each term feeds a logistic model.

The model is fitted on at most ``SAMPLE_ROWS`` labelled rows, taken by a hash
of the id, and holds at most ``LEXICON_TERMS`` terms; both are parameters and
bound what is sent to the executors. Scoring covers every row and the whole
text.

Defined results: a null or empty text has no hits and gets the base score;
rows that repeat get equal scores; labels that are null, or name no document,
are not used, of several labels of an id the largest holds; with no labels of
both classes every score is 0; empty tables give empty results; other columns
pass through.
"""

from __future__ import annotations

import json
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revenue_engine.llm.common import drop_stored, stored

SAMPLE_ROWS = 40_000
LEXICON_TERMS = 400
THRESHOLD = 0.3
STEM_LENGTHS = (3, 4, 5, 6)
MIN_SHARE = 0.005  # of the toxic rows that must hold a term
MIN_LOG_ODDS = 2.0
LEAST_WEIGHT = 0.15  # of the largest weight; terms below it leave the lexicon
FUZZY_LENGTH = 5  # shorter terms are matched exactly
FUZZY_STRENGTH = 0.7
QUOTED_STRENGTH = 0.4
WINDOW = 5
MEMO = 200_000

TOKEN = re.compile(r"[^\W_]+(?:['@$!*][^\W_]+)*|[\"“”„«»‹›]")
OPENING, CLOSING = set("\"“„«‹"), set("\"”“»›")
REPORTING = {"said", "says", "quote", "quoted", "quoting", "word", "words", "called", "term", "reported", "wrote",
             "sagte", "zitat", "wort", "schrieb", "dit", "mot", "citation", "dijo", "palabra", "cita"}


class Lexicon:
    """A trie of words and stems with tolerant lookup."""

    def __init__(self, words: list[str], stems: list[str]):
        self.terms = [("w", w) for w in words] + [("s", s) for s in stems]
        self.root: dict = {}
        for i, (kind, term) in enumerate(self.terms):
            node = self.root
            for ch in term:
                node = node.setdefault(ch, {})
            node[kind * 2] = i  # two-character keys cannot meet a letter

    def exact(self, token: str) -> int | None:
        node, stem = self.root, None
        for ch in token:
            node = node.get(ch)
            if node is None:
                return stem
            stem = node.get("ss", stem)
        return node.get("ww", stem)

    def tolerant(self, token: str) -> int | None:
        """A word one edit away. States of the automaton are (position, edits used) along trie nodes."""
        if len(token) < FUZZY_LENGTH - 1:
            return None
        node, n = self.root, len(token)
        for i in range(n + 1):  # position i reached without an edit
            ch = token[i] if i < n else "ww"
            after = token[i + 1] if i + 1 < n else "ww"
            if i < n and (hit := self._rest(node, token, i + 1)) is not None:
                return hit  # one more letter in the token
            for c, child in node.items():
                if len(c) > 1:
                    continue
                if ch in child and (hit := self._rest(child, token, i)) is not None:
                    return hit  # one letter missing in the token
                if i < n and c != ch and after in child and (hit := self._rest(child, token, i + 1)) is not None:
                    return hit  # one letter replaced
            node = node.get(ch) if i < n else None
            if node is None:
                return None
        return None

    def _rest(self, node: dict, token: str, at: int) -> int | None:
        for ch in token[at:]:
            node = node.get(ch)
            if node is None:
                return None
        i = node.get("ww")
        return i if i is not None and len(self.terms[i][1]) >= FUZZY_LENGTH else None


def tokens(text: str | None) -> list[str]:
    return TOKEN.findall((text or "").lower())


def context_strength(toks: list[str], at: int) -> float:
    """1 for abuse, ``QUOTED_STRENGTH`` for a hit in quotation marks or after a word of reporting."""
    before = toks[max(0, at - WINDOW):at]
    after = toks[at + 1:at + 1 + WINDOW]
    marks = sum(t in OPENING for t in before)
    if marks and any(t in CLOSING for t in after):
        return QUOTED_STRENGTH
    return QUOTED_STRENGTH if any(t in REPORTING for t in before) else 1.0


class Matcher:
    """Hits of a text: {term: strongest weight}; remembers tokens it has seen."""

    def __init__(self, lexicon: Lexicon, exceptions: set[str] | None):
        self.lexicon, self.exceptions, self.memo = lexicon, exceptions, {}

    def token(self, tok: str) -> tuple[int, float] | None:
        if (i := self.lexicon.exact(tok)) is not None:
            return i, 1.0
        if self.exceptions is not None and tok not in self.exceptions and (i := self.lexicon.tolerant(tok)) is not None:
            return i, FUZZY_STRENGTH
        return None

    def hits(self, text: str | None) -> dict[int, float]:
        toks, memo, out = tokens(text), self.memo, {}
        for at, tok in enumerate(toks):
            try:
                hit = memo[tok]
            except KeyError:
                if len(memo) >= MEMO:
                    memo.clear()
                hit = memo[tok] = self.token(tok)
            if hit is not None:
                i, w = hit
                out[i] = max(out.get(i, 0.0), w * context_strength(toks, at))
        return out


def _candidates(text: str | None) -> set[str]:
    out = set()
    for w in set(tokens(text)):
        out.add("w" + w)
        out.update("s" + w[:k] for k in STEM_LENGTHS if len(w) > k)
    return out


def _counted(df: DataFrame, of) -> DataFrame:
    """Sum of ``of(text)`` counters over the rows: (term, n); tasks send sums, not rows."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            c: Counter = Counter()
            for t in b["text"]:
                c.update(of(t))
            if c:
                yield pd.DataFrame({"term": list(c.keys()), "n": list(c.values())})

    return df.select("text").mapInPandas(run, "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))


def learn(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> dict | None:
    """The fitted model as plain values, or None where a class has no row. ``labels``: (doc_id, toxic)."""
    sample = (labels.where("toxic is not null and doc_id is not null").groupBy("doc_id")
              .agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows))
    sample = stored(sample, "toxic-sample")
    # At most ``sample_rows`` rows are broadcast; texts are not shuffled. A text counts once, toxic if any of its labels is.
    rows = stored(docs.select("doc_id", F.col("text").cast("string")).join(F.broadcast(sample), "doc_id")
                  .groupBy(F.sha2("text", 256).alias("key")).agg(F.first("text").alias("text"), F.max("toxic").alias("toxic"))
                  .select("text", "toxic")
                  .repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))), "toxic-rows")
    by = {r["toxic"] > 0: r["n"] for r in rows.groupBy(F.col("toxic").alias("toxic"))
          .agg(F.count(F.lit(1)).alias("n")).collect()}
    n_toxic, n_clean = by.get(True, 0), by.get(False, 0)
    if not n_toxic or not n_clean:
        return None
    bad, good = rows.where("toxic > 0"), rows.where("toxic <= 0")
    least = max(2, math.ceil(MIN_SHARE * n_toxic))
    # Terms in at least a fixed share of the toxic rows: their number does not grow with the corpus.
    toxic = {r["term"]: r["n"] for r in _counted(bad, _candidates).where(F.col("n") >= least).collect()}
    clean = {r["term"]: r["n"] for r in _counted(good, lambda t: _candidates(t) & toxic.keys()).collect()}
    terms = _select(toxic, clean, n_toxic, n_clean)
    # A first fit on exact hits tells terms that carry the label from words that only stand beside them.
    y, hits = _features(rows, *terms, None)
    weights, _ = _fit(y, hits, len(terms[0]) + len(terms[1]))
    strong = [i for i, w in enumerate(weights) if w > 0 and w >= LEAST_WEIGHT * weights.max()]
    words = [terms[0][i] for i in strong if i < len(terms[0])]
    stems = [terms[1][i - len(terms[0])] for i in strong if i >= len(terms[0])]
    lexicon = Lexicon(words, stems)

    def fuzzy(text):
        return {t for t in set(tokens(text)) if lexicon.exact(t) is None and lexicon.tolerant(t) is not None}

    # Within one edit of a bounded lexicon there are boundedly many spellings.
    used = {r["term"] for r in _counted(good, fuzzy).collect()}
    y, hits = _features(rows, words, stems, used)
    drop_stored(sample)
    drop_stored(rows)
    weights, bias = _fit(y, hits, len(lexicon.terms))
    return {"words": words, "stems": stems, "exceptions": sorted(used), "weights": weights.tolist(), "bias": bias}


def _features(rows: DataFrame, words: list, stems: list, exceptions: set | None) -> tuple[np.ndarray, list]:
    """Label and hits of every sampled row; exact hits only where ``exceptions`` is None."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = Matcher(Lexicon(words, stems), exceptions)
        for b in batches:
            yield pd.DataFrame({"y": (b["toxic"] > 0).astype("int32"),
                                "x": [json.dumps(list(m.hits(t).items())) for t in b["text"]]})

    got = rows.mapInPandas(run, "y int, x string").toPandas()
    return got["y"].to_numpy(), [json.loads(x) for x in got["x"]]


def _select(toxic: dict, clean: dict, n_toxic: int, n_clean: int) -> tuple[list[str], list[str]]:
    """Words and stems of the lexicon: strong log odds, and neither a word beside its stem nor a stem of one word."""
    odds = {}
    for term, n in toxic.items():
        o = math.log((n + 0.5) / (n_toxic + 1)) - math.log((clean.get(term, 0) + 0.5) / (n_clean + 1))
        if o >= MIN_LOG_ODDS:
            odds[term] = o
    best_child: dict[str, int] = {}
    for term in odds:
        if term[0] == "w":
            for k in STEM_LENGTHS:
                s = "s" + term[1:1 + k]
                best_child[s] = max(best_child.get(s, 0), toxic[term])
    stems = {t for t in odds if t[0] == "s" and best_child.get(t, 0) < 0.7 * toxic[t]}
    keep = []
    for t in odds:
        if t[0] == "s" and t not in stems:
            continue
        parents = ("s" + t[1:1 + k] for k in STEM_LENGTHS if k < len(t) - 1)
        if not any(p in stems and odds[p] >= odds[t] - 1.0 for p in parents):
            keep.append(t)
    keep.sort(key=lambda t: (-toxic[t] * odds[t], t))
    keep = keep[:LEXICON_TERMS]
    return sorted(t[1:] for t in keep if t[0] == "w"), sorted(t[1:] for t in keep if t[0] == "s")


def _fit(y: np.ndarray, rows: list, n_terms: int, penalty: float = 0.05, steps: int = 30) -> tuple[np.ndarray, float]:
    """Logistic regression by Newton steps with a quadratic penalty on the weights."""
    x = np.zeros((len(y), n_terms + 1), np.float32)
    x[:, -1] = 1.0
    for i, hits in enumerate(rows):
        for t, v in hits:
            x[i, t] = v
    w = np.zeros(n_terms + 1)
    ridge = np.full(n_terms + 1, penalty)
    ridge[-1] = 1e-4
    for _ in range(steps):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) + ridge * w
        s = (p * (1 - p)).astype(np.float32)
        step = np.linalg.solve((x * s[:, None]).T @ x + np.diag(ridge + 1e-6), grad)
        size = float(np.abs(step).max())
        w -= step * min(1.0, 5.0 / max(size, 1e-12))
        if size < 1e-4:
            break
    return w[:-1], float(w[-1])


def score(docs: DataFrame, model: dict | None, text: str = "text") -> DataFrame:
    """``docs`` with the column score."""
    if model is None:
        return docs.withColumn("score", F.lit(0.0))

    @F.pandas_udf("double")
    def scored(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = Matcher(Lexicon(model["words"], model["stems"]), set(model["exceptions"]))
        w, b = model["weights"], model["bias"]
        for batch in texts:
            yield pd.Series([1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, b + sum(w[i] * v for i, v in m.hits(t).items())))))
                             for t in batch], dtype="float64")

    return docs.withColumn("score", scored(F.col(f"`{text}`").cast("string")))


def training_labels(labels: DataFrame) -> DataFrame:
    """Labels of rows whose crc32 of the id's text, modulo 4, is not 2."""
    return labels.where(F.crc32(F.col("doc_id").cast("string")) % 4 != 2).select("doc_id", "toxic")
