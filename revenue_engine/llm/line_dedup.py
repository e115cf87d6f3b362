"""Line dedup: an exact set-similarity join over lines, with prefix filtering.

A line's tokens are its five-word shingles, as hashes. Two lines match at a
Jaccard similarity of ``SIMILARITY`` or more. Similar lines share a token of
their prefixes under any one order of the tokens, which is used twice:

1. Ordered by hash, a prefix is the first fifth of a line's tokens and the
   ``SHARED - 1`` after them, of which similar lines share ``SHARED``, or all
   they must share if that is less. A line without as many that stand in other
   prefixes matches nothing and leaves; a token of two lines counts for neither
   if their sizes are not close. Most lines leave, for a fifth of the tokens
   shuffled.
2. Among the lines left, tokens are ordered by rarity: their exact count, ties
   by hash. Tokens of one line alone come first and are only counted, so
   frequent passages leave the prefixes. Lines that share a prefix token must
   have close sizes (length filter), enough tokens left after the shared one
   (positional filter), and the shared token in the shorter prefix that
   suffices for the smaller of the two. What passes is verified on the whole
   sets.

A line is removed if an earlier line of the input matches it; earlier is the
smaller (doc_id, text hash, line number). Document and text hash key a row, so
different texts of one id, or of none, stay apart.

Equal lines are one class with its first place, so copies never meet in pairs.
Each class is compared with the earliest holder of each of its prefix tokens
first; only classes this leaves unmatched meet every earlier holder.

A line of one to four words has its whole word sequence as its one token: equal
ones are one class, whose first place stays, and it matches nothing else.

Whole token sets are made, from a second reading of the texts, for one line
of each class that can match alone. Native expressions only. Defined results: a
line without words is never removed; A-Z are lower-cased for the comparison
only; null texts stay null and have no lines; rows that repeat an id and its
text share its removals; null ids come last in order; an empty table gives an
empty one; ``n_chars`` follows the text, other columns pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revenue_engine.llm.common import drop_stored, stored

WORDS = 5
SIMILARITY = 0.8
SHARED = 3
LAST = (1 << 63) - 1
SPACES = " \t\x0b\x0c\r"


def row_key(docs: DataFrame) -> tuple[Column, Column]:
    """``id`` and ``rk``, the key of a row: doc_id, last if null, which gives the order, and a hash of the text."""
    return (F.coalesce(docs["doc_id"].cast("long"), F.lit(LAST)).alias("id"),
            F.xxhash64(docs["text"].cast("string")).alias("rk"))


def _lines(docs: DataFrame, places: DataFrame | None = None) -> DataFrame:
    """(id, rk, line, raw) of every line with words: its folded words, one space between them.

    With ``places`` (id, rk, numbers: array<int>) of these lines alone.

    The comparison works on the UTF-8 bytes read as Latin-1 and lower-cased: A-Z change,
    and other characters stay different from each other, as the number of continuation
    bytes tells a shifted lead byte from the one it equals.
    """
    # Keyed before the split: beside a generator the text would be hashed again for every line.
    texts = docs.select(*row_key(docs), F.col("text").cast("string").alias("text"))
    if places is not None:
        texts = texts.join(places, ["id", "rk"])
    low = F.lower(F.decode(F.col("text").cast("binary"), "ISO-8859-1"))
    lines = texts.select(*[c for c in texts.columns if c != "text"], F.posexplode_outer(F.split(low, "\n")).alias("line", "raw"))
    if places is not None:
        lines = lines.where(F.array_contains("numbers", F.col("line")))
    raw = F.col("raw")
    # Most lines hold single spaces alone, and finding that out is cheaper than replacing them.
    odd = raw.contains("  ")
    for space in SPACES[1:]:
        odd = odd | raw.contains(space)
    folded = F.when(odd, F.regexp_replace(raw, f"[{SPACES}]+", " ")).otherwise(raw)
    return lines.where(raw.rlike(f"[^{SPACES}]")).select("id", "rk", "line", F.trim(folded).alias("raw"))


def _keys():
    """Two hashes that name a line's words, as two columns."""
    return F.xxhash64("raw").alias("k1"), F.xxhash64(F.lit(7), F.col("raw")).alias("k2")


def _once(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, wherever it stands in it."""
    return F.get(F.transform(F.array(value), use), 0)


def _tokens(raw: Column) -> Column:
    """The distinct shingles of a line in order of their hashes, none for lines of fewer than ``WORDS`` words."""
    def shingles(h):
        starts = F.slice(h, F.lit(1), F.greatest(F.size(h) - (WORDS - 1), F.lit(0)))
        return F.transform(starts, lambda x, i: F.xxhash64(x, *[F.get(h, i + k) for k in range(1, WORDS)]))

    # A hash is never null, so that arrays of plain longs are sorted.
    hashes = F.transform(F.split(raw, " "), lambda w: F.xxhash64(w))
    return F.sort_array(F.array_distinct(_once(hashes, shingles)))


def _prefix(size: Column, overlap: float) -> Column:
    """Length of the prefix of which a set of ``size`` must share a token, if it shares ``overlap`` of its size."""
    return (size - F.ceil(size * F.lit(overlap) - 1e-9) + 1).cast("int")


def _must_share(size: Column, similarity: float) -> Column:
    """Number of tokens, ``SHARED`` at most, that a set of ``size`` must share within the first prefixes."""
    return F.least(F.lit(SHARED), F.ceil(size * F.lit(similarity) - 1e-9)).cast("int")


def _near(prefixes: DataFrame, similarity: float) -> DataFrame:
    """Stored (k1): classes with as many prefix tokens, by hash, in other classes' prefixes as a match takes."""
    posts = prefixes.select("k1", "size", F.explode("prefix").alias("token"))
    # The smallest and the largest holder tell whether there are two, and combine before the shuffle. Of two postings
    # the sizes are known; copies of a line count as more.
    shared = (posts.groupBy("token").agg(F.min("k1").alias("a"), F.max("k1").alias("b"), F.count(F.lit(1)).alias("n"),
                                         F.min("size").alias("lo"), F.max("size").alias("hi"))
              .where((F.col("a") != F.col("b")) & ((F.col("n") > 2) | (F.col("lo") >= F.col("hi") * F.lit(similarity) - 1e-9)))
              .select("token"))
    # Written first, so that the shuffle of all holders is gone when all postings are shuffled.
    shared = stored(shared, "line-shared")
    # So do the smallest and the largest token: copies of a line bring each of its tokens several times.
    held = (posts.join(shared.hint("shuffle_hash"), "token", "left_semi").groupBy("k1")
            .agg(F.min("token").alias("a"), F.max("token").alias("b"), F.count(F.lit(1)).alias("n"), F.min("size").alias("size")))
    need = _must_share(F.col("size"), similarity)
    out = stored(held.where((F.col("n") >= need) & ((need < 2) | (F.col("a") != F.col("b")))).select("k1"), "line-near")
    drop_stored(shared)
    return out


def _matchable(docs: DataFrame, keys: DataFrame, prefixes: DataFrame, similarity: float) -> DataFrame:
    """Stored (node, k1, k2, place, size, tokens): classes that the first prefixes leave.

    ``prefixes`` is dropped on the way.
    """
    near = _near(prefixes, similarity)
    drop_stored(prefixes)
    places = (keys.join(near, "k1", "left_semi").groupBy("k1", "k2").agg(F.min(F.struct("id", "rk", "line")).alias("p"))
              .groupBy("p.id", "p.rk").agg(F.collect_list("p.line").alias("numbers")))
    # Rows that repeat an id and its text bring a line several times.
    classes = (_lines(docs, places).select(*_keys(), "id", "rk", "line", "raw").groupBy("k1", "k2")
               .agg(F.min(F.struct("id", "rk", "line", "raw")).alias("m"))
               .select("k1", "k2", F.struct("m.id", "m.rk", "m.line").alias("place"), _tokens(F.col("m.raw")).alias("tokens")))
    out = stored(classes.select(F.monotonically_increasing_id().alias("node"), "k1", "k2", "place",
                                F.size("tokens").alias("size"), "tokens"), "line-matchable")
    drop_stored(near)
    return out


def _postings(nodes: DataFrame, similarity: float) -> DataFrame:
    """Stored (node, place, size, token, pos, short): prefix tokens by rarity that several classes hold.

    ``short`` marks the shorter prefix, in which the smaller set of a pair, or either of equal sizes, holds the token.
    """
    posts = nodes.select("node", F.explode("tokens").alias("token"))
    # Written first, so that the shuffle of all counts is gone when all postings are shuffled.
    counts = stored(posts.groupBy("token").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "line-counts")
    ranked = posts.join(counts.hint("shuffle_hash"), "token").groupBy("node").agg(F.sort_array(F.collect_list(F.struct("n", "token"))).alias("held"))
    # Tokens of one class come first in its order; only their number matters.
    alone = F.col("size") - F.size("held")
    left = F.greatest(_prefix(F.col("size"), similarity) - alone, F.lit(0))
    short = _prefix(F.col("size"), 2 * similarity / (1 + similarity))
    out = stored(nodes.select("node", "place", "size").join(ranked, "node")
                 .select("node", "place", "size", alone.alias("alone"), short.alias("short"), F.posexplode(F.slice("held", F.lit(1), left)).alias("at", "t"))
                 .select("node", "place", "size", F.col("t.token").alias("token"), (F.col("alone") + F.col("at")).alias("pos"),
                         (F.col("alone") + F.col("at") < F.col("short")).alias("short")), "line-postings")
    drop_stored(counts)
    return out


def candidate_pairs(posts: DataFrame, others: DataFrame, similarity: float) -> DataFrame:
    """(x, y) of ``posts`` as y and earlier ``others`` as x that share a token and pass the filters; pairs may repeat."""
    x = others.select("token", *[F.col(c).alias(f"x{c}") for c in ("node", "place", "size", "pos", "short")])

    def passing(y, x, fits):
        both = F.col("size") + F.col("xsize")
        need = F.ceil(both * F.lit(similarity / (1 + similarity)) - 1e-9)
        left = F.least(F.col("size") - F.col("pos"), F.col("xsize") - F.col("xpos"))
        close = F.least("size", "xsize") >= F.greatest("size", "xsize") * F.lit(similarity) - 1e-9
        return (y.join(x, "token").where((F.col("xplace") < F.col("place")) & fits & close & (left >= need))
                .select(F.col("xnode").alias("x"), F.col("node").alias("y")))

    # One side of every join is the short prefixes, which hold next to no frequent token of unlike lines.
    return (passing(posts, x.where("xshort"), F.col("xsize") <= F.col("size"))
            .unionByName(passing(posts.where("short"), x, F.col("xsize") > F.col("size"))))


def _verified(nodes: DataFrame, pairs: DataFrame, similarity: float) -> DataFrame:
    """Distinct ``y`` of the pairs whose whole token sets are similar enough."""
    a = nodes.select(F.col("node").alias("x"), F.col("tokens").alias("xt"))
    b = nodes.select(F.col("node").alias("y"), F.col("tokens").alias("yt"))
    common = F.size(F.array_intersect("xt", "yt"))
    return (pairs.join(a, "x").join(b, "y")
            .where(common >= (F.size("xt") + F.size("yt") - common) * F.lit(similarity) - 1e-9).select("y").distinct())


def _matched(nodes: DataFrame, similarity: float) -> DataFrame:
    """Stored (node): classes whose first place an earlier class matches."""
    posts = _postings(nodes, similarity)
    heads = (posts.groupBy("token").agg(F.min(F.struct("place", "node", "size", "pos", "short")).alias("h"), F.count(F.lit(1)).alias("n"))
             .where("n > 1").select("token", "h.*"))
    first = stored(candidate_pairs(posts, heads, similarity).distinct(), "line-first")
    gone = stored(_verified(nodes, first, similarity).withColumnRenamed("y", "node"), "line-gone")
    rest = posts.join(gone, "node", "left_anti")
    # x stands before y and holds a shared token, but is not its earliest holder: those were compared.
    second = candidate_pairs(rest, posts, similarity).distinct().join(first, ["x", "y"], "left_anti")
    second = stored(second, "line-second")
    out = stored(gone.unionByName(_verified(nodes, second, similarity).withColumnRenamed("y", "node")), "line-matched")
    for t in (posts, first, gone, second):
        drop_stored(t)
    return out


def removed_lines(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Stored (id, rk, removed: array<int>): removed line numbers of each row key that loses lines."""
    size = F.col("size")
    prefixes = stored(_lines(docs).select("id", "rk", "line", *_keys(), _tokens(F.col("raw")).alias("tokens"))
                      .select("id", "rk", "line", "k1", "k2", F.size("tokens").alias("size"), "tokens")
                      .select("id", "rk", "line", "k1", "k2", "size",
                              F.slice("tokens", F.lit(1), _prefix(size, similarity) - 1 + _must_share(size, similarity)).alias("prefix")),
                      "line-prefixes")
    keys = stored(prefixes.select("id", "rk", "line", "k1", "k2"), "line-keys")
    nodes = _matchable(docs, keys, prefixes, similarity)
    matched = _matched(nodes, similarity)
    gone = nodes.join(matched, "node", "left_semi").select("k1", "k2", F.lit(True).alias("gone"))
    # Of a class only its first place can stay, unless an earlier class matched it. The one token of a line of few
    # words is its key, so its class is whole here and needs no pairs.
    fates = (keys.groupBy("k1", "k2").agg(F.min(F.struct("id", "rk", "line")).alias("place"), F.count(F.lit(1)).alias("n"))
             .join(gone, ["k1", "k2"], "left").where("n > 1 or gone")
             .select("k1", "k2", F.when(F.col("gone").isNull(), F.col("place")).alias("place")))
    out = (keys.join(fates, ["k1", "k2"]).where(F.col("place").isNull() | (F.struct("id", "rk", "line") != F.col("place")))
           .groupBy("id", "rk").agg(F.array_sort(F.collect_set("line")).alias("removed")))
    out = stored(out, "line-removed")
    for t in (keys, nodes, matched):
        drop_stored(t)
    return out


def without_repeated_lines(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` with the removed lines cut from ``text``; all rows and columns stay."""
    gone = removed_lines(docs, similarity).select(F.col("id").alias("_gone_id"), F.col("rk").alias("_gone_rk"), "removed")
    cols = [F.col(f"`{c}`") for c in docs.columns]
    id_, rk = row_key(docs)
    rows = docs.select(F.struct(*cols).alias("_row"), id_.alias("_id"), rk.alias("_rk"))
    joined = rows.join(gone, (F.col("_id") == F.col("_gone_id")) & (F.col("_rk") == F.col("_gone_rk")), "left")
    kept = F.array_join(F.filter(F.split(F.col("_row.text"), "\n"),
                                 lambda x, i: ~F.array_contains(F.col("removed"), i)), "\n")
    text = F.when(F.col("removed").isNull(), F.col("_row.text")).otherwise(kept)
    fields = [F.col(f"_row.`{c}`") for c in docs.columns]
    out = [text.alias(c) if c == "text" else f.alias(c) for c, f in zip(docs.columns, fields)]
    if "n_chars" in docs.columns:
        out[docs.columns.index("n_chars")] = F.when(F.col("removed").isNull(), F.col("_row.n_chars")) \
            .otherwise(F.length(kept)).alias("n_chars")
    return joined.select(*out)
