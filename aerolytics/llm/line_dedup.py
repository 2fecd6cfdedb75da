"""Near-duplicate lines across all documents by an exact set-similarity join.

A line is the set of its lower-cased words. Equal sets are one class. Between classes the
join is a prefix filter: words are ordered by rarity, and two sets of ``n`` and more words that
match share one word among the first ``n - ceil(t * n) + 1`` of both, and two among one more.
If the first word they share is rare, they meet in its list. If not, the second is frequent
too, and they meet in the list of both words together: frequent words have no lists of their
own, so lists do not grow with the square of the input. The smaller of two sets has fewer
words to spare, so only its first ones look others up. Candidates pass the length filter and
a bound on the words that differ (128 bits, each the parity of the words that fall on it: two
sets differ in at least as many words as bits), and are verified on the whole sets. A line
goes if an earlier line (smaller doc_id, then earlier in the document) matches it.

Rarity comes from word counts over all lines, kept in a fixed number of hash buckets: the
levels of the buckets do not grow with the data, every fixed order is exact, and frequent
words still come last. Lists of two words longer than ``LONG`` are first compared with one
leader; only members without an earlier match are compared further, so a large group of
near copies is not spelled out pair by pair. Only DataFrame functions are used.
"""

from __future__ import annotations

import functools
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerolytics.llm.common import BLANKS, discard, may_occur, released, scratch, sieve

PERCENT = 80
RARITY_BITS = 20                 # low bits of a word's hash that name its bucket
LONG = 64                        # lines in a list of two words that are compared with one leader first
RARE = 16                        # times LONG lines or more: such a word is frequent
KEYS = 8                         # of a line by which a pair that meets in several long lists is known
NO_ID = (1 << 63) - 1
LIST_PARTS = 2                   # parts of the lists of rare words that are dealt out one after the other
PART_PAIRS = 500_000             # pairs that are verified at once, in up to MOST_PARTS parts
MOST_PARTS = 8


def _shift(name: str, x: Column, k) -> Column:
    return F.call_function(name, x, F.lit(k) if isinstance(k, int) else k)


def row_keys(docs: DataFrame, id_col: str) -> DataFrame:
    """``docs`` with ``__row``: the id where it is unique and never null, else a number per
    row, written down so that it does not change."""
    twice = docs.groupBy(id_col).count().where(f"count > 1 or `{id_col}` is null")
    with released(docs.sparkSession):
        unique = twice.isEmpty()
    if unique:
        return docs.withColumn("__row", F.col(id_col).cast("long"))
    return scratch(docs.withColumn("__row", F.monotonically_increasing_id()), "numbered-docs")


def _spaced(text: Column) -> Column:
    """``text`` with spaces in place of the blanks that lines may hold besides (few texts do), so that words
    are split at one character, which takes no pattern."""
    others = BLANKS.replace(" ", "").replace("\n", "")
    some = functools.reduce(Column.__or__, [F.contains(text, F.lit(x)) for x in others])
    return F.when(some, F.translate(text, others, " " * len(others))).otherwise(text)


def line_sets(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """row, doc (the id, nulls last), no, h (hashes of the words) of every line with a word."""
    d = docs.select(F.col("__row").alias("row"), F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc"),
                    F.posexplode(F.split(F.lower(_spaced(F.col(text_col))), "\n", -1)).alias("no", "line"))
    d = d.select("row", "doc", "no", F.btrim("line").alias("line")).where(F.col("line") != "")
    h = F.array_distinct(F.transform(F.split("line", " "), lambda x: F.xxhash64(x)))
    return d.select("row", "doc", "no", F.array_remove(h, F.xxhash64(F.lit(""))).alias("h"))


def rarity_levels(docs: DataFrame, text_col: str) -> Column:
    """Levels 0 (rarest) to 15 of the buckets of words by their counts over all texts, four
    bits each in a literal array: ``2 ** RARITY_BITS`` buckets are half a megabyte, whatever the input."""
    n = 1 << RARITY_BITS
    word = docs.select(F.explode(F.split(F.replace(F.lower(_spaced(F.col(text_col))), F.lit("\n"), F.lit(" ")), " ")).alias("x")).where("x <> ''")
    counts = word.groupBy(F.xxhash64("x").bitwiseAND(F.lit(n - 1)).alias("b")).agg(F.count(F.lit(1)).alias("c"))
    level = F.least(F.floor(0.75 * F.log2(F.col("c") + 1)), F.lit(15)).cast("long")
    packed = (counts.select(_shift("shiftright", F.col("b"), 4).alias("w"), _shift(
                  "shiftleft", level, (4 * F.col("b").bitwiseAND(F.lit(15))).cast("int")).alias("v"))
              .unionAll(docs.sparkSession.range(n >> 4).select(F.col("id").alias("w"), F.lit(0).cast("long").alias("v")))
              .groupBy("w").agg(F.bit_or("v").alias("v")))
    text = packed.agg(F.sort_array(F.collect_list(F.struct("w", "v"))).alias("a")) \
        .select(F.array_join(F.transform("a", lambda x: x["v"].cast("string")), ",").alias("s"))
    with released(docs.sparkSession):
        text = text.first()["s"]
    return F.split(F.lit(text), ",").cast("array<long>")


def _need(a: Column, b: Column, percent: int) -> Column:
    """Least number of shared words of two sets of these sizes that match."""
    return F.ceil((a + b) * percent / (100 + percent))


def _parity(h: Column) -> list[Column]:
    """128 bits in two numbers, each bit the parity of the words of the set that fall on it."""
    def half(spots: Column) -> Column:
        # a shift goes by the low six bits of its number
        return F.aggregate(spots, F.lit(0).cast("long"), lambda a, x: a.bitwiseXOR(_shift(
            "shiftleft", F.lit(1).cast("long"), _shift("shiftrightunsigned", x, 57).cast("int"))))

    return [half(F.filter(h, lambda x: x >= 0)).alias("b0"), half(F.filter(h, lambda x: x < 0)).alias("b1")]


def _least_level(count: int) -> int:
    """Least rarity level of a word that occurs more than ``count`` times (its bucket counts as many)."""
    return min(15, math.floor(0.75 * math.log2(count + 2) - 1e-9))


def _spare(n: Column, percent: int) -> Column:
    """Words of a set of this size that a match may lack."""
    return n - F.floor((n * percent + 99) / 100).cast("int")


def _rare_words(p: Column) -> Column:
    return F.size(F.filter(p, lambda x: x < F.lit(_least_level(RARE * LONG) << 40)))


def _own(n: Column, percent: int) -> Column:
    return n - _need(n, n, percent).cast("int")


def _rare_entries(lines: DataFrame, percent: int) -> DataFrame:
    """key, lid, b0, b1 and nf (twice the size of the set, and whether the smaller one of two matching sets may first
    meet the other there) of the lists of rare words of all lines; their prefixes are for two shared words."""
    n = F.col("n")
    spare = _spare(n, percent)
    few = n - spare < 2                                   # a match may share one word only
    alone = F.when(few, spare + 1).otherwise(F.least("rare", spare + 1))
    e = lines.select("lid", "n", "b0", "b1", F.posexplode(F.slice("p", F.lit(1), alone)).alias("at", "key"))
    return e.select("key", "lid", (2 * n + (F.col("at") <= _own(n, percent)).cast("int")).alias("nf"), "b0", "b1")


def _frequent_entries(lines: DataFrame, percent: int) -> DataFrame:
    """The same of the lists of two frequent words."""
    n, p, rare = F.col("n"), F.col("p"), F.col("rare")

    def with_later(x: Column, i: Column) -> Column:
        return F.transform(F.slice(p, rare + i + 2, F.size(p)), lambda y, j: F.struct(
            F.xxhash64(x, y).alias("key"), (rare + i + j <= _own(n, percent)).alias("first")))

    keys = F.flatten(F.transform(F.slice(p, rare + 1, F.size(p)), with_later))
    e = lines.where((rare <= _spare(n, percent)) & (rare + 1 < F.size(p))).select("lid", "n", "b0", "b1", F.explode(keys).alias("k"))
    return e.select("k.key", "lid", (2 * n + F.col("k.first").cast("int")).alias("nf"), "b0", "b1")


def _opened(entries: DataFrame, *more: str) -> DataFrame:
    return entries.select("key", "lid", _shift("shiftright", F.col("nf"), 1).alias("n"), "b0", "b1",
                          F.col("nf").bitwiseAND(F.lit(1)).alias("first"), *more)


def _candidates(a: DataFrame, b: DataFrame, percent: int, extra: Column) -> DataFrame:
    """Lines (a, b) that meet in a list and pass the filters, once for each such list."""
    na, nb = F.col("a.n"), F.col("b.n")
    apart = F.bit_count(F.col("a.b0").bitwiseXOR(F.col("b.b0"))) + F.bit_count(F.col("a.b1").bitwiseXOR(F.col("b.b1")))
    cond = ((F.col("a.key") == F.col("b.key")) & (100 * F.least(na, nb) >= percent * F.greatest(na, nb))
            & ((100 + percent) * apart <= (100 - percent) * (na + nb)) & extra)
    return a.alias("a").join(b.alias("b"), cond)


def _pairs(l: str, m: str) -> list[Column]:
    return [F.least(l, m).alias("x"), F.greatest(l, m).alias("y")]


def _verified(pairs: DataFrame, first: DataFrame, docs: DataFrame, percent: int, id_col: str,
              text_col: str, label: str) -> DataFrame:
    """The (written) pairs whose whole sets match, as a table in their place: lid of the later line, and the earlier
    line. The sets are made anew from the texts of the documents that hold the lines, which is cheaper than keeping
    those of all lines. They come with their places, so that no pair is joined to the lines again."""
    some = pairs.select(F.explode(F.array("x", "y")).alias("lid"))
    where = sieve(first, some, "lid").join(some.distinct(), "lid").select("lid", "o", "o.row", "o.no")
    where = scratch(where, "line-places", release=True)
    sets = line_sets(sieve(docs, where.select(F.col("row").alias("__row")), "__row"), id_col, text_col)
    spot = F.xxhash64("row", "no").alias("spot")
    sets = sieve(sets.select("row", "no", "h", spot), where.select(spot), "spot").drop("spot")
    sets = scratch(sets.join(where, ["row", "no"]).select("lid", "o", "h"), "line-words", hashes=True, release=True)
    # a pair carries a whole set from one join to the next: by parts, so that the disk holds a share of them
    parts = min(MOST_PARTS, max(1, math.ceil(pairs.count() / PART_PAIRS)))
    good = None
    for k in range(parts):
        def of_part(col: str, k: int = k) -> Column:
            return F.pmod(F.xxhash64(col), F.lit(parts)) == k

        both = pairs.where(of_part("x")).join(sets.where(of_part("lid")).select(F.col("lid").alias("x"), F.col("o").alias("ox"), F.col("h").alias("hx")), "x") \
            .join(sets.select(F.col("lid").alias("y"), F.col("o").alias("oy"), F.col("h").alias("hy")), "y")
        n = F.size(F.array_intersect("hx", "hy"))
        found = scratch(both.where(100 * n >= percent * (F.size("hx") + F.size("hy") - n))
                        .select(F.greatest("ox", "oy").alias("o"), F.least("ox", "oy").alias("match")), label, release=True)
        good = found if good is None else good.unionAll(found)
    discard(where, sets, pairs)
    return good


def find_duplicate_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         percent: int = PERCENT) -> DataFrame:
    """One row per line that goes: row (see :func:`row_keys`), doc_id, line_no (from 0, of
    the ``\\n``-split text), n_words (distinct), match_doc_id and match_line_no: the first
    line of an equal set, or else an earlier line that is similar (the earliest that the
    search met).

    ``docs`` must have been through :func:`row_keys`. Null and empty texts and lines
    without words have nothing to remove. Null ids come last in the order; rows with one
    id are told apart and ordered as they were numbered. Equal lines inside a document
    count like any others. An empty table gives no rows; other columns are not read.
    """
    docs = docs.select("__row", id_col, text_col)
    levels = rarity_levels(docs, text_col)

    def key(x: Column) -> Column:
        """Level first, then 40 bits of the hash: words that share a key cost a look, no match."""
        at = _shift("shiftright", x.bitwiseAND(F.lit((1 << RARITY_BITS) - 1)), 4).cast("int")
        level = _shift("shiftrightunsigned", F.get(levels, at), x.bitwiseAND(F.lit(15)).cast("int") * 4)
        return _shift("shiftleft", level.bitwiseAND(F.lit(15)), 40).bitwiseOR(_shift("shiftrightunsigned", x, 24))

    n = F.size("h")
    # a set that no other one can match has no prefix
    alone = (_need(n, n + 1, percent) > n) & (_need(n - 1, n, percent) > n - 1)
    size = F.when(alone, F.lit(0)).otherwise(F.least(n, _spare(n, percent) + 2))
    lines = line_sets(docs, id_col, text_col)
    lines = scratch(lines.select("row", "doc", "no", F.monotonically_increasing_id().alias("lid"), n.alias("n"),
                                 *_parity(F.col("h")),
                                 F.xxhash64(F.sort_array("h")).alias("sig"),
                                 F.slice(F.sort_array(F.transform("h", key)), F.lit(1), size).alias("p")),
                    "lines", hashes=True, release=True)
    order = F.struct("doc", "row", "no", "lid", "n")
    classes = scratch(lines.groupBy("sig").agg(F.min(order).alias("o"), F.count(F.lit(1)).alias("c")), "line-classes", release=True)
    first = classes.select(F.col("o.lid").alias("lid"), "o")

    # lines of an equal set behind the first
    many = classes.where("c > 1").select("sig", "o")
    copies = scratch(sieve(lines.select("sig", "lid", order.alias("l")), many, "sig").join(many, "sig")
                     .where(F.col("lid") != F.col("o.lid")).select("lid", "l", "o"), "line-copies", release=True)

    # one line of each class in its lists
    pre = lines.where(F.size("p") > 0).select("lid", "n", "b0", "b1", "p")
    maybe = may_occur(copies, "lid")
    pre = pre.where(~maybe).unionAll(pre.where(maybe).join(copies.select("lid"), "lid", "left_anti"))
    pre = scratch(pre.withColumn("rare", _rare_words(F.col("p"))), "line-prefixes", hashes=True, release=True)
    discard(lines)

    # lists of rare words, by parts, so that the disk holds a share of them. One condition on both sides has the
    # smaller set go first: nothing of it goes below the dealing out, which then serves both sides
    na, nb = F.col("a.n"), F.col("b.n")
    rare = _rare_entries(pre, percent)
    smaller = F.coalesce(F.col("a.first"), F.lit(0)) * (nb - na + (F.col("a.lid") < F.col("b.lid")).cast("int")) > 0
    tables = []
    for k in range(LIST_PARTS):
        part = _opened(rare.where(F.pmod("key", F.lit(LIST_PARTS)) == k).repartition("key"))
        met = _candidates(part, part, percent, smaller).select(*_pairs("a.lid", "b.lid")).distinct()
        tables.append(scratch(met, "line-pairs", release=True))

    # lists of two frequent words
    two = _frequent_entries(pre, percent)
    two = two.repartition("key").withColumn("len", F.count(F.lit(1)).over(Window.partitionBy("key"))).where("len > 1")
    two = _opened(two, "len")
    short = two.where(F.col("len") <= LONG)
    smaller = (na < nb) | ((na == nb) & (F.col("a.lid") < F.col("b.lid")))
    met = _candidates(short.where("first = 1"), short, percent, smaller).select(*_pairs("a.lid", "b.lid")).distinct()
    # candidates and long lists leave one job
    none = F.lit(None)
    both = scratch(met.select("x", "y", none.cast("int").alias("n"), none.cast("long").alias("b0"), none.cast("long").alias("b1"))
                   .unionAll(two.where(F.col("len") > LONG).select("lid", "key", "n", "b0", "b1")), "line-pairs", release=True)
    discard(pre)
    long = both.where("n is not null").select(F.col("x").alias("lid"), F.col("y").alias("key"), "n", "b0", "b1")
    pairs = functools.reduce(DataFrame.unionAll, tables, both.where("n is null").select("x", "y"))

    some_long = not long.isEmpty()
    if some_long:
        members = long.groupBy("lid", "n", "b0", "b1").agg(F.sort_array(F.collect_list("key")).alias("all"))
        members = scratch(members.join(sieve(first, long, "lid"), "lid"), "line-members", release=True)
        long = members.select("lid", "o", "n", "b0", "b1", F.size("all").alias("pop"),
                              F.slice("all", F.lit(1), F.lit(KEYS)).alias("some"), F.explode("all").alias("key"))
        # a pair is looked at in the least list that both lines name, not in each where they meet
        shared = F.array_intersect("a.some", "b.some")
        once = (F.col("b.o") < F.col("a.o")) & (F.coalesce(F.array_min(shared), F.col("a.key")) >= F.col("a.key"))
        # the earliest line of a list leads, and so does the one in most long lists, which is next to a text that
        # many lines are near copies of; a member takes the earlier one that it meets most often
        who = F.struct("o", "n", "b0", "b1", "some")
        lead = long.groupBy("key").agg(F.array_distinct(F.array(F.min(who), F.min_by(who, F.struct(-F.col("pop"), "o")))).alias("m")) \
            .select("key", F.explode("m").alias("m")).select("key", F.col("m.o.lid").alias("lid"), "m.*")
        met = _candidates(long, lead, percent, once).select(F.col("a.lid").alias("m"), F.col("b.lid").alias("l"), F.size(shared).alias("met"))
        met = met.groupBy("m").agg(F.max_by("l", F.struct("met", "l")).alias("l"))
        pairs = pairs.unionAll(met.select(*_pairs("l", "m")))
    pairs = scratch(pairs.distinct(), "line-pairs", release=True)
    discard(both, *tables)
    found = _verified(pairs, first, docs, percent, id_col, text_col, "line-matches")
    if some_long:
        done = found.select("o.lid").distinct()
        more = _candidates(long.join(done, "lid", "left_anti"), long, percent, once)
        more = scratch(more.select(*_pairs("a.lid", "b.lid")).distinct(), "line-pairs", release=True)
        discard(members)
        found = found.unionAll(_verified(more, first, docs, percent, id_col, text_col, "line-rest"))

    discard(classes)
    near = found.groupBy("o").agg(F.min("match").alias("match"))
    gone = near.unionAll(copies.select(F.col("l").alias("o"), F.col("o").alias("match")))
    return gone.select(F.col("o.row").alias("row"), F.nullif(F.col("o.doc"), F.lit(NO_ID)).alias("doc_id"),
                       F.col("o.no").alias("line_no"), F.col("o.n").alias("n_words"),
                       F.nullif(F.col("match.doc"), F.lit(NO_ID)).alias("match_doc_id"),
                       F.col("match.no").alias("match_line_no"))


def remove_lines(docs: DataFrame, gone: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` (with ``__row``) without the lines of ``gone``; blank lines stay. A document
    of which no line goes keeps its text as it is."""
    cut = gone.groupBy(F.col("row").alias("__row")).agg(F.collect_set("line_no").alias("__gone"))
    lines = F.split(text_col, "\n", -1)
    left = F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), F.col("__gone"))
    d = docs.join(cut, "__row", "left").withColumn("__lines", F.when(F.col("__gone").isNotNull(), lines))
    text = F.when(F.col("__gone").isNull(), F.col(text_col)).otherwise(
        F.array_join(F.transform(left, lambda i: F.get("__lines", i)), "\n"))
    return d.withColumn(text_col, text).drop("__gone", "__lines")
