"""Source divergence audit: how far the word use of each source is from that
of every other source of its language, and by which terms.

1. Terms (runs of ASCII letters and non-ASCII characters, A-Z lower-cased) are
   counted by (lang, source, term) inside the scan tasks, together with the
   number of documents that hold the term; Spark adds the partial counts up,
   once they are shuffled.
2. A language keeps the terms of at least ``min_docs`` of its documents; they
   get dense ids by a parallel numbering over (lang, term).
3. A group's counts become arrays of (term id, count), sorted by id and cut
   into shards of ``SHARD`` consecutive ids, so that no array and no task
   grows with the vocabulary.
4. One task per unordered pair of groups and shard co-groups the two arrays.
   A galloping intersection finds the shared terms; shared, one-sided and
   absent terms are priced in both directions at once (an absent term costs
   the same for every id, so those are a count times a price).  Spark sums
   the shards.
5. The terms that set a group apart from its language are ranked by a window
   over the priced terms.

With count c of a term in a group or language, N the counts of its kept terms
and V the number of kept terms, p = 1 + floor(SCALE * (c + 1) / (N + V)), and
the divergence of p from q is floor((p - q)^2 / q).  All arithmetic is exact:
p is at most SCALE + 1, so a square is below 2^63; counts whose product with
SCALE would not fit 64 bits are priced with Python integers.

Defined results: a NULL text, lang or source counts as ''.  A group occurs
even if it has no terms; a language without kept terms gives the value 0 for
every pair.  Repeated rows count as often as they come.  An empty table gives
no rows.  Columns other than text, lang and source are not read, so clashing
names do no harm.  Long texts are counted in blocks.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ids import with_global_index
from . import text as T

SCALE = 1_000_000_000
SHARD = 1 << 16            # term ids per array
HELD = 1 << 19             # distinct (group, term) a scan task holds before it hands them on
TEXT_BLOCK = 1 << 20       # bytes of a text counted at once
# letters and bytes of other characters, A-Z lower-cased; every other byte is a space
_LETTERS = bytes(c if c >= 0x80 or chr(c).isalpha() else 0x20 for c in range(256)).lower()
_COUNTS = "lang string, source string, term string, n bigint, docs bigint"


def _terms(raw: bytes) -> Iterator[list[bytes]]:
    """The terms of one text in order, a block of it at a time."""
    at = 0
    while at < len(raw):
        end = min(at + TEXT_BLOCK, len(raw))
        while end < len(raw) and _LETTERS[raw[end]] != 0x20:            # never cut inside a term
            end += 1
        yield raw[at:end].translate(_LETTERS).split()
        at = end


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences), docs (documents that hold it); partial
    counts of each scan task.  A row with a NULL term marks that the group occurs."""

    def run(batches):
        groups: dict = {}
        held = 0

        def flush():
            for (lang, source), (n, d) in groups.items():
                keys = list(n)
                for i in range(0, len(keys) + 1, 1 << 16):          # the first slice also carries the mark
                    part = keys[i:i + (1 << 16)]
                    names = ([None] if i == 0 else []) + [k.decode("utf-8", "replace") for k in part]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(names), pa.string()), pa.array([source] * len(names), pa.string()),
                         pa.array(names, pa.string()),
                         pa.array(([0] if i == 0 else []) + [n[k] for k in part], pa.int64()),
                         pa.array(([0] if i == 0 else []) + [d[k] for k in part], pa.int64())],
                        names=["lang", "source", "term", "n", "docs"])
            groups.clear()

        for b in batches:
            langs, sources = b.column(1).to_pylist(), b.column(2).to_pylist()
            for raw, lang, source in zip(T.utf8(b.column(0)), langs, sources):
                n, d = groups.setdefault((lang, source), (Counter(), Counter()))
                before = len(n)
                there: set = set()
                for found in _terms(raw):
                    n.update(found)
                    there.update(found)
                d.update(there)
                held += len(n) - before
                if held > HELD:
                    yield from flush()
                    held = 0
        yield from flush()

    return docs.select(F.col("text").cast("string"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"),
                       F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source")).mapInArrow(run, _COUNTS)


def summed(parts: DataFrame) -> DataFrame:
    """The partial counts added up.  A scan task hands most keys on just once, so that summing
    before the shuffle, too, costs more than the rows it saves."""
    return parts.repartition("lang", "source", "term").groupBy("lang", "source", "term").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def price(counts: np.ndarray, total: int, kept: int) -> np.ndarray:
    """1 + floor(SCALE * (count + 1) / (total + kept)) for each count."""
    if len(counts) and (int(counts.max()) + 1) * SCALE >= 1 << 63:
        return np.array([1 + SCALE * (int(c) + 1) // (total + kept) for c in counts], np.int64)
    return 1 + SCALE * (counts + 1) // np.int64(total + kept)


def gallop(short: np.ndarray, long: np.ndarray, step: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the common values of two sorted arrays of distinct values.

    The short array is taken in runs; for each run the bracket in the long
    array starts where the last one ended and doubles until it holds the
    run's last value, and a binary search inside the bracket places the run."""
    if len(short) > len(long):
        b, a = gallop(long, short, step)
        return a, b
    left, right = [], []
    at, n = 0, len(long)
    for i in range(0, len(short), step):
        run = short[i:i + step]
        at += int(np.searchsorted(long[at:at + step], run[0])) if at < n and long[min(at + step, n) - 1] >= run[0] else 0
        width = step
        while at + width < n and long[at + width - 1] < run[-1]:
            width *= 2
        bracket = long[at:at + width]
        pos = np.searchsorted(bracket, run)
        inside = np.flatnonzero(pos < len(bracket))
        same = inside[bracket[pos[inside]] == run[inside]]
        left.append(same + i)
        right.append(pos[same] + at)
        at += int(pos[-1])
        if at >= n:
            break
    if not left:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(left), np.concatenate(right)


def _gap(p, q) -> int:
    """Sum of floor((p - q)^2 / q)."""
    d = np.asarray(p, np.int64) - np.asarray(q, np.int64)
    return int(np.sum(d * d // q))


def price_pair(a: tuple, b: tuple, kept_here: int) -> tuple[int, int]:
    """Divergence of group a from b and of b from a over one shard of ``kept_here`` ids.

    a and b: (ids, counts, total, kept)."""
    (ia, ca, na, v), (ib, cb, nb, _) = a, b
    pa_, pb_ = price(ca, na, v), price(cb, nb, v)
    zero = np.zeros(1, np.int64)
    a0, b0 = price(zero, na, v), price(zero, nb, v)
    xa, xb = gallop(ia, ib)
    only_a, only_b = np.ones(len(ia), bool), np.ones(len(ib), bool)
    only_a[xa] = False
    only_b[xb] = False
    absent = kept_here - len(ia) - len(ib) + len(xa)
    ab = _gap(pa_[xa], pb_[xb]) + _gap(pa_[only_a], b0) + _gap(a0, pb_[only_b]) + absent * _gap(a0, b0)
    ba = _gap(pb_[xb], pa_[xa]) + _gap(b0, pa_[only_a]) + _gap(pb_[only_b], a0) + absent * _gap(b0, a0)
    return ab, ba


def _pair_values(arrays: DataFrame, pairs: DataFrame) -> DataFrame:
    """lang, a, b, ab, ba summed over the shards of every unordered pair.

    ``arrays``: lang, source, shard, here (kept terms of the shard), v, total, ids, counts;
    one row per group and shard, also where the group has no term of it."""
    def sent(to: str) -> DataFrame:
        """The arrays of the groups named ``to``, sent to each of their pairs (new
        names throughout: both sides come from the same tables)."""
        x = arrays.select(F.col("lang").alias("_l"), F.col("source").alias("_s"),
                          *[F.col(c).alias(f"_{c}") for c in ("shard", "here", "v", "total", "ids", "counts")])
        y = pairs.select(F.col("lang").alias("_pl"), F.col("a").alias("_pa"), F.col("b").alias("_pb"))
        return x.join(y, (F.col("_l") == F.col("_pl")) & (F.col("_s") == F.col(to))).select(
            F.col("_l").alias("lang"), F.col("_pa").alias("a"), F.col("_pb").alias("b"),
            *[F.col(f"_{c}").alias(c) for c in ("shard", "here", "v", "total", "ids", "counts")])

    left, right = sent("_pa"), sent("_pb")

    def merge(x: pa.Table, y: pa.Table) -> pa.Table:
        def side(t):
            r = t.slice(0, 1)
            flat = lambda c: r.column(c).combine_chunks().flatten().to_numpy(zero_copy_only=False)
            return (flat("ids"), flat("counts"), r.column("total")[0].as_py(), r.column("v")[0].as_py())
        ab, ba = price_pair(side(x), side(y), x.column("here")[0].as_py())
        return pa.table({"lang": x.column("lang").slice(0, 1), "a": x.column("a").slice(0, 1),
                         "b": x.column("b").slice(0, 1), "ab": pa.array([ab], pa.int64()),
                         "ba": pa.array([ba], pa.int64())})

    keys = ["lang", "a", "b", "shard"]
    parts = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(
        merge, "lang string, a string, b string, ab bigint, ba bigint")
    return parts.groupBy("lang", "a", "b").agg(F.sum("ab").alias("ab"), F.sum("ba").alias("ba"))


def audit(docs: DataFrame, min_docs: int = 3, top_terms: int = 200) -> DataFrame:
    """lang, source, part ('pair' or 'term'), item, value, rank (see the module text).

    ``pair``: item is each other source of the language, value the divergence of
    the source from it.  ``term``: item is a kept term that the source uses more
    than its language, value its divergence there, the first ``top_terms``.
    Ranks go by value descending, then item ascending in UTF-8 order."""
    spark = docs.sparkSession
    T.prepare(spark)
    counts = T.stored(summed(term_counts(docs)), "divergence-counts")
    seen = counts.where("term IS NULL").select("lang", "source")
    lexicon = (counts.where("term IS NOT NULL").groupBy("lang", "term")
               .agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("_d")).where(F.col("_d") >= min_docs)
               .select("lang", "term", "lang_n"))
    lexicon = T.stored(with_global_index(T.stored(lexicon, "divergence-lexicon"), ["lang", "term"], "term_id"),
                       "divergence-terms")
    kept = T.stored(counts.where("term IS NOT NULL").join(lexicon, ["lang", "term"])
                    .select("lang", "source", "term", "term_id", "n", "lang_n"), "divergence-kept")

    shard = F.floor(F.col("term_id") / SHARD).cast("bigint").alias("shard")
    shards = lexicon.groupBy("lang", shard).agg(F.count(F.lit(1)).alias("here"), F.sum("lang_n").alias("_n"))
    langs = shards.groupBy("lang").agg(F.sum("here").alias("v"), F.sum("_n").alias("lang_total"))
    groups = T.stored(
        seen.join(kept.groupBy("lang", "source").agg(F.sum("n").alias("_t")), ["lang", "source"], "left")
            .join(langs, "lang", "left")
            .select("lang", "source", F.coalesce("_t", F.lit(0)).cast("bigint").alias("total"),
                    F.coalesce("v", F.lit(0)).cast("bigint").alias("v"),
                    F.coalesce("lang_total", F.lit(0)).cast("bigint").alias("lang_total")), "divergence-groups")

    # pairs
    other = groups.select(F.col("lang").alias("_l"), F.col("source").alias("b"))
    pairs = T.stored(groups.select("lang", F.col("source").alias("a"))
                           .join(other, (F.col("lang") == F.col("_l")) & (F.col("a") < F.col("b"))).select("lang", "a", "b"),
                     "divergence-pair-keys")
    entries = kept.groupBy("lang", "source", shard).agg(
        F.array_sort(F.collect_list(F.struct("term_id", "n"))).alias("_e"))
    empty = F.array().cast("array<bigint>")
    arrays = (groups.select("lang", "source", "total", "v").join(shards.select("lang", "shard", "here"), "lang")
                    .join(entries, ["lang", "source", "shard"], "left")
                    .select("lang", "source", "shard", "here", "v", "total",
                            F.coalesce(F.col("_e.term_id"), empty).alias("ids"),
                            F.coalesce(F.col("_e.n"), empty).alias("counts")))
    priced_pairs = T.stored(_pair_values(T.stored(arrays, "divergence-arrays"), pairs), "divergence-pair-values")
    both = pairs.join(priced_pairs, ["lang", "a", "b"], "left")
    zero = F.lit(0).cast("bigint")                       # a language without kept terms has no shard
    pair_rows = both.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), F.coalesce("ab", zero).alias("value")).union(
        both.select("lang", F.col("b").alias("source"), F.col("a").alias("item"), F.coalesce("ba", zero).alias("value")))

    # terms of a group against its language
    priced = (kept.join(groups, ["lang", "source"])
                  .select("lang", "source", F.col("term").alias("item"), _price("n", "total", "v").alias("_p"),
                          _price("lang_n", "lang_total", "v").alias("_q")).where("_p > _q")
                  .select("lang", "source", "item", F.expr("(_p - _q) * (_p - _q) div _q").alias("value")))
    order = [F.desc("value"), F.asc("item")]
    ranked = Window.partitionBy("lang", "source").orderBy(*order)
    term_rows = priced.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= top_terms)
    pair_rows = pair_rows.withColumn("rank", F.row_number().over(ranked))
    cols = ["lang", "source", "part", "item", "value", "rank"]
    return (pair_rows.withColumn("part", F.lit("pair")).select(cols)
            .unionByName(term_rows.withColumn("part", F.lit("term")).select(cols)))


def _price(count: str, total: str, kept: str) -> Column:
    """``price`` of a column; a product that would not fit 64 bits is taken as a decimal."""
    more, whole = F.col(count) + 1, F.col(total) + F.col(kept)
    short = _quotient(F.lit(SCALE).cast("bigint") * more, whole)
    exact = _quotient(F.lit(SCALE).cast("decimal(20,0)") * more.cast("decimal(18,0)"), whole.cast("decimal(20,0)"))
    return (F.lit(1) + F.when(more < F.lit((1 << 63) // SCALE), short).otherwise(exact)).cast("bigint")


def _quotient(x, y):
    """Whole quotient of two whole non-negative numbers (``div`` gives a bigint)."""
    return F.call_function("div", x, y)
