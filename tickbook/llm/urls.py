"""URL filtering by rules and by two character language models.

Rules (host suffix, path prefix) accept or reject some URLs.  From those, two
smoothed variable-order Markov models are counted over the bytes of the URL,
one of accepted and one of rejected URLs.  The chance of a byte mixes the
orders 0 to ``ORDER``: each order's counts are smoothed with the next shorter
one's chance, in proportion to how rarely its context was seen.  The difference
of the two log-likelihoods per byte is the score, and a logistic curve fitted
on rule-judged URLs that the counts leave out turns it into a probability.

Counts are kept by the real order, context and byte, which fit into 52 bits,
so no two contexts share a count however many URLs there are.  All URLs are
counted, by partial sums.  If there are more than ``MOST`` distinct keys, those
that occur in at least one of ``MOST`` places (at most ``MOST`` of them) go to
the tasks as a broadcast; the others, none of which is frequent, are joined.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import text as T
from .quality import logistic

ORDER = 5
STRENGTH = 2.0
MOST = 1 << 21      # keys that are broadcast
_FLUSH = 1 << 21    # places counted in a task before their sums are passed on
HELD = 5            # one URL in HELD calibrates
_GRID = 4000        # cells of the calibration histogram over [-10, 10]

RULES = (("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"),
         ("net/es/", "block"), ("net/fr/", "block"))


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Lower-cased (A-Z) text after the first ``://`` up to / ? # or end, and the
    path from there up to ? # or end; both empty for NULL or without ``://``."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    low = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(low, F.lit("")), F.coalesce(path, F.lit(""))


def match_rules(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, or NULLs."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r, v in sorted(rules, key=lambda x: (len(x[0]), x[0])):      # the longest is tried first
        name, _, rest = r.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + rest)
        rule, verdict = F.when(fits, F.lit(r)).otherwise(rule), F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def _keys(urls: list[bytes]):
    """For every byte (and the end mark) of all URLs: its URL, and per order the
    key of its context and of its context with the byte."""
    pad = b"\x00" * ORDER
    buf = np.frombuffer(b"".join(pad + u + b"\x01" for u in urls), np.uint8).astype(np.int64)
    n = np.array([len(u) + 1 for u in urls])
    own = np.repeat(np.arange(len(urls)), n)
    at = np.arange(n.sum()) + ORDER * (own + 1)
    context = np.zeros(len(at), np.int64)
    for k in range(ORDER + 1):
        if k:
            context = context << 8 | buf[at - k]
        key = k << 9 + 8 * ORDER | context << 9      # order, context, whether a byte follows, the byte
        yield own, key, key | 256 | buf[at]


def count_keys(urls: DataFrame) -> DataFrame:
    """key, rejected, accepted, places from columns url, y (0, 1, or 2 for neither):
    how often a key occurs in rejected, accepted, and all URLs."""

    def run(batches):
        held, size = [], 0

        def summed():
            u, n = np.unique(np.concatenate(held), return_counts=True)
            for a in range(0, len(u), 1 << 16):
                z = a + (1 << 16)
                yield pa.RecordBatch.from_arrays([pa.array(u[a:z] >> 2), pa.array((u[a:z] & 3).astype(np.int32)), pa.array(n[a:z])],
                                                 names=["key", "y", "n"])

        for b in batches:
            raw, y = T.utf8(b.column(0)), b.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
            for a, z in T.by_size(raw, 1 << 16):
                for own, context, pair in _keys(raw[a:z]):
                    held += [context << 2 | y[a:z][own], pair << 2 | y[a:z][own]]
                    size += 2 * len(own)
                if size > _FLUSH:
                    yield from summed()
                    held, size = [], 0
        if held:
            yield from summed()

    def of(y):
        return F.sum(F.when(F.col("y") == y, F.col("n")).otherwise(0))

    part = urls.select("url", "y").mapInArrow(run, "key bigint, y int, n bigint")
    return part.groupBy("key").agg(of(0).alias("rejected"), of(1).alias("accepted"), F.sum("n").alias("places"))


Table = tuple[np.ndarray, np.ndarray]       # sorted keys; counts in rejected and accepted URLs


def _lookup(table: Table, x: np.ndarray) -> np.ndarray:
    keys, counts = table
    if not len(keys):
        return np.zeros((len(x), 2), np.int64)
    at = np.minimum(np.searchsorted(keys, x), len(keys) - 1)
    return np.where((keys[at] == x)[:, None], counts[at], 0)


def score(urls: list[bytes], *tables: Table) -> np.ndarray:
    """Log-likelihood difference (accepted - rejected) per byte; the end mark counts.
    A key is in one of the tables, or has no counts."""
    if not urls:
        return np.zeros(0)
    chance = 1 / 257
    for own, context, pair in _keys(urls):                                          # noqa: B007
        seen, times = (sum(_lookup(t, x) for t in tables) for x in (context, pair))
        chance = (times + STRENGTH * chance) / (seen + STRENGTH)
    d = np.bincount(own, np.log(chance[:, 1]) - np.log(chance[:, 0]), len(urls))
    return d / np.array([len(u) + 1 for u in urls])


def _table(rows: pa.Table) -> Table:
    rows = rows.sort_by("key")
    return (rows.column("key").to_numpy(),
            np.column_stack([rows.column(c).to_numpy() for c in ("rejected", "accepted")]).astype(np.int64))


def _scored(rows: DataFrame) -> DataFrame:
    """``rows`` (columns url, y and others) with ``score``, stored."""
    spark = rows.sparkSession
    counts = T.stored(count_keys(rows), "url-counts")
    keys, places = counts.agg(F.count(F.lit(1)), F.coalesce(F.sum("places"), F.lit(0))).first()
    often = 1 if keys <= MOST else -(-int(places) // MOST)
    # keys of no accepted or rejected URL are there too: none that is left to the join is frequent
    shared = spark.sparkContext.broadcast(_table(counts.where(F.col("places") >= often).toArrow()))
    if often == 1:
        @F.arrow_udf("double")
        def whole(u: pa.Array) -> pa.Array:
            raw = T.utf8(u)
            return pa.array(np.concatenate([score(raw[a:b], shared.value) for a, b in T.by_size(raw, 1 << 18)] or [np.zeros(0)]))

        return T.stored(rows.withColumn("score", whole("url")), "url-scores")

    def missing(batches):
        known = shared.value[0]
        for b in batches:
            raw, row = T.utf8(b.column(1)), b.column(0).to_numpy()
            for a, z in T.by_size(raw, 1 << 16):
                for own, *both in _keys(raw[a:z]):
                    for x in both:
                        at = np.minimum(np.searchsorted(known, x), len(known) - 1)
                        left = known[at] != x if len(known) else np.ones(len(x), bool)
                        yield pa.RecordBatch.from_arrays([pa.array(row[a:z][own[left]]), pa.array(x[left])], names=["_of", "key"])

    @F.arrow_udf("double")
    def joined(u: pa.Array, rare: pa.Array) -> pa.Array:
        raw, out = T.utf8(u), [np.zeros(0)]
        for a, z in T.by_size(raw, 1 << 16):
            mine = rare.slice(a, z - a).flatten()
            own = pa.Table.from_arrays([mine.field(i) for i in range(3)], names=["key", "rejected", "accepted"])
            keys, n = _table(own)
            keys, first = np.unique(keys, return_index=True)
            out.append(score(raw[a:z], shared.value, (keys, n[first])))
        return pa.array(np.concatenate(out))

    rows = T.stored(rows.withColumn("_row", F.monotonically_increasing_id()), "url-rows")
    rare = counts.where((F.col("places") < often) & (F.col("rejected") + F.col("accepted") > 0))
    found = (rows.select("_row", "url").mapInArrow(missing, "_of bigint, key bigint").distinct().join(rare, "key")
                 .groupBy("_of").agg(F.collect_list(F.struct("key", "rejected", "accepted")).alias("_rare")))
    both = rows.join(found, F.col("_row") == F.col("_of"), "left")
    none = F.array().cast("array<struct<key:bigint,rejected:bigint,accepted:bigint>>")
    return T.stored(both.withColumn("score", joined("url", F.coalesce("_rare", none))).drop("_row", "_of", "_rare"), "url-scores")


def filter_urls(pages: DataFrame, rules=RULES) -> DataFrame:
    """``pages`` columns page_id and url with host, path, rule, verdict, score, p_allow.

    The verdict is the longest rule's; without one it is allow if p_allow is
    at least one half.  A NULL or empty url has an empty host and path, no
    rule, and is scored as the empty string.  Repeated rows count each; if the
    rules judge no URL, or all alike, p_allow is the share of accepted ones
    (one half without any)."""
    spark = pages.sparkSession
    T.prepare(spark)
    url = F.col("url").cast("string")
    host, path = host_and_path(url)
    base = pages.select("page_id", "url").withColumn("host", host).withColumn("path", path)
    rule, verdict = match_rules(F.col("host"), F.col("path"), rules)
    held = F.pmod(F.xxhash64("url", F.lit("held")), F.lit(HELD)) == 0
    base = base.withColumn("rule", rule).withColumn("_rule_verdict", verdict).withColumn("_held", held)
    base = base.withColumn("url", url)
    allowed = (F.col("_rule_verdict") == "allow").cast("int")
    scored = _scored(base.withColumn("y", F.when(F.col("_rule_verdict").isNull() | F.col("_held"), 2).otherwise(allowed)))

    # Platt's curve from a histogram of the held URLs, whose size is fixed
    cell = F.least(F.greatest(F.floor((F.col("score") + 10) * (_GRID / 20)), F.lit(0)), F.lit(_GRID - 1)).cast("int")
    hist = (scored.where(F.col("_rule_verdict").isNotNull() & F.col("_held")).select(cell.alias("c"), allowed.alias("y"))
                  .groupBy("c", "y").count().orderBy("c", "y").collect())
    x = np.array([(r[0] + 0.5) * 20 / _GRID - 10 for r in hist])
    a, b = logistic(x, np.array([r[1] for r in hist], float), np.array([r[2] for r in hist])) if hist else (0.0, 0.0)
    p = F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.lit(a) * F.col("score") + F.lit(b))))
    return (scored.withColumn("p_allow", p)
                  .withColumn("verdict", F.coalesce("_rule_verdict", F.when(F.col("p_allow") >= 0.5, "allow").otherwise("block")))
                  .select("page_id", "url", "host", "path", "rule", "verdict", "score", "p_allow"))
