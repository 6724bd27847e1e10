"""Benchmark decontamination by Wu-Manber multi-pattern search.

Patterns are the windows of ``window`` consecutive words of the benchmark
items (a shorter item is one pattern), spelled with single spaces and a space
at either end.  A document is spelled the same way and scanned once per class
of pattern lengths: the block of ``block`` bytes at the end of the current
position is looked up in the shift table, which says how far the position may
move without passing a pattern; where it says 0 the block's bucket names the
patterns to compare directly.  With windows of 13 words most blocks allow a
jump of tens of bytes.

The benchmark is read in groups of about ``pass_bytes`` of text, dealt by the
hash of the item, so neither the driver nor a broadcast holds more than that
whatever the benchmark's size.  One group is the usual case and needs no
shuffle; several groups are scanned one after the other and their hits are
joined per document.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as T

# bytes of a word: 0-9, a-z (A-Z lower-cased) and everything above ASCII
_SPELL = bytes((c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else
                c + 32 if 0x41 <= c <= 0x5A else 0x20) for c in range(256))
SCAN = "text_hash bigint, n_words bigint, spans array<struct<first:bigint,last:bigint>>, items array<string>"


def spell(raw: bytes) -> bytes:
    """Lower-cased words between single spaces, with a space at either end; no word: empty."""
    words = raw.translate(_SPELL).split()
    return b" " + b" ".join(words) + b" " if words else b""


def patterns_of(item: bytes, window: int) -> set[bytes]:
    words = item.translate(_SPELL).split()
    if not words:
        return set()
    n = max(1, len(words) - window + 1)
    return {b" " + b" ".join(words[i:i + window]) + b" " for i in range(n)}


class WuManber:
    """One scan for patterns whose lengths are within a factor of two."""

    def __init__(self, patterns: list[bytes]):
        self.m = m = min(map(len, patterns))
        # block length of the method, log of 2 m r over a text alphabet of about 5 equally likely bytes
        self.block = b = max(1, min(m, math.ceil(math.log(2 * m * len(patterns) + 1, 5))))
        self.jump = m - b + 1
        self.shift: dict[bytes, int] = {}
        self.bucket: dict[bytes, list[bytes]] = {}
        for p in patterns:
            for end in range(b, m + 1):
                key = p[end - b:end]
                if m - end < self.shift.get(key, self.jump):
                    self.shift[key] = m - end
            self.bucket.setdefault(p[m - b:m], []).append(p)

    def find(self, text: bytes):
        """(start, pattern) of every occurrence."""
        shift, bucket, jump, b, m = self.shift.get, self.bucket, self.jump, self.block, self.m
        at, n = m, len(text)
        while at <= n:
            step = shift(text[at - b:at], jump)
            if step:
                at += step
                continue
            start = at - m
            for p in bucket[text[at - b:at]]:
                if text.startswith(p, start):
                    yield start, p
            at += 1


class Index:
    """Searches for all windows of one group of items."""

    def __init__(self, items: list[tuple[str, bytes]], window: int):
        self.owners: dict[bytes, tuple[str, ...]] = {}
        for name, text in sorted(items):
            for p in patterns_of(text, window):
                have = self.owners.get(p, ())
                if name not in have:
                    self.owners[p] = (*have, name)
        classes: dict[int, list[bytes]] = {}
        for p in self.owners:
            classes.setdefault(len(p).bit_length(), []).append(p)
        self.scans = [WuManber(ps) for _, ps in sorted(classes.items())]

    def scan(self, raw: bytes):
        """(number of words, merged (first, last) word spans, sorted items)."""
        text = spell(raw)
        if not text:
            return 0, [], []
        hits, names = [], set()
        for s in self.scans:
            for start, p in s.find(text):
                hits.append((start, start + len(p)))
                names.update(self.owners[p])
        spans, word, seen = [], 0, 0          # ``word`` words start before byte ``seen``
        for start, end in merge(sorted(hits)):
            word += text.count(b" ", seen, start)
            seen = start
            spans.append((word, word + text.count(b" ", start, end) - 2))
        return text.count(b" ") - 1, spans, sorted(names)


def merge(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Union of sorted half-open ranges."""
    out: list = []
    for a, b in ranges:
        if out and a < out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


_built: dict[bytes, Index] = {}


def _index(items, window) -> Index:
    key = hashlib.blake2b(repr((window, items)).encode(), digest_size=16).digest()
    if key not in _built:
        _built.clear()
        _built[key] = Index(items, window)
    return _built[key]


def _scan(docs: DataFrame, items: list[tuple[str, bytes]], window: int) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(items)
    fields = pa.struct([("first", pa.int64()), ("last", pa.int64())])

    def run(batches):
        index = _index(shared.value, window)
        for b in batches:
            found = [index.scan(raw) for raw in T.utf8(b.column(1))]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), pa.array([x[0] for x in found], pa.int64()),
                 pa.array([[{"first": s[0], "last": s[1]} for s in x[1]] for x in found], pa.list_(fields)),
                 pa.array([x[2] for x in found], pa.list_(pa.string()))],
                names=["doc_id", "text_hash", "n_words", "spans", "items"])

    return docs.mapInArrow(run, "doc_id bigint, " + SCAN)


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 13, percent: int = 5,
                  pass_bytes: int = 4 << 20) -> DataFrame:
    """doc_id, n_words, n_hit, spans, items, text_hash, contaminated for every row of ``docs``.

    ``spans``: (first, last) word positions covered by occurrences; ``items``:
    the benchmark items with occurring windows, as sorted strings.  A document
    is contaminated if n_hit > 0 and 100 * n_hit >= percent * n_words.  NULL
    and blank texts have no words and no hits; NULL or blank items have no
    window; an item id that repeats is one item.  Repeated document rows come
    back as often as they come in."""
    spark = docs.sparkSession
    T.prepare(spark)
    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"), F.xxhash64("text").alias("text_hash"))
    bench = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"),
                             F.col("text").cast("string").alias("text")).where(F.col("text").isNotNull())
    total = bench.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = max(1, math.ceil(total / pass_bytes))

    def part(g):
        mine = bench.where(F.pmod(F.xxhash64("item"), F.lit(groups)) == g)
        return sorted((r[0], r[1].encode()) for r in mine.collect())

    if groups == 1:
        found = _scan(rows, part(0), window)
    else:  # equal rows have equal hits, so equal (doc_id, hash of the text) may share one row of hits
        parts = [T.stored(_scan(rows, part(g), window), "hits") for g in range(groups)]
        both = parts[0]
        for p in parts[1:]:
            both = both.union(p)
        key = ["doc_id", "n_words", "text_hash"]
        merged = both.groupBy(*key).agg(F.flatten(F.collect_set("spans")).alias("spans"),
                                        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
        one = parts[0].select(*key)
        same = [one[k].eqNullSafe(merged[k]) for k in key]
        found = one.join(merged, same[0] & same[1] & same[2], "left").select(
            one["doc_id"], one["n_words"], one["text_hash"], "spans", "items")
    # words under the union of the spans, in order of their first word
    cover = F.aggregate(
        F.array_sort("spans"), F.struct(F.lit(-1).cast("bigint").alias("upto"), F.lit(0).cast("bigint").alias("n")),
        lambda a, s: F.struct(F.greatest(a["upto"], s["last"]).alias("upto"),
                              (a["n"] + F.greatest(F.lit(0).cast("bigint"), s["last"] - F.greatest(a["upto"], s["first"] - 1)))
                              .alias("n")), lambda a: a["n"])
    n_hit = cover.cast("bigint")
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), "spans", "items", "text_hash",
                        ((n_hit > 0) & (100 * n_hit >= percent * F.col("n_words"))).alias("contaminated"))
