"""Near-duplicate documents by one-permutation MinHash, with exact links.

1. Every text becomes its set of distinct word shingles (64-bit hashes).  The
   hash range is cut into ``bins`` intervals and the smallest hash of each is
   the signature (one permutation); an empty interval borrows from the first
   non-empty one of its own random probe sequence (optimal densification).
   ``rows`` consecutive bins make a band.  With 24 bands of 4 rows a pair of
   similarity 0.8 shares no band with probability 3e-6.
2. Equal sets are one class; only one member per class goes on.
3. Inside each bucket (band, band value) the candidate edges are a star: the
   hub and every other member.  Edges are confirmed on the full sets.
4. Star edges alone can miss a link between two members that are both far
   from the hub.  So after the components of the star edges are known, the
   buckets that still hold several components get more edges.  Where a bucket
   has at most ``SMALL`` members (so a bounded number per member), these are
   all its pairs of different components.  In a larger one, its members carry
   a 1024-bin sketch of one byte per bin; blocks of members are compared in
   numpy, and a pair of different components becomes an edge if its estimated
   similarity is within four standard deviations of the threshold (so a link
   is missed with probability 3e-5) and no earlier band has it already.
   Members that one component holds are never paired, so copies, however
   many, cost one edge each.  No partner, candidate or bucket is capped.

Components are found by min-label propagation with pointer jumping; every
round is written to the shared scratch folder.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as T

_U = np.uint64
_PROBES = 1024
SMALL = 16                # members of a bucket whose cross-component pairs are all compared
SKETCH_BINS = 1024
BLOCK_ROWS = 512          # members of a bucket compared in one group
_SIGNATURES = "doc_id bigint, n_shingles bigint, fp1 bigint, fp2 bigint, bands array<bigint>"


def _tables(bins: int):
    edges = np.array([(i << 64) // bins for i in range(1, bins)], dtype=np.uint64)
    probes = np.random.default_rng(bins).integers(0, bins, (bins, _PROBES))
    return edges, probes


def signature(hashes: np.ndarray, edges: np.ndarray, probes: np.ndarray) -> np.ndarray:
    """Densified one-permutation signature of a sorted, non-empty hash set."""
    first = np.concatenate(([0], np.searchsorted(hashes, edges)))
    filled = np.diff(np.concatenate((first, [len(hashes)]))) > 0
    sig = hashes[np.minimum(first, len(hashes) - 1)]
    empty = np.flatnonzero(~filled)
    if len(empty):
        donor = np.full(len(empty), -1)
        todo = np.arange(len(empty))
        for width in (16, 128, _PROBES):           # most bins find a donor early
            hit = filled[probes[empty[todo], :width]]
            found = hit.any(axis=1)
            donor[todo[found]] = probes[empty[todo[found]], hit[found].argmax(axis=1)]
            todo = todo[~found]
            if not len(todo):
                break
        if len(todo):
            donor[todo] = np.flatnonzero(filled)[0]
        sig = sig.copy()
        sig[empty] = sig[donor]
    return sig


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    part = sig[:bands * rows].reshape(bands, rows)
    h = T.mix(np.arange(1, bands + 1, dtype=np.uint64))
    for i in range(rows):
        h = T.mix(h * _U(0x9E3779B97F4A7C15) + part[:, i])
    return h


def signatures(docs: DataFrame, words: int, bands: int, rows: int) -> DataFrame:
    """doc_id, n_shingles, 128-bit fingerprint of the set, band keys (NULL for an empty set)."""

    def run(batches):
        edges, probes = _tables(bands * rows)
        for b in batches:
            n, fp1, fp2, keys = [], [], [], []
            for raw in T.utf8(b.column(1)):
                x = T.shingles(T.word_hashes(raw.lower()), words)
                n.append(len(x))
                if len(x):
                    d = np.frombuffer(xxhash.xxh3_128_digest(x.tobytes()), np.int64)
                    fp1.append(int(d[0]))
                    fp2.append(int(d[1]))
                    keys.append(band_keys(signature(x, edges, probes), bands, rows).view(np.int64))
                else:
                    fp1.append(None)
                    fp2.append(None)
                    keys.append(None)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(fp1, pa.int64()), pa.array(fp2, pa.int64()),
                 pa.array(keys, pa.list_(pa.int64()))],
                names=["doc_id", "n_shingles", "fp1", "fp2", "bands"])

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(run, _SIGNATURES)


def sketches(sets: DataFrame, bands: int, rows: int) -> DataFrame:
    """id, sketch (one byte per bin), own (the low 32 bits of the band keys)."""

    def run(batches):
        fine, coarse = _tables(SKETCH_BINS), _tables(bands * rows)
        for b in batches:
            sketch, own = [], []
            for x in b.column(1):
                h = np.sort(x.values.to_numpy(zero_copy_only=False).view(np.uint64))
                sketch.append(T.mix(signature(h, *fine)).astype(np.uint8).tobytes())
                own.append(band_keys(signature(h, *coarse), bands, rows).astype(np.uint32).tobytes())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sketch, pa.binary()), pa.array(own, pa.binary())],
                                             names=["id", "sketch", "own"])

    return sets.select("id", "shingles").mapInArrow(run, "id bigint, sketch binary, own binary")


def close_pairs(rows: DataFrame, percent: int) -> DataFrame:
    """(a, b) of different components in a bucket whose sketches agree enough.

    ``rows``: key, members, id, comp, sketch, own.  A bucket is dealt into
    blocks of about BLOCK_ROWS members and every pair of blocks is one group,
    so no group grows with the bucket."""
    p = percent / 100
    least = p - 4 * (p * (1 - p) / SKETCH_BINS) ** 0.5
    blocks = F.ceil(F.col("members") / BLOCK_ROWS).cast("int")
    dealt = (rows.withColumn("_blocks", blocks)
                 .withColumn("_i", F.pmod(F.xxhash64("id"), F.col("_blocks")).cast("int"))
                 .withColumn("_j", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
                 .select("key", F.least("_i", "_j").alias("_p"), F.greatest("_i", "_j").alias("_q"), "_i",
                         "id", "comp", "sketch", "own"))

    def compare(t: pa.Table) -> pa.Table:
        n = t.num_rows
        ids, comp, block = (t.column(c).to_numpy() for c in ("id", "comp", "_i"))
        low = np.uint32(int(t.column("key")[0].as_py()) & 0xFFFFFFFF)
        sketch = np.frombuffer(b"".join(t.column("sketch").to_pylist()), np.uint8).reshape(n, -1)
        own = np.frombuffer(b"".join(t.column("own").to_pylist()), np.uint32).reshape(n, -1)
        same_block = t.column("_p")[0].as_py() == t.column("_q")[0].as_py()
        at = np.arange(n)
        a, b = [], []
        for i in range(n):
            with_i = at[(comp != comp[i]) & ((at > i) if same_block else (block > block[i]))]
            if not len(with_i):
                continue
            near = with_i[(sketch[with_i] == sketch[i]).mean(axis=1) >= least]
            shared = own[near] == own[i]
            near = near[own[i][shared.argmax(axis=1)] == low]     # this is the first band they share
            a.extend(np.minimum(ids[near], ids[i]).tolist())
            b.extend(np.maximum(ids[near], ids[i]).tolist())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return dealt.groupBy("key", "_p", "_q").applyInArrow(compare, "a bigint, b bigint")


def shingle_sets(docs: DataFrame, words: int) -> DataFrame:
    """id, shingles (sorted distinct 64-bit hashes)."""

    def run(batches):
        for b in batches:
            sets = [T.shingles(T.word_hashes(raw.lower()), words).view(np.int64) for raw in T.utf8(b.column(1))]
            for a, z in T.by_size([s.data for s in sets], 1 << 20):
                yield pa.RecordBatch.from_arrays([b.column(0).slice(a, z - a), pa.array(sets[a:z], pa.list_(pa.int64()))],
                                                 names=["id", "shingles"])

    return docs.select("id", "text").mapInArrow(run, "id bigint, shingles array<bigint>")


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The (a, b) whose sets meet 100 * intersection >= percent * union."""
    one = sets.select(F.col("id").alias("a"), F.col("shingles").alias("_x"))
    two = sets.select(F.col("id").alias("b"), F.col("shingles").alias("_y"))
    both = pairs.join(one, "a").join(two, "b")
    small, large = F.least(F.size("_x"), F.size("_y")), F.greatest(F.size("_x"), F.size("_y"))
    inter = F.size(F.array_intersect("_x", "_y"))
    return (both.where(100 * small >= percent * large)
                .where(100 * inter >= percent * (small + large - inter))
                .select("a", "b"))


def components(links: DataFrame, label: str = "cc") -> DataFrame:
    """id, comp (smallest id reachable) for every id that has a link.

    Each round takes the smallest label among the neighbours and then the
    label of that label, so the number of rounds is about logarithmic in the
    longest chain.  Rounds end when no label changes."""
    edges = T.stored(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
                          .distinct(), f"{label}-edges")
    state = T.stored(edges.groupBy(F.col("a").alias("id"))
                          .agg(F.min("b").alias("_m")).select("id", F.least("id", "_m").alias("comp")), label)
    while True:
        near = (edges.join(state.select(F.col("id").alias("b"), "comp"), "b")
                     .groupBy(F.col("a").alias("id")).agg(F.min("comp").alias("_m")))
        step = state.join(near, "id", "left").select(
            "id", F.col("comp").alias("_old"), F.least("comp", "_m").alias("_c"))
        up = state.select(F.col("id").alias("_i"), F.col("comp").alias("_up"))
        step = T.stored(step.join(up, step["_c"] == up["_i"], "left")
                            .select("id", "_old", F.coalesce(F.least("_c", "_up"), "_c").alias("comp")), label)
        state = step.select("id", "comp")
        if step.where(F.col("_old") != F.col("comp")).isEmpty():
            return state


def _mixed(slots: DataFrame) -> DataFrame:
    """key, members: the keys that hold more than one component."""
    return (slots.groupBy("key").agg(F.min("comp").alias("_lo"), F.max("comp").alias("_hi"),
                                     F.count(F.lit(1)).alias("members")).where("_lo < _hi").select("key", "members"))


def _cross_pairs(slots: DataFrame) -> DataFrame:
    """(a, b) of different components that share a key."""
    other = slots.select("key", F.col("id").alias("_b"), F.col("comp").alias("_cb"))
    return (slots.join(other, (slots["key"] == other["key"]) & (F.col("comp") < F.col("_cb")))
                 .select(F.least("id", "_b").alias("a"), F.greatest("id", "_b").alias("b")).distinct())


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, bands: int = 24, rows: int = 4) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs``.

    Two documents are linked if 100 * |intersection| >= percent * |union| of
    their distinct ``words``-word shingles (ASCII lower-cased, split at ASCII
    white space; a shorter text is one shingle).  A NULL, empty or blank text
    has an empty set and is linked with nothing.  A NULL doc_id is its own
    component (NULL) and kept.  Repeated rows come back as often as they come
    in.  ``kept`` marks the smallest doc_id of each component."""
    spark = docs.sparkSession
    T.prepare(spark)
    sig = T.stored(signatures(docs, words, bands, rows), "signatures")
    usable = sig.where(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))
    classes = T.stored(usable.groupBy("fp1", "fp2").agg(F.min("doc_id").alias("id"), F.count(F.lit(1)).alias("_n")),
                       "classes")

    # one representative per class; equal rows of that id have equal bands
    reps = usable.select("doc_id", "fp1", "fp2", "bands").join(
        classes.select(F.col("id"), F.col("fp1").alias("_f1"), F.col("fp2").alias("_f2")),
        (F.col("doc_id") == F.col("id")) & (F.col("fp1") == F.col("_f1")) & (F.col("fp2") == F.col("_f2")))
    slots = reps.select("id", F.explode("bands").alias("key"))
    hubs = slots.groupBy("key").agg(F.min("id").alias("hub"), F.max("id").alias("_last")).where("hub < _last")
    members = T.stored(slots.join(hubs.select("key", "hub"), "key").select("key", "id", "hub"), "buckets")

    star = members.where("id != hub").select(F.col("hub").alias("a"), F.col("id").alias("b")).distinct()
    star = T.stored(star, "star")
    nodes = members.select("id").distinct()
    texts = docs.select(F.col("doc_id").cast("bigint").alias("id"), F.col("text").cast("string").alias("text"))
    sets = T.stored(shingle_sets(texts.join(nodes, "id", "left_semi"), words), "sets")
    links = T.stored(confirm(star, sets, percent), "links")
    comp = components(links)

    # buckets that hold several components: small ones pair by pair, large ones by sharp keys
    held = T.stored(members.select("key", "id").join(comp, "id", "left").select(
        "key", "id", F.coalesce("comp", "id").alias("comp")), "held")
    rest = T.stored(held.join(_mixed(held), "key"), "mixed")
    large = rest.where(F.col("members") > SMALL)
    marks = sketches(sets.join(large.select("id").distinct(), "id", "left_semi"), bands, rows)
    pairs = T.stored(_cross_pairs(rest.where(F.col("members") <= SMALL)).union(
        close_pairs(large.join(marks, "id"), percent)).distinct().join(star, ["a", "b"], "left_anti"), "pairs")
    more = T.stored(confirm(pairs, sets, percent), "links2")
    if not more.isEmpty():
        comp = components(links.union(more), "cc2")

    named = classes.join(comp, "id", "left").where("_n > 1 OR comp IS NOT NULL").select(
        F.col("fp1").alias("_f1"), F.col("fp2").alias("_f2"), F.coalesce("comp", "id").alias("_comp"))
    out = sig.join(named, (F.col("fp1") == F.col("_f1")) & (F.col("fp2") == F.col("_f2")), "left")
    cid = F.coalesce("_comp", "doc_id")
    return out.select("doc_id", "n_shingles", cid.alias("component_id"),
                      F.coalesce(F.col("doc_id") == cid, F.lit(True)).alias("kept"))
