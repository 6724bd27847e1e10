"""Hard-negative mining with Fagin's threshold algorithm.

For every anchor the first ``k`` rows of its own label are its positives, and
for each positive the first ``k`` rows of other labels whose score lies in a
window below the positive's score are its hard negatives.  A score is the
integer inner product of the quantised vectors; higher scores come first, ties
by smaller vec_id.

Rows are dealt into blocks of about ``BLOCK_ROWS`` and anchors into chunks of
about ``CHUNK_ANCHORS``; one task co-groups a block with a chunk (for the
positives, blocks and chunks of one label).  Inside a block

1. every dimension has its list of rows sorted by component;
2. an anchor reads the lists of its non-zero dimensions in parallel, from the
   large end where its own component is positive and from the small end where
   it is negative (sorted access), ever deeper;
3. a row met for the first time is scored on all its components (random
   access, one matrix product per step);
4. the threshold is the score of a row that had the last value read of every
   list, so no unseen row scores more.  Reading stops once the threshold is
   strictly below the k-th score of each window (below its lower end while
   the window holds fewer), strictly because a row with an equal score may
   come first by its id.

The block results are merged by a window per anchor (and positive) that Spark
limits to k rows before the shuffle.  Every row is searched: nothing is
sampled and no candidate list is cut other than to the k rows asked for.

Defined results: rows with a NULL label, a NULL vector or a NULL or non-finite
component take no part.  Quantised components are held to +-2^24 (vectors
beyond +-65,536), so that scores stay exact.  Vectors of different lengths are
multiplied over the components both have.  A NULL vec_id is never an anchor,
keeps its label and comes last among ties.  Each row is a row of its own, also
where rows repeat: a copy of an anchor can be its positive, and answers as an
anchor too.  An anchor without positives, or a window without rows, gives no
row; so does an empty table.  Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import text as T

BLOCK_ROWS = 8192
CHUNK_ANCHORS = 512
FIRST_STEP = 32
QUANTUM = 256
LIMIT = 1 << 24
_LAST = np.iinfo(np.int64).max


def quantised(vectors: DataFrame, vec_id: str, label: str, vector: str, relabel: Column | None = None) -> DataFrame:
    """_row, vec_id, label, q of the rows that take part; stored, so _row stays."""
    x = F.transform(F.col(vector), lambda v: v.cast("double"))
    usable = vectors.where(F.col(label).isNotNull() & F.col(vector).isNotNull()).where(
        F.forall(x, lambda v: F.coalesce((F.abs(v) < float("inf")) & ~F.isnan(v), F.lit(False))))
    whole = F.transform(x, lambda v: F.floor(F.greatest(F.least(v * QUANTUM, F.lit(float(LIMIT))), F.lit(float(-LIMIT)))).cast("int"))
    rows = usable.select(F.col(vec_id).cast("bigint").alias("vec_id"),
                         (F.col(label) if relabel is None else relabel).cast("bigint").alias("label"), whole.alias("q"))
    return T.stored(rows.withColumn("_row", F.monotonically_increasing_id()), "negatives-rows")


def matrix(column: pa.ChunkedArray) -> np.ndarray:
    """Rows of a list column as one matrix, short vectors filled with zeros."""
    flat = column.combine_chunks()
    values, ends = flat.flatten().to_numpy(zero_copy_only=False).astype(np.int64), np.cumsum(flat.value_lengths().to_numpy())
    lengths = np.diff(np.concatenate(([0], ends)))
    width = int(lengths.max(initial=0))
    if len(lengths) and (lengths == width).all():
        return values.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width), np.int64)
    out[np.repeat(np.arange(len(lengths)), lengths), np.arange(len(values)) - np.repeat(ends - lengths, lengths)] = values
    return out


class Lists:
    """The rows of a block with one sorted list per dimension."""

    def __init__(self, q: np.ndarray, ids: np.ndarray, labels: np.ndarray):
        self.q, self.ids, self.labels = q, ids, labels
        self.order = np.argsort(q, axis=0, kind="stable").astype(np.int32)
        self.most = int(np.abs(q).max(initial=0))
        self.real = q.astype(np.float64)
        self.read = 0                      # rows scored, for tests

    def scores(self, at: np.ndarray, anchor: np.ndarray) -> np.ndarray:
        if self.most * int(np.abs(anchor).max(initial=0)) * max(1, len(anchor)) < 1 << 52:
            return (self.real[at] @ anchor.astype(np.float64)).astype(np.int64)    # exact: whole numbers below 2^53
        return self.q[at] @ anchor

    def search(self, anchor: np.ndarray, allowed: np.ndarray, windows: list[tuple[int, int]], k: int) -> list[np.ndarray]:
        """Rows of each window (low, high), at most k, best first."""
        m = len(self.q)
        width = min(len(anchor), self.q.shape[1])
        anchor = np.concatenate((anchor[:width], np.zeros(self.q.shape[1] - width, np.int64)))
        dims = np.flatnonzero(anchor)
        up = anchor[dims] > 0
        weight = anchor[dims]
        seen = np.zeros(m, bool)
        found = [np.empty(0, np.int64) for _ in windows]
        best = [np.empty(0, np.int64) for _ in windows]
        depth, step = 0, FIRST_STEP
        while depth < m:
            to = min(m, depth + step) if len(dims) else m
            if len(dims):
                top = self.order[m - to:m - depth][::-1][:, dims[up]]
                low = self.order[depth:to][:, dims[~up]]
                met = np.concatenate((top.ravel(), low.ravel()))
                new = np.zeros(m, bool)
                new[met] = True
                new &= ~seen
                seen |= new
                new = np.flatnonzero(new & allowed)
            else:                                        # a zero anchor scores 0 everywhere
                new = np.flatnonzero(allowed)
            depth, step = to, 2 * step
            self.read += len(new)
            s = self.scores(new, anchor)
            if len(dims):
                last = self.order[m - depth, dims[up]], self.order[depth - 1, dims[~up]]
                threshold = int(self.q[last[0], dims[up]] @ weight[up]) + int(self.q[last[1], dims[~up]] @ weight[~up])
            done = True
            for i, (lo, hi) in enumerate(windows):
                fit = (s <= hi) & (s >= (best[i][-1] if len(best[i]) == k else lo))
                if fit.any():
                    rows, sc = np.concatenate((found[i], new[fit])), np.concatenate((best[i], s[fit]))
                    first = np.lexsort((rows, self.ids[rows], -sc))[:k]
                    found[i], best[i] = rows[first], sc[first]
                if len(dims):
                    done &= threshold < (int(best[i][-1]) if len(best[i]) == k else lo)
            if done:
                break
        return found


def _block(t: pa.Table) -> Lists:
    ids = t.column("vec_id").fill_null(_LAST).to_numpy()
    order = np.lexsort((t.column("_row").to_numpy(), ids))         # ties fall to the smaller id, then row
    out = Lists(matrix(t.column("q"))[order], ids[order], t.column("label").to_numpy()[order])
    out.rows = t.column("_row").to_numpy()[order]
    return out


def _positives(chunk: pa.Table, block: pa.Table, k: int) -> pa.Table:
    out = {"a": [], "p": [], "p_id": [], "p_score": []}
    if chunk.num_rows and block.num_rows:
        lists, vectors = _block(block), matrix(chunk.column("q"))
        for row, anchor in zip(chunk.column("_row").to_pylist(), vectors):
            at, = lists.search(anchor, lists.rows != row, [(-_LAST, _LAST)], k)
            pad = np.zeros(lists.q.shape[1], np.int64)
            pad[:min(len(anchor), len(pad))] = anchor[:len(pad)]
            out["a"] += [row] * len(at)
            out["p"] += lists.rows[at].tolist()
            out["p_id"] += [None if x == _LAST else x for x in lists.ids[at].tolist()]
            out["p_score"] += lists.scores(at, pad).tolist()
    return pa.table({c: pa.array(v, pa.int64()) for c, v in out.items()})


def _negatives(chunk: pa.Table, block: pa.Table, k: int, low: int, high: int) -> pa.Table:
    out = {"a": [], "p": [], "n": [], "n_id": [], "n_score": []}
    if chunk.num_rows and block.num_rows:
        lists, vectors = _block(block), matrix(chunk.column("q"))
        for row, label, ps, scores, anchor in zip(*(chunk.column(c).to_pylist() for c in ("_row", "label", "ps", "scores")), vectors):
            windows = [(-(-low * s // 100), high * s // 100) for s in scores]
            open_ = [i for i, (lo, hi) in enumerate(windows) if lo <= hi]
            if not open_:
                continue
            pad = np.zeros(lists.q.shape[1], np.int64)
            pad[:min(len(anchor), len(pad))] = anchor[:len(pad)]
            for i, at in zip(open_, lists.search(anchor, lists.labels != label, [windows[i] for i in open_], k)):
                out["a"] += [row] * len(at)
                out["p"] += [ps[i]] * len(at)
                out["n"] += lists.rows[at].tolist()
                out["n_id"] += [None if x == _LAST else x for x in lists.ids[at].tolist()]
                out["n_score"] += lists.scores(at, pad).tolist()
    return pa.table({c: pa.array(v, pa.int64()) for c, v in out.items()})


def _meet(rows: DataFrame, anchors: DataFrame, key: str | None, task, schema: str) -> DataFrame:
    """``task`` over every chunk of anchors and block of rows (of one value of ``key``, if given)."""
    by = [*([key] if key else []), "_block", "_chunk"]

    parts = {"_blocks": (rows, BLOCK_ROWS), "_chunks": (anchors, CHUNK_ANCHORS)}
    if key is None:
        n = {c: max(1, -(-df.count() // size)) for c, (df, size) in parts.items()}
        blocks, chunks = F.lit(n["_blocks"]).cast("int"), F.lit(n["_chunks"]).cast("int")
    else:
        dealt = None                                               # one row per key that both sides have
        for c, (df, size) in parts.items():
            n = df.groupBy(F.col(key).alias("_key" + c)).agg(F.ceil(F.count(F.lit(1)) / size).cast("int").alias(c))
            dealt = n if dealt is None else dealt.join(n, F.col("_key_blocks") == F.col("_key" + c))
        dealt = T.stored(dealt.select("_key_blocks", "_blocks", "_chunks"), "negatives-blocks")
        blocks, chunks = F.col("_blocks"), F.col("_chunks")
    sides = []
    for df, own, count, other, others in ((anchors, "_chunk", chunks, "_block", blocks), (rows, "_block", blocks, "_chunk", chunks)):
        known = df if key is None else df.join(dealt, F.col(key) == F.col("_key_blocks"))
        sides.append(known.withColumn(own, F.pmod(F.xxhash64("_row"), count).cast("int"))
                          .withColumn(other, F.explode(F.sequence(F.lit(0), others - 1)))
                          .select(*[c for c in df.columns if c != key], *by))
    left, right = sides
    return left.groupBy(*by).cogroup(right.groupBy(*by)).applyInArrow(task, schema)


def mine(vectors: DataFrame, anchor: Column, relabel: Column | None = None, vec_id: str = "vec_id", label: str = "label",
         vector: str = "embedding", k: int = 5, low: int = 80, high: int = 100) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``anchor`` chooses the anchors by vec_id, ``relabel`` gives the label to
    use.  A negative of a positive with score s has a score n with
    low * s <= 100 * n <= high * s."""
    T.prepare(vectors.sparkSession)
    rows = quantised(vectors, vec_id, label, vector, relabel)
    anchors = T.stored(rows.where(F.coalesce(anchor, F.lit(False))), "negatives-anchors")

    near = _meet(rows, anchors, "label", lambda c, b: _positives(c, b, k), "a bigint, p bigint, p_id bigint, p_score bigint")
    by_score = Window.partitionBy("a").orderBy(F.desc("p_score"), F.asc_nulls_last("p_id"), "p")
    positives = T.stored(near.withColumn("_at", F.row_number().over(by_score)).where(F.col("_at") <= k).drop("_at"),
                         "negatives-positives")

    asked = positives.groupBy(F.col("a").alias("_a")).agg(F.collect_list(F.struct("p", "p_score")).alias("_s"))
    asked = asked.select("_a", F.col("_s.p").alias("ps"), F.col("_s.p_score").alias("scores"))
    queries = T.stored(anchors.join(asked, F.col("_row") == F.col("_a")).select("_row", "label", "q", "ps", "scores"),
                       "negatives-queries")
    far = _meet(rows, queries, None, lambda c, b: _negatives(c, b, k, low, high),
                "a bigint, p bigint, n bigint, n_id bigint, n_score bigint")
    in_window = Window.partitionBy("a", "p").orderBy(F.desc("n_score"), F.asc_nulls_last("n_id"), "n")
    chosen = far.withColumn("rank", F.row_number().over(in_window)).where(F.col("rank") <= k)

    ids = anchors.select(F.col("_row").alias("a"), F.col("vec_id").alias("anchor_id"))
    return chosen.join(positives, ["a", "p"]).join(ids, "a").select(
        "anchor_id", F.col("p_id").alias("positive_id"), F.col("rank").cast("int").alias("rank"),
        F.col("n_id").alias("negative_id"), F.col("p_score").alias("positive_score"), F.col("n_score").alias("negative_score"))
