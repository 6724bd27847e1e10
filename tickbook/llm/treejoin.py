"""N-gram Jaccard join with signature trees.

Documents whose distinct word shingles have a Jaccard similarity of at least
``percent`` are linked; the result is the class each document reaches by links.

1. Equal texts become one node.  A node keeps the size of its shingle set, a
   bitmap with one bit per shingle (2 to 4 bits a shingle, a power of two, so
   that a wider bitmap folds onto a narrower one) and its first shingles.
2. Two linked sets share one of their first n - ceil(t * n) + 1 shingles in
   any order that all sets use.  The order is by hash, with the shingles that
   begin many sets put last, so that a passage in a third of all documents
   brings no group together.  Each shingle that several nodes begin with
   makes a group; groups with the same members count once.
3. Every group gets a signature tree: its members, ordered by their smallest
   shingle, are the leaves; a node holds the OR of its children's bitmaps, the
   range of their sizes, the most shingles that share a bit with another one
   of their set, and their class if they have one only.  Groups of more than
   ``BLOCK`` members are cut into blocks with a tree each, and a task takes a
   pair of blocks.
4. Trees are traversed in pairs (a tree with itself, too), level by level.  A
   pair of nodes can hold no link, and is dropped with all below it, if its
   size ranges are too far apart, or if the greatest overlap its bitmaps allow
   (common bits plus shared bits of the smaller side) is below what its
   smallest sizes need.  These bounds are never below the true overlap, so no
   link is lost.
5. Two rounds.  The first keeps each member's best partner in each group;
   these pairs are confirmed on the full sets and give classes.  In the
   second, which takes only members that had a partner in their group, node
   pairs inside one class are dropped as well.  It first names the members that
   have a possible partner in another class; these get bitmaps of four times
   the bits, trees are traversed again, and all pairs left that were not
   confirmed before are confirmed.  So a group of copies costs each
   member a few pairs, and no link between different classes is missed.

Broadcast: the shingles put last (at most ``MOST_HOT``; if there are more,
those that begin the most sets), and group keys or node keys where their
counted number is at most ``MOST_KEYS``; otherwise Spark joins them.

Defined results: a NULL, empty or blank text has no shingles and is its own
class; a text of fewer words than a shingle is one shingle.  A NULL doc_id
links like any other, but never names a class.  Rows that repeat come back as
often as they come; rows that share a doc_id but not a text are documents of
their own.  An empty table gives an empty result.  Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as T
from .dedup import components, confirm, shingle_sets

HOT = 64                   # sets that begin with a shingle before it is put last
MOST_HOT = 1 << 17
MOST_KEYS = 1 << 20
BLOCK = 1024               # members of a group in one tree
FAN = 8                    # children of a tree node
SEGMENT_ROWS = 4096        # members a task traverses at once
BITS, WIDE_BITS = 2, 8       # bits a shingle, at least (twice as many at most)
LEAST_BITS, MOST_BITS = 64, 1 << 16
_U = np.uint64


def bitmap(shingles: np.ndarray, each: int = BITS) -> bytes:
    """One bit per shingle, in a power of two of at least ``each`` bits a shingle."""
    bits = min(max(LEAST_BITS, 1 << int(each * len(shingles) - 1).bit_length()), MOST_BITS)
    on = np.zeros(bits, bool)
    on[(T.mix(shingles) & _U(bits - 1)).astype(np.int64)] = True
    return np.packbits(on, bitorder="little").tobytes()


def begins(n: int, percent: int) -> int:
    """Shingles of a set of n of which every linked set has one among its own first ones."""
    return n - (percent * n + 99) // 100 + 1 if n else 0


def _first(shingles: np.ndarray, size: int, hot: np.ndarray, percent: int) -> np.ndarray | None:
    """The first shingles with the hot ones last, from the ``shingles`` at hand of a set of
    ``size`` (in order of hash); None if they do not suffice."""
    want = begins(size, percent)
    at = np.minimum(np.searchsorted(hot, shingles), max(len(hot) - 1, 0))
    late = hot[at] == shingles if len(hot) else np.zeros(len(shingles), bool)
    early = shingles[~late]
    if len(early) >= want:
        return early[:want]
    return np.concatenate((early, shingles[late]))[:want] if len(shingles) == size else None


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text")).withColumns(
        {"k1": F.xxhash64("text"), "k2": F.xxhash64(F.lit("second key"), "text")})


def nodes_of(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """cid, k1, k2, id (smallest doc_id), n, first (smallest shingle), begin, sig: one row per text; stored."""

    def run(batches):
        for b in batches:
            n, first, begin, sig = [], [], [], []
            for raw in T.utf8(b.column("text")):
                x = T.shingles(T.word_hashes(raw.lower()), words)
                p = begins(len(x), percent)
                n.append(len(x))
                first.append(int(x[0].view(np.int64)) if len(x) else 0)
                begin.append(x[:p + 16 + p // 4].view(np.int64))
                sig.append(bitmap(x) if len(x) else b"")
            yield pa.RecordBatch.from_arrays(
                [b.column("k1"), b.column("k2"), b.column("id"), pa.array(n, pa.int64()), pa.array(first, pa.int64()),
                 pa.array(begin, pa.list_(pa.int64())), pa.array(sig, pa.binary())],
                names=["k1", "k2", "id", "n", "first", "begin", "sig"])

    texts = _keyed(docs).groupBy("k1", "k2").agg(F.min("doc_id").alias("id"), F.first("text").alias("text"))
    rows = texts.mapInArrow(run, "k1 bigint, k2 bigint, id bigint, n bigint, first bigint, begin array<bigint>, sig binary")
    return T.stored(rows.withColumn("cid", F.monotonically_increasing_id()), "tree-nodes")


def _hot_shingles(nodes: DataFrame, percent: int) -> np.ndarray:
    """Sorted shingles that begin more than HOT sets, at most MOST_HOT of them."""
    p = F.expr(f"CAST(n - ({percent} * n + 99) DIV 100 + 1 AS INT)")
    counts = (nodes.where("n > 0").select(F.explode(F.slice("begin", F.lit(1), p)).alias("token")).groupBy("token").count()
                   .where(F.col("count") > HOT))
    top = counts.orderBy(F.desc("count"), "token").limit(MOST_HOT).select("token").toArrow()
    return np.sort(top.column(0).to_numpy().view(np.uint64))


def _texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """cid, text of the ``wanted`` (cid, k1, k2)."""
    wanted = T.stored(wanted.select(F.col("cid").alias("id"), F.col("k1").alias("_k1"), F.col("k2").alias("_k2")), "tree-wanted")
    keys = F.broadcast(wanted) if wanted.count() <= MOST_KEYS else wanted
    return (_keyed(docs).join(keys, (F.col("k1") == F.col("_k1")) & (F.col("k2") == F.col("_k2")))
                        .groupBy("id").agg(F.first("text").alias("text")))


def groups_of(docs: DataFrame, nodes: DataFrame, words: int, percent: int) -> DataFrame:
    """gid, members, cid: the groups of nodes that begin with a common shingle; stored."""
    hot = _hot_shingles(nodes, percent)

    def stored_begin(batches):
        for b in batches:
            values = b.column("begin").flatten().to_numpy().view(np.uint64)
            ends = np.cumsum(b.column("begin").value_lengths().to_numpy())[:-1]
            own = [_first(x, n, hot, percent) for x, n in zip(np.split(values, ends), b.column("n").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [b.column("cid"), pa.array([None if x is None else x.view(np.int64) for x in own], pa.list_(pa.int64()))],
                names=["cid", "tokens"])

    def whole_text(batches):
        for b in batches:
            own = []
            for raw in T.utf8(b.column("text")):
                x = T.shingles(T.word_hashes(raw.lower()), words)
                own.append(_first(x, len(x), hot, percent).view(np.int64))
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(own, pa.list_(pa.int64()))], names=["cid", "tokens"])

    schema = "cid bigint, tokens array<bigint>"
    chosen = nodes.where("n > 0").select("cid", "n", "begin").mapInArrow(stored_begin, schema)
    short = chosen.where("tokens IS NULL").select("cid").join(nodes.select("cid", "k1", "k2"), "cid")
    again = T.stored(_texts(docs, short).mapInArrow(whole_text, schema), "tree-short")
    posts = chosen.where("tokens IS NOT NULL").union(again).select(F.explode("tokens").alias("token"), "cid")

    lists = (posts.groupBy("token").agg(F.count(F.lit(1)).alias("members"), F.min("cid").alias("lo"), F.max("cid").alias("hi"),
                                        F.bit_xor(F.xxhash64("cid")).alias("mark")).where("members > 1")
                  .groupBy("members", "lo", "hi", "mark").agg(F.min("token").alias("gid")))
    lists = T.stored(lists, "tree-lists")
    pairs = lists.where("members = 2").select("gid", "members", F.explode(F.array("lo", "hi")).alias("cid"))
    larger = lists.where("members > 2").select("gid", "members")
    keys = F.broadcast(larger) if larger.count() <= MOST_KEYS else larger
    rest = posts.join(keys, F.col("token") == F.col("gid")).select("gid", "members", "cid")
    return T.stored(pairs.union(rest), "tree-groups")


def _wide_bitmaps(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """cid, sig: the wide bitmaps of the ``wanted`` nodes."""

    def run(batches):
        for b in batches:
            sig = [bitmap(T.shingles(T.word_hashes(raw.lower()), words), WIDE_BITS) for raw in T.utf8(b.column("text"))]
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(sig, pa.binary())], names=["cid", "sig"])

    return _texts(docs, wanted).mapInArrow(run, "cid bigint, sig binary")


class Forest:
    """Signature trees over the members of several groups; no node spans two groups.

    Level 0 holds the members, in order of (group, locality)."""

    def __init__(self, at: np.ndarray, group: np.ndarray, local: np.ndarray, sig: np.ndarray, n: np.ndarray, comp: np.ndarray):
        order = np.lexsort((local, group))
        self.at, group, sig, n, comp = at[order], group[order], sig[order], n[order], comp[order]
        self.levels = []
        slack = n - np.bitwise_count(sig).sum(axis=1).astype(np.int64)
        level = {"group": group, "sig": sig, "lo": n, "hi": n, "slack": slack, "comp": comp}
        while True:
            self.levels.append(level)
            group = level["group"]
            starts = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1]))) if len(group) else np.empty(0, np.int64)
            if len(starts) == len(group):
                break
            place = np.arange(len(group)) - np.repeat(starts, np.diff(np.concatenate((starts, [len(group)]))))
            heads = np.flatnonzero(place % FAN == 0)
            low, high = (f.reduceat(level["comp"], heads) for f in (np.minimum, np.maximum))
            level["first"] = heads                       # of the level above: its children start here
            level["children"] = np.diff(np.concatenate((heads, [len(group)])))
            level = {"group": group[heads], "sig": np.bitwise_or.reduceat(level["sig"], heads, axis=0),
                     "lo": np.minimum.reduceat(level["lo"], heads), "hi": np.maximum.reduceat(level["hi"], heads),
                     "slack": np.maximum.reduceat(level["slack"], heads),
                     "comp": np.where((low == high) & (low >= 0), low, -1)}

    def level(self, i: int) -> dict:
        """Level i; above its own top a forest repeats its roots."""
        return self.levels[min(i, len(self.levels) - 1)]

    def below(self, i: int, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First child on level i - 1, and the number of children, of nodes of level i."""
        if i >= len(self.levels):
            return nodes, np.ones(len(nodes), np.int64)
        under = self.levels[i - 1]
        return under["first"][nodes], under["children"][nodes]


def traverse(a: Forest, b: Forest, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of members (places in a and b) that may be linked, and the greatest overlap
    their bitmaps allow, over all groups that both forests have."""
    own = a is b
    top = max(len(a.levels), len(b.levels)) - 1
    x, y = a.level(top), b.level(top)
    _, i, j = np.intersect1d(x["group"], y["group"], assume_unique=True, return_indices=True)
    while True:
        keep, most = _possible(x, y, i, j, percent, own and top == 0)
        i, j = i[keep], j[keep]
        if top == 0:
            return i, j, most[keep]
        (fi, ci), (fj, cj) = a.below(top, i), b.below(top, j)
        each = ci * cj
        k = np.arange(int(each.sum())) - np.repeat(np.cumsum(each) - each, each)
        wide = np.repeat(cj, each)
        i, j = np.repeat(fi, each) + k // wide, np.repeat(fj, each) + k % wide
        if own:
            half = i <= j
            i, j = i[half], j[half]
        top -= 1
        x, y = a.level(top), b.level(top)


def _possible(x: dict, y: dict, i: np.ndarray, j: np.ndarray, percent: int, apart: bool) -> tuple[np.ndarray, np.ndarray]:
    """Which node pairs may hold a link, and the greatest overlap of each."""
    keep = (100 * x["hi"][i] >= percent * y["lo"][j]) & (100 * y["hi"][j] >= percent * x["lo"][i])
    keep &= (x["comp"][i] != y["comp"][j]) | (x["comp"][i] < 0)
    if apart:
        keep &= i < j
    most = np.zeros(len(i), np.int64)
    todo = np.flatnonzero(keep)
    step = max(1, (1 << 21) // x["sig"].shape[1])
    for s in range(0, len(todo), step):
        t = todo[s:s + step]
        most[t] = np.bitwise_count(x["sig"][i[t]] & y["sig"][j[t]]).sum(axis=1, dtype=np.int64)
    most = np.minimum(most + np.minimum(x["slack"][i], y["slack"][j]), np.minimum(x["hi"][i], y["hi"][j]))
    return keep & ((100 + percent) * most >= percent * (x["lo"][i] + y["lo"][j])), most


def _folded(sig: list[bytes], bits: int) -> np.ndarray:
    """Bitmaps of one width folded to ``bits``."""
    words = np.frombuffer(b"".join(sig), np.uint64).reshape(len(sig), -1, bits // 64)
    return np.bitwise_or.reduce(words, axis=1)


def candidates(rows: dict, percent: int, best_only: bool) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (places in ``rows``) of the members of whole segments that may be linked.

    ``rows``: seg (number of the segment), side, whole (the segment is one block
    with itself), cid, n, first, comp, sig.  With ``best_only`` each member's best partner."""
    width = np.array([8 * len(s) for s in rows["sig"]])

    def forest(mask: np.ndarray, bits: int) -> Forest | None:
        at = np.flatnonzero(mask)
        if not len(at):
            return None
        sig = _folded([rows["sig"][k] for k in at], bits)
        return Forest(at, rows["seg"][at], rows["first"][at], sig, rows["n"][at], rows["comp"][at])

    left, right, most = [], [], []

    def meet(p: Forest | None, q: Forest | None) -> None:
        if p is not None and q is not None:
            i, j, m = traverse(p, q, percent)
            left.append(p.at[i])
            right.append(q.at[j])
            most.append(m)

    whole, side = rows["whole"], rows["side"]
    for bits in np.unique(width).tolist():
        same, twice = width == bits, width == 2 * bits      # sets of linked documents differ by less than a factor of two
        f = forest(whole & same, bits)
        meet(f, f)
        meet(f, forest(whole & twice, bits))
        if not whole.all():
            l_same, r_same = forest(~whole & same & (side == 0), bits), forest(~whole & same & (side == 1), bits)
            meet(l_same, r_same)
            meet(l_same, forest(~whole & twice & (side == 1), bits))
            meet(r_same, forest(~whole & twice & (side == 0), bits))
    if not left:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    i, j, m = np.concatenate(left), np.concatenate(right), np.concatenate(most)
    if best_only and len(i):
        share = m / (rows["n"][i] + rows["n"][j])
        ends, other = np.concatenate((i, j)), np.concatenate((j, i))
        order = np.lexsort((rows["cid"][other], -np.concatenate((share, share)), ends))
        best = order[np.concatenate(([True], ends[order][1:] != ends[order][:-1]))]
        i, j = ends[best], other[best]
    return i, j


_KEYS = ("gid", "p", "q")


def tree_pairs(members: DataFrame, percent: int, give: str) -> DataFrame:
    """What the trees leave of the groups' members, without repeats.

    ``members``: gid, members, cid, n, first, sig, comp (-1: none yet).  ``give``: 'pairs' (a, b); 'best', each
    member's best pair in each group, as (gid, a, b); 'ends', (gid, cid) of the members of any pair."""
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    dealt = (members.withColumn("_blocks", blocks).withColumn("_i", F.pmod(F.xxhash64("cid"), F.col("_blocks")).cast("int"))
                    .withColumn("_j", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
                    .select("gid", F.least("_i", "_j").alias("p"), F.greatest("_i", "_j").alias("q"),
                            (F.col("_i") > F.col("_j")).cast("int").alias("side"), "cid", "n", "first", "comp", "sig"))

    names = {"pairs": ["a", "b"], "best": ["gid", "a", "b"], "ends": ["gid", "cid"]}[give]

    def run(batches):
        held: list = []
        count = 0

        def pairs(t: pa.Table) -> pa.RecordBatch:
            keys = [t.column(c).to_numpy() for c in _KEYS]
            new = np.concatenate(([True], np.any([k[1:] != k[:-1] for k in keys], axis=0)))
            rows = {c: t.column(c).to_numpy() for c in ("side", "cid", "n", "first", "comp")}
            rows |= {"seg": np.cumsum(new), "whole": keys[1] == keys[2], "sig": t.column("sig").to_pylist()}
            i, j = candidates(rows, percent, give == "best")
            if give == "ends":
                ends = np.unique(np.concatenate((i, j)))
                out = keys[0][ends], rows["cid"][ends]
            else:
                a, b = rows["cid"][i], rows["cid"][j]
                out = np.minimum(a, b), np.maximum(a, b)
                # a pair once for all groups at hand, or once in each
                out = np.unique(np.stack((keys[0][i], *out) if give == "best" else out), axis=1)
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], names=names)

        for b in batches:
            held.append(b)
            count += b.num_rows
            if count >= SEGMENT_ROWS:
                t = pa.Table.from_batches(held)
                keys = [t.column(c).to_numpy() for c in _KEYS]
                cuts = np.flatnonzero(np.any([k[1:] != k[:-1] for k in keys], axis=0))
                cut = int(cuts[-1]) + 1 if len(cuts) else 0      # the last segment may go on in the next batch
                if cut:
                    yield pairs(t.slice(0, cut))
                held, count = t.slice(cut).to_batches(), t.num_rows - cut
        if count:
            yield pairs(pa.Table.from_batches(held))

    return dealt.repartition(*_KEYS).sortWithinPartitions(*_KEYS).mapInArrow(
        run, ", ".join(f"{c} bigint" for c in names)).distinct()


def similar_documents(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of ``docs`` (see the module text).

    Texts are ASCII lower-cased and split at ASCII white space.  Two documents
    are linked if 100 * |intersection| >= percent * |union| of their sets."""
    T.prepare(docs.sparkSession)
    nodes = nodes_of(docs, words, percent)
    groups = groups_of(docs, nodes, words, percent)
    marks = nodes.select("cid", "n", "first", "sig")

    def confirmed(pairs: DataFrame, label: str) -> DataFrame:
        ends = pairs.select(F.explode(F.array("a", "b")).alias("cid")).distinct()
        wanted = ends.join(nodes.select("cid", "k1", "k2"), "cid")
        sets = T.stored(shingle_sets(_texts(docs, wanted), words), f"tree-sets{label}")
        return T.stored(confirm(pairs, sets, percent), f"tree-links{label}")

    best = T.stored(tree_pairs(groups.join(marks, "cid").withColumn("comp", F.lit(-1).cast("bigint")), percent, "best"), "tree-best")
    first = T.stored(best.select("a", "b").distinct(), "tree-pairs1")
    links = confirmed(first, "1")
    comp = components(links, "tree-cc")

    paired = best.select("gid", F.explode(F.array("a", "b")).alias("cid")).distinct()
    named = T.stored(groups.where("members > 2").join(paired, ["gid", "cid"], "left_semi").join(comp.withColumnRenamed("id", "cid"), "cid", "left")
                           .select("gid", "members", "cid", F.coalesce("comp", "cid").alias("comp")), "tree-named")
    mixed = named.groupBy("gid").agg(F.min("comp").alias("_lo"), F.max("comp").alias("_hi")).where("_lo < _hi").select("gid")
    close = T.stored(tree_pairs(named.join(mixed, "gid").join(marks, "cid"), percent, "ends"), "tree-close")
    wide = T.stored(_wide_bitmaps(docs, close.select("cid").distinct().join(nodes, "cid"), words), "tree-wide")
    second = tree_pairs(named.join(close, ["gid", "cid"]).join(marks.drop("sig"), "cid").join(wide, "cid"), percent, "pairs")
    second = T.stored(second.join(first, ["a", "b"], "left_anti"), "tree-pairs2")
    more = confirmed(second, "2")
    if not more.isEmpty():
        comp = components(links.union(more), "tree-cc2")

    joined = nodes.select("cid", "k1", "k2", "id", "n").join(comp.withColumnRenamed("id", "cid"), "cid", "left") \
                  .withColumn("comp", F.coalesce("comp", "cid"))
    names = joined.groupBy("comp").agg(F.min("id").alias("name"))
    known = T.stored(joined.join(names, "comp").select(F.col("k1").alias("_k1"), F.col("k2").alias("_k2"), "n", "name"), "tree-named-nodes")
    return (_keyed(docs).select("doc_id", "k1", "k2").join(known, (F.col("k1") == F.col("_k1")) & (F.col("k2") == F.col("_k2")))
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("name")).alias("component_id")))
