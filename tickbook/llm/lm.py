"""Language-model scores of documents.

Base: log10 probabilities of single tokens (add-1/2 counts).  Model: a
log-bilinear neural model over symbols, trained in numpy on the exact
log-likelihood.

* Symbols are the ``WORDS * N^(1/3)`` most frequent words of the N training
  tokens, the text's end, and ``TAIL`` unknown classes: a word without a symbol
  of its own belongs to the class of a hash of its last three bytes (which
  tells languages and junk apart), and its probability is that of the class
  times its add-1/2 share of the class.
* Every symbol has a vector for each place as context (one and two tokens
  back), a vector as the next token and a bias.  The context vectors' sum
  predicts the next token's.
* Symbols are dealt into about as many groups as a group has symbols, by
  splitting them again and again along the main direction of whom they stand
  next to.  The model predicts the group (groups have vectors, too), and the
  symbol within its group, so that exact normalisation takes two matrix products
  with about sqrt(symbols) columns per token, in batches, and the
  probabilities of all tokens sum to one.

Vocabulary, vectors and training steps grow with the corpus.  Token counts, class
masses, unigram biases, groups and vectors come from all training tokens: every
(two tokens, next token) triple of every training text is learned from, once in a
large corpus and up to ``EPOCHS`` times in a small one (until there were ``EXAMPLES``
per symbol and epoch).  Training runs in the tasks: in each of ``ROUNDS`` Spark jobs
every task goes through its share of the triples (a part of ``TASK`` or more) from
the vectors that the round before left, and the changes of its vectors are averaged,
weighted by how often it met the symbol.  A step takes the same products by groups as
a score, forth and back, and as many triples (two for each symbol or more) that moving all
vectors costs little beside them.  The driver holds the vectors, and those of one task
at a time; the symbols stay in the scratch folder, in the order of the texts, as
arrays of ``ROW`` that the tasks read without a row per token.

Tokens that make up at least ``HEAVY`` of the corpus are at most 1 / HEAVY and
go to the tasks as a broadcast, with the vectors (S * 100 numbers for S symbols);
the other tokens are joined by their hash, and none of those can be frequent.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import text as T

HEAVY = 1e-6
WORDS, LEAST = 10, 5                # own symbols: WORDS * N^(1/3) words that occur LEAST times or more
TAIL = 135                          # unknown classes, by hashed endings
DIM, EXAMPLES, EPOCHS, BATCH = 32, 256, 4, 4096
SLICE, ROWS = 1 << 13, 1 << 10      # tokens normalised at once, vectors moved at once: few enough for the processor's cache
ROUNDS, TASK, CHUNK = 4, 1 << 22, 1 << 19     # averages of the vectors; triples of a task; triples put in a random order at once
ROW = 1 << 14                       # symbols of a stored array; pairs of neighbours taken together


@dataclass
class Counts:
    """Token statistics of the training corpus, and the model."""

    tokens: int                     # N, ends included
    types: int                      # V, the end included
    texts: int                      # the end's count
    heavy: np.ndarray               # sorted hashes of tokens with at least HEAVY of the corpus
    times: np.ndarray               # their counts
    head: np.ndarray                # sorted hashes of the words with a symbol of their own
    head_symbol: np.ndarray
    unknown: np.ndarray             # symbol of each unknown class
    end: int                        # symbol of the end
    mass: np.ndarray                # summed count + 1/2 of each unknown class, an unseen token included
    model: Model | None = None

    @property
    def symbols(self) -> int:
        return len(self.head) + TAIL + 1


@dataclass
class Model:
    """Vectors and biases; symbols of a group are neighbours: group g has first[g] .. first[g + 1]."""

    first: np.ndarray
    near: np.ndarray                # [symbol] as the token before
    far: np.ndarray                 # [symbol] two tokens before
    group: np.ndarray
    group_bias: np.ndarray
    out: np.ndarray                 # [symbol] as the next token
    bias: np.ndarray

    def log10(self, symbol: np.ndarray, before: np.ndarray, before2: np.ndarray) -> np.ndarray:
        """Exact log10 probability of each symbol after its two predecessors."""
        result = np.empty(len(symbol))
        group, out = (np.column_stack((x, b)) for x, b in ((self.group, self.group_bias), (self.out, self.bias)))
        for a in range(0, len(symbol), SLICE):
            s = symbol[a:a + SLICE]
            h = np.ones((len(s), DIM + 1), np.float32)          # the last column takes the biases
            np.add(self.near[before[a:a + SLICE]], self.far[before2[a:a + SLICE]], out=h[:, :DIM])
            of = np.searchsorted(self.first, s, side="right") - 1
            order = _by_id(of, len(self.first))                 # one product per group
            s, of, h = s[order], of[order], h[order]
            logs = _log_share(h @ group.T, of)
            cuts = np.flatnonzero(np.diff(of, prepend=-1)).tolist()
            for i, z in zip(cuts, [*cuts[1:], len(s)]):
                lo, hi = self.first[of[i]], self.first[of[i] + 1]
                logs[i:z] += _log_share(h[i:z] @ out[lo:hi].T, s[i:z] - lo)
            result[a + order] = logs
        return result / math.log(10)


def _log_share(scores: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Log of softmax(scores) at one place per row; ``scores`` is overwritten."""
    own = scores[np.arange(len(at)), at].astype(float)
    high = float(scores.max(initial=0.0))
    if high > 60:                                               # far from what single precision can hold
        scores -= high
        own -= high
    return own - np.log(_row_sums(np.exp(scores, out=scores)))


def _row_sums(x: np.ndarray) -> np.ndarray:
    """Sums of the rows, above 0 (a product is faster than ``sum`` over short rows)."""
    return np.maximum(x @ np.ones(x.shape[1], np.float32), np.float32(1e-37))


def _rest(scores: np.ndarray, at: np.ndarray) -> np.ndarray:
    """What softmax(scores) lacks of certainty at one place per row; ``scores`` is overwritten."""
    if float(scores.max(initial=0.0)) > 60:
        scores -= scores.max(axis=1, keepdims=True)
    np.exp(scores, out=scores)
    scores *= (-1 / _row_sums(scores))[:, None]
    scores[np.arange(len(at)), at] += 1
    return scores


def _by_id(ids: np.ndarray, n: int) -> np.ndarray:
    """The stable order of ids below n (numpy sorts 16 bits by counting)."""
    return np.argsort(ids.astype(np.uint16) if n <= 1 << 16 else ids, kind="stable")


def words_and_endings(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased words and their ending classes."""
    words, ends = [], []
    for piece in T._blocks(raw.lower(), T.SPACES):
        buf = np.frombuffer(piece, np.uint8)
        s, e = T.runs(~T.SPACES[buf])
        if len(s):
            words.append(T.word_hashes(piece) if len(s) == 1 else T.hash_runs(buf, s, e))
            ends.append(T.hash_runs(buf, np.maximum(s, e - 3), e) % np.uint64(TAIL))
    if not words:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    return np.concatenate(words), np.concatenate(ends).astype(np.int64)


def tokens(raws: list[bytes]):
    """Slices of the texts, taken together: words and endings of all their texts, and the number of words of each."""
    for i, j in T.by_size(raws, T.BLOCK - len(raws)):
        if j - i == 1:
            words, ends = words_and_endings(raws[i])
            yield words, ends, np.array([len(words)])
        else:
            buf = np.frombuffer(b" ".join(raws[i:j]).lower(), np.uint8)
            s, e = T.runs(~T.SPACES[buf])
            at = np.cumsum([0] + [len(r) + 1 for r in raws[i:j]])
            yield (T.hash_runs(buf, s, e), (T.hash_runs(buf, np.maximum(s, e - 3), e) % np.uint64(TAIL)).astype(np.int64),
                   np.diff(np.searchsorted(s, at)))


def _lookup(keys: np.ndarray, values: np.ndarray, x: np.ndarray, missing) -> np.ndarray:
    if not len(keys):
        return np.full(len(x), missing, values.dtype)
    at = np.minimum(np.searchsorted(keys, x), len(keys) - 1)
    return np.where(keys[at] == x, values[at], missing)


def symbols(words: np.ndarray, endings: np.ndarray, c: Counts, counts: np.ndarray | None = None,
            distinct: tuple[np.ndarray, np.ndarray] | None = None) -> tuple[np.ndarray, ...]:
    """Symbol of every token and of the end, of the token before and two before it (before a
    text: the end), and the unknown class of each token (-1: it has its own symbol).
    ``counts``: the words belong to several texts with so many each, and every text has its end;
    ``distinct``: the distinct words, and the place of each word there (a search for each of these costs less)."""
    u, at = distinct or np.unique(words, return_inverse=True)
    counts = np.array([len(words)]) if counts is None else counts
    own = np.full(len(words) + len(counts), c.end)
    a_word = np.ones(len(own), bool)
    a_word[np.cumsum(counts + 1) - 1] = False
    known = _lookup(c.head, c.head_symbol, u, -1)[at]
    unknown = np.where(known < 0, endings, -1)
    own[a_word] = np.where(known < 0, c.unknown[endings], known)
    return *_with_before(np.concatenate(([c.end, c.end], own)).astype(np.int32), c.end), unknown


def _with_before(own: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The symbols from the third on, those before, and two before them; what stands before an end is of another text."""
    near = own[1:-1]
    return own[2:], near, np.where(near == end, np.int32(end), own[:-2])


def _profile(s: int, examples: np.ndarray, seed: int) -> np.ndarray:
    """Who stands before and after each symbol, as sums of random vectors; parts of a corpus add up."""
    random = np.random.default_rng(seed).normal(size=(2, s, 48)).astype(np.float32)
    near, _, nxt = examples.T
    profile = np.zeros((s, 96), np.float32)
    pairs, n = np.unique(nxt.astype(np.int64) * s + near, return_counts=True)
    nxt, near = np.divmod(pairs, s)
    other = np.argsort(near, kind="stable")
    for side, (who, beside, n) in enumerate(((nxt, near, n), (near[other], nxt[other], n[other]))):
        for a in range(0, len(who), ROW):                       # few enough to stay in the processor's cache
            w = who[a:a + ROW]
            starts = np.flatnonzero(np.diff(w, prepend=-1))
            rows = random[side][beside[a:a + ROW]]
            rows *= n[a:a + ROW, None].astype(np.float32)
            profile[w[starts], 48 * side:48 * side + 48] += np.add.reduceat(rows, starts, axis=0)
    return profile


def _groups(s: int, examples: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """The groups of ``_split`` by the neighbours in ``examples``."""
    return _split(_profile(s, examples, seed))


def _split(profile: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, first): symbols in an order in which group g is first[g] .. first[g + 1]; sizes differ by one or so."""
    s = len(profile)
    profile = profile / np.maximum(np.linalg.norm(profile, axis=1, keepdims=True), 1e-6)

    def split(at: np.ndarray, parts: int) -> list[np.ndarray]:
        if parts == 1:
            return [at]
        x = profile[at] - profile[at].mean(axis=0)
        _, _, axes = np.linalg.svd(x.T @ x)
        at = at[np.argsort(x @ axes[0], kind="stable")]
        left = parts // 2
        cut = len(at) * left // parts
        return split(at[:cut], left) + split(at[cut:], parts - left)

    parts = max(1, math.isqrt(s))
    found = split(np.arange(s), parts)
    return np.concatenate(found), np.concatenate(([0], np.cumsum([len(f) for f in found])))


def _sum_rows(ids: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Rows summed by id."""
    order = _by_id(ids, n)
    starts = np.flatnonzero(np.diff(ids[order], prepend=-1))
    out = np.zeros((n, rows.shape[1]), np.float32)
    out[ids[order][starts]] = np.add.reduceat(rows[order], starts, axis=0)
    return out


class _Trainer:
    """Steps (Adam) up the exact log-likelihood of the vectors ``p``, from a random start unless given."""

    def __init__(self, weight: np.ndarray, first: np.ndarray, seed, p: dict[str, np.ndarray] | None = None):
        self.rng = rng = np.random.default_rng(seed)
        self.first = first
        self.s, self.g = s, g = len(weight), len(first) - 1
        self.batch = max(BATCH, 2 * s)
        self.of = of = np.repeat(np.arange(g), np.diff(first))
        if p is None:
            share = (weight + 0.5) / (weight + 0.5).sum()
            group_share = np.add.reduceat(share, first[:-1])
            p = {"near": rng.normal(0, 0.05, (s, DIM)), "far": rng.normal(0, 0.05, (s, DIM)), "group": rng.normal(0, 0.05, (g, DIM)),
                 "out": rng.normal(0, 0.05, (s, DIM)), "group_bias": np.log(group_share)[:, None], "bias": np.log(share / group_share[of])[:, None]}
        # copies; the last column of a group or next token is its bias
        w = {"near": p["near"], "far": p["far"], "group": np.hstack((p["group"], p["group_bias"])), "out": np.hstack((p["out"], p["bias"]))}
        self.w = {k: x.astype(np.float32) for k, x in w.items()}
        self.p = {**self.w, "group": self.w["group"][:, :DIM], "out": self.w["out"][:, :DIM],
                  "group_bias": self.w["group"][:, DIM:], "bias": self.w["out"][:, DIM:]}
        self.m, self.v = ({k: np.zeros_like(x) for k, x in self.w.items()} for _ in range(2))
        self.t = 0

    def step(self, examples: np.ndarray, rate: float) -> None:
        w, first = self.w, self.first
        self.t += 1
        of = self.of[examples[:, 2]]
        order = _by_id(of, self.g)
        of, (near, far, nxt) = of[order], examples[order].T
        h = np.ones((len(nxt), DIM + 1), np.float32)
        np.add(w["near"][near], w["far"][far], out=h[:, :DIM])
        rest = _rest(h @ w["group"].T, of)
        d_h = rest @ w["group"]
        grad = {"group": rest.T @ h, "out": np.zeros_like(w["out"])}
        cuts = np.flatnonzero(np.diff(of, prepend=-1)).tolist()
        for i, z in zip(cuts, [*cuts[1:], len(of)]):                        # the symbols of one group
            lo, hi = first[of[i]], first[of[i] + 1]
            out = w["out"][lo:hi]
            rest = _rest(h[i:z] @ out.T, nxt[i:z] - lo)
            d_h[i:z] += rest @ out
            np.matmul(rest.T, h[i:z], out=grad["out"][lo:hi])
        grad["near"], grad["far"] = (_sum_rows(x, d_h[:, :DIM], self.s) for x in (near, far))
        rate *= math.sqrt(1 - 0.999 ** self.t) / (1 - 0.9 ** self.t)
        for key, whole in grad.items():
            for a in range(0, len(whole), ROWS):
                x, m, v, at = (y[a:a + ROWS] for y in (whole, self.m[key], self.v[key], w[key]))
                x /= len(nxt)
                m *= 0.9
                v *= 0.999
                size = x * x
                size *= 0.001
                v += size
                x *= 0.1
                m += x
                np.sqrt(v, out=size)
                size += 1e-6
                np.divide(m, size, out=size)
                size *= rate
                at += size


def _rate(done: float) -> float:
    """The step size after this share of the training."""
    return 0.01 * min(1.0, 1.5 * (1 - min(done, 1.0)) + 0.02)


def _model(first: np.ndarray, p: dict[str, np.ndarray]) -> Model:
    return Model(first, p["near"], p["far"], p["group"], p["group_bias"][:, 0], p["out"], p["bias"][:, 0])


def train(examples: np.ndarray, weight: np.ndarray, first: np.ndarray, seed: int = 11) -> Model:
    """The model of symbols whose groups are ``first[g] .. first[g + 1]``, trained in one place.

    ``examples``: rows (one before, two before, next); ``weight``: the symbols' counts."""
    trainer = _Trainer(weight, first, seed)
    steps = -(-len(examples) * EPOCHS // trainer.batch)
    order = np.empty(0, np.int64)
    for t in range(1, steps + 1):
        if len(order) < trainer.batch:
            order = np.concatenate((order, trainer.rng.permutation(len(examples))))
        trainer.step(examples[order[:trainer.batch]], _rate(t / steps))
        order = order[trainer.batch:]
    return _model(first, trainer.p)


def _word_counts(texts: DataFrame) -> DataFrame:
    """h, n, ending: counts of every token but the end, by partial sums."""

    def run(batches):
        held, size = [], 0

        def summed():
            w, e = (np.concatenate(x) for x in zip(*held, strict=True))
            u, first, n = np.unique(w, return_index=True, return_counts=True)
            for a in range(0, len(u), 1 << 17):
                z = a + (1 << 17)
                yield pa.RecordBatch.from_arrays([pa.array(u[a:z].view(np.int64)), pa.array(n[a:z]),
                                                  pa.array(e[first[a:z]], pa.int32())], names=["h", "n", "ending"])

        for b in batches:
            for words, endings, _ in tokens(T.utf8(b.column(0))):
                held.append((words, endings))
                size += len(held[-1][0])
                if size > 4_000_000:
                    yield from summed()
                    held, size = [], 0
        if held:
            yield from summed()

    part = texts.select("text").mapInArrow(run, "h bigint, n bigint, ending int")
    return part.groupBy("h").agg(F.sum("n").alias("n"), F.max("ending").alias("ending"))


def _stream(texts: DataFrame, shared) -> DataFrame:
    """own: the symbols of the texts in their order, after the two before the first of them, in arrays of up to ``ROW``."""

    def run(batches):
        c: Counts = shared.value
        kind = _kind(c.symbols)
        for b in batches:
            for words, endings, counts in tokens(T.utf8(b.column(0))):
                own = np.concatenate(([c.end, c.end], symbols(words, endings, c, counts)[0])).astype(kind)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([own[a:a + ROW + 2].tobytes() for a in range(0, len(own) - 2, ROW)], pa.binary())], names=["own"])

    return texts.select("text").mapInArrow(run, "own binary")


def _kind(s: int):
    return np.uint16 if s <= 1 << 16 else np.int32


def _chunks(batches, s: int, end: int, nth: int = 0, stride: int = 1):
    """Every ``stride``-th triple (one before, two before, next), from the ``nth`` on, in arrays of about ``CHUNK`` rows."""
    held, size, row = [], 0, 0
    for b in batches:
        for raw in b.column(0):
            own, near, far = _with_before(np.frombuffer(raw.as_buffer(), _kind(s)).astype(np.int32), end)
            held.append(np.stack([x[(nth - row) % stride::stride] for x in (near, far, own)], axis=1))
            row += len(own)
            size += len(held[-1])
            if size >= CHUNK:
                yield np.concatenate(held)
                held, size = [], 0
    if size:
        yield np.concatenate(held)


def _summed(parts: DataFrame, label: str) -> np.ndarray | None:
    """Sum of the arrays that the tasks made, read one after the other."""
    total = None
    for r in T.stored(parts, label).toLocalIterator():
        x = np.frombuffer(r[0], np.float32).astype(np.float64)
        total = x if total is None else total + x
    return total


def _profiles(stream: DataFrame, s: int, end: int, seed: int) -> DataFrame:
    def run(batches):
        total = None
        for x in _chunks(batches, s, end):
            part = _profile(s, x, seed)
            total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])

    return stream.mapInArrow(run, "sums binary")


def _met(near: np.ndarray, far: np.ndarray, nxt: np.ndarray, of: np.ndarray, s: int, g: int) -> dict[str, np.ndarray]:
    """How often each row of the vectors was met."""
    out, group = np.bincount(nxt, minlength=s), np.bincount(of[nxt], minlength=g)
    return {"near": np.bincount(near, minlength=s), "far": np.bincount(far, minlength=s), "group": group, "out": out,
            "group_bias": group, "bias": out}


def _one_round(stream: DataFrame, shared, end: int, nth: int, stride: int, per_task: float, seed: int) -> DataFrame:
    """Per task, the changes of its vectors times the times met, and those times."""

    def run(batches):
        p, weight, first, place = shared.value
        trainer = _Trainer(weight, first, (seed, nth, TaskContext.get().partitionId()), p)
        met, done = None, 0
        for x in _chunks(batches, trainer.s, end, nth, stride):
            x = place[x[trainer.rng.permutation(len(x))]]
            for a in range(0, len(x), trainer.batch):
                trainer.step(x[a:a + trainer.batch], _rate((nth + min(1.0, done / per_task)) / ROUNDS))
                done += trainer.batch
            here = _met(*x.T, trainer.of, trainer.s, trainer.g)
            met = here if met is None else {k: met[k] + here[k] for k in met}
        if met is not None:
            moved = [((trainer.p[k] - p[k]) * met[k][:, None]).ravel() for k in p] + [met[k] for k in p]
            yield pa.RecordBatch.from_arrays([pa.array([np.concatenate(moved).astype(np.float32).tobytes()], pa.binary())], names=["sums"])

    return stream.mapInArrow(run, "sums binary")


def _fit(train_rows: DataFrame, c: Counts, seed: int) -> None:
    """Train the model of ``c`` on all triples and give the symbols their places in the groups."""
    spark = train_rows.sparkSession
    stream = T.stored(_stream(train_rows, spark.sparkContext.broadcast(c)), "lm-stream")
    tasks = max(1, min(stream.rdd.getNumPartitions(), c.tokens // TASK))
    stream = stream.coalesce(tasks)
    sums = _summed(_profiles(stream, c.symbols, c.end, seed), "lm-profile")
    order, first = _split(np.zeros((c.symbols, 96)) if sums is None else sums.reshape(c.symbols, 96))
    place = np.empty(c.symbols, np.int32)
    place[order] = np.arange(c.symbols)
    weight = np.zeros(c.symbols)
    weight[c.head_symbol] = _lookup(c.heavy, c.times, c.head, 0)
    weight[c.unknown] = c.mass - 0.5
    weight[c.end] = c.texts
    p = _Trainer(weight[order], first, seed).p
    stride = ROUNDS                                          # all triples once: a quarter of them in each round
    while stride > 1 and c.tokens * ROUNDS // stride < EPOCHS * EXAMPLES * c.symbols:
        stride //= 2
    for nth in range(ROUNDS):
        shared = spark.sparkContext.broadcast((p, weight[order], first, place))
        got = _summed(_one_round(stream, shared, c.end, nth, stride, c.tokens / tasks / stride, seed), f"lm-round{nth}")
        if got is None:
            break
        ends = np.cumsum([x.size for x in p.values()] + [len(x) for x in p.values()])[:-1]
        cut = np.split(got, ends)
        for (k, x), moved, met in zip(list(p.items()), cut[:len(p)], cut[len(p):], strict=True):
            p[k] = (x + moved.reshape(x.shape) / np.maximum(met, 1)[:, None]).astype(np.float32)
        shared.unpersist()
    c.model = _model(first, p)
    c.head_symbol, c.unknown, c.end = place[c.head_symbol], place[c.unknown], int(place[c.end])


def _gather(train: DataFrame) -> tuple[Counts, DataFrame, int]:
    """Statistics for the tasks, all token counts as a stored table, and the
    count from which a token is heavy."""
    counts = T.stored(_word_counts(train), "lm-counts")
    texts = train.count()
    total, types = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    tokens = int(total) + texts
    heavy_from = max(1, math.ceil(tokens * HEAVY))
    got = counts.where(F.col("n") >= heavy_from).toArrow()       # at most 1 / HEAVY rows
    h = got.column("h").to_numpy().view(np.uint64)
    n, ending = got.column("n").to_numpy(), got.column("ending").to_numpy()
    top = np.lexsort((h, -n))[:math.ceil(WORDS * tokens ** (1 / 3))]
    top = top[n[top] >= LEAST]
    mass = np.full(TAIL, 0.5)
    for e, s in counts.groupBy("ending").agg(F.sum(F.col("n") + 0.5)).collect():
        mass[e] += s
    np.add.at(mass, ending[top], -(n[top] + 0.5))
    order, head_order = np.argsort(h), np.argsort(h[top])
    own = len(top)
    return Counts(tokens, types + (texts > 0), texts, h[order], n[order], h[top][head_order], np.arange(own),
                  own + np.arange(TAIL), own + TAIL, np.maximum(mass, 0.5)), counts, heavy_from


def _counted(of: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the distinct (text, word), by text, and how often they come."""
    order = np.lexsort((words, of))
    of, words = of[order], words[order]
    starts = np.flatnonzero((np.diff(of, prepend=-1) != 0) | np.concatenate(([True], words[1:] != words[:-1]))[:len(words)])
    return order[starts], np.diff(starts, append=len(of))


_LOCAL = ("_row bigint, doc_id bigint, held_out boolean, n_tokens bigint, known bigint, base double, model double, "
          "rare array<struct<h:bigint,tf:int>>")


def _local_scores(docs: DataFrame, shared) -> DataFrame:
    """Per row all that the broadcast statistics give, and the tokens left to be joined."""
    rare_type = pa.struct([("h", pa.int64()), ("tf", pa.int32())])

    def run(batches):
        c: Counts = shared.value
        log_mass = np.log10(c.mass)
        row = TaskContext.get().partitionId() << 40          # stored before it is used
        for b in batches:
            if not len(b):
                continue
            cols: list[list] = [[], [], [], [], []]
            for words, endings, counts in tokens(T.utf8(b.column(1))):
                texts = len(counts)
                of = np.repeat(np.arange(texts), counts)     # the text of each word
                u, at = np.unique(words, return_inverse=True)
                own, near, far, unknown = symbols(words, endings, c, counts, (u, at))
                logs = np.add.reduceat(c.model.log10(own, near, far), np.cumsum(counts + 1) - counts - 1)
                n = _lookup(c.heavy, c.times, u, 0)
                found, seen = (n > 0)[at], np.where(n > 0, np.log10(n + 0.5), 0.0)[at]
                in_tail = unknown >= 0
                share = np.bincount(of[in_tail], seen[in_tail] - log_mass[unknown[in_tail]], texts)
                pairs, tf = _counted(of[~found], words[~found])
                rare = pa.StructArray.from_arrays([pa.array(words[~found][pairs].view(np.int64)), pa.array(tf, pa.int32())], fields=list(rare_type))
                lengths = np.bincount(of[~found][pairs], minlength=texts)
                for col, v in zip(cols, (counts + 1, np.bincount(of[found], minlength=texts) + (c.texts > 0),
                                         np.bincount(of, seen, texts) + math.log10(c.texts + 0.5), share + logs,
                                         pa.ListArray.from_arrays(pa.array(np.cumsum([0, *lengths]), pa.int32()), rare)), strict=True):
                    col.append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(row, row + len(b)), pa.int64()), b.column(0).cast(pa.int64()), b.column(2),
                 *(pa.array(np.concatenate(x), t) for x, t in zip(cols, (pa.int64(), pa.int64(), pa.float64(), pa.float64()))),
                 pa.concat_arrays(cols[4])],
                names=["_row", "doc_id", "held_out", "n_tokens", "known", "base", "model", "rare"])
            row += len(b)

    return docs.select("doc_id", "text", "_held").mapInArrow(run, _LOCAL)


def score(docs: DataFrame, held_out: Column, seed: int = 11) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score per row.

    Tokens: ASCII lower-cased words between ASCII white space, and one end.
    The statistics come from the rows where ``held_out`` is false (a NULL
    doc_id is not held out and not learned from).  A NULL text is an empty one
    and has just the end.  A text of any length is scored whole, in slices.
    Other columns are not read.  Without training rows every count is 0 and the
    model is uniform.  Repeated rows count and come back each."""
    spark = docs.sparkSession
    T.prepare(spark)
    held = F.coalesce(held_out, F.lit(False))
    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"), held.alias("_held"))
    train_rows = rows.where(~F.col("_held") & F.col("doc_id").isNotNull())
    stats, counts, heavy_from = _gather(train_rows)
    _fit(train_rows, stats, seed)
    shared = spark.sparkContext.broadcast(stats)

    local = T.stored(_local_scores(rows, shared), "lm-local")
    rare = local.select("_row", F.explode("rare").alias("_t")).select("_row", "_t.h", "_t.tf")
    known = counts.where(F.col("n") < heavy_from).select(F.col("h").alias("_h"), "n")
    joined = rare.join(known, F.col("h") == F.col("_h"), "left").groupBy("_row").agg(
        F.sum(F.col("tf") * F.log10(F.coalesce("n", F.lit(0)) + 0.5)).alias("_logs"),
        F.sum(F.when(F.col("n").isNotNull(), F.col("tf")).otherwise(0)).alias("_known"))
    joined = joined.withColumnRenamed("_row", "_r")
    logs = F.coalesce("_logs", F.lit(0.0))
    total = math.log10(stats.tokens + 0.5 * (stats.types + 1))
    return local.join(joined, F.col("_row") == F.col("_r"), "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("_known", F.lit(0))).cast("bigint").alias("n_known"),
        F.lit(stats.tokens).cast("bigint").alias("train_tokens"),
        (F.col("base") + logs - F.lit(total) * F.col("n_tokens")).alias("base_score"),
        (F.col("model") + logs).alias("score"))
