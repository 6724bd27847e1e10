"""The token model: normalised, better than counts, and it minds the order of words."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF01, spark  # noqa: F401
from tickbook.llm import lm
from tickbook.llm import text as T


def trained(s=150, n=40000, seed=3):
    """A model of a chain in which a symbol is followed by one of a few others."""
    rng = np.random.default_rng(seed)
    follow = rng.integers(0, s, (s, 3))
    chain = [0, 1]
    for _ in range(n):
        chain.append(int(follow[chain[-1], rng.integers(3)] if rng.random() < .9 else rng.integers(s)))
    c = np.array(chain)
    x = np.stack((c[1:-1], c[:-2], c[2:]), axis=1)
    order, first = lm._groups(s, x, 1)
    place = np.empty(s, np.int64)
    place[order] = np.arange(s)
    x = place[x]
    return lm.train(x, np.bincount(x[:, 2], minlength=s).astype(float), first), x


def test_probabilities_of_all_symbols_sum_to_one():
    model, x = trained()
    s = len(model.bias)
    for near, far in x[:20, :2]:
        logs = model.log10(np.arange(s), np.full(s, near), np.full(s, far))
        assert math.isclose((10.0 ** logs).sum(), 1, rel_tol=1e-4)
    extreme = lm.Model(model.first, model.near * 100, model.far * 100, model.group, model.group_bias, model.out, model.bias)
    logs = extreme.log10(np.arange(s), np.full(s, 3), np.full(s, 4))
    assert np.isfinite(logs).all() and 10.0 ** logs.max() <= 1.001


def test_the_model_learns_who_follows_whom():
    model, x = trained()
    unigram = np.bincount(x[:, 2], minlength=len(model.bias)) + 0.5
    plain = np.log10(unigram / unigram.sum())[x[:, 2]].mean()
    assert model.log10(x[:, 2], x[:, 0], x[:, 1]).mean() > plain + 0.4


def test_slices_and_order_do_not_change_a_score(monkeypatch):
    model, x = trained()
    whole = model.log10(x[:, 2], x[:, 0], x[:, 1])
    monkeypatch.setattr(lm, "SLICE", 777)
    assert np.allclose(model.log10(x[:, 2], x[:, 0], x[:, 1]), whole, atol=1e-4)


@pytest.mark.parametrize("s", [1, 2, 3, 137, 1000])
def test_groups_hold_every_symbol_once(s):
    x = np.random.default_rng(s).integers(0, s, (500, 3))
    order, first = lm._groups(s, x, 1)
    sizes = np.diff(first)
    assert sorted(order) == list(range(s)) and first[0] == 0 and first[-1] == s and len(sizes) == max(1, math.isqrt(s))
    assert sizes.min() >= 1 and sizes.max() <= 2 * sizes.min() + 1


def test_model_grows_with_the_corpus(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text")
    T.prepare(spark)
    small, _, _ = lm._gather(docs.where("doc_id < 100"))
    large, _, _ = lm._gather(docs)
    assert large.tokens > 5 * small.tokens
    assert large.symbols - 1 - lm.TAIL > 1.5 * (small.symbols - 1 - lm.TAIL) > 100


def test_every_token_is_learned_from(spark, monkeypatch):
    """All triples take part in each pass over the corpus, also when it is large and dealt to several tasks."""
    monkeypatch.setattr(lm, "EXAMPLES", 1)                                       # as in a large corpus: one pass
    monkeypatch.setattr(lm, "TASK", 2000)
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text").where("doc_id < 100").repartition(3)
    T.prepare(spark)
    c, _, _ = lm._gather(docs)
    met = []
    summed = lm._summed
    monkeypatch.setattr(lm, "_summed", lambda parts, label: met.append((label, summed(parts, label))) or met[-1][1])
    lm._fit(docs, c, 11)
    rounds = [x for label, x in met if label.startswith("lm-round")]
    groups = len(c.model.first) - 1
    sizes = (("near", c.symbols), ("far", c.symbols), ("group", groups), ("out", c.symbols), ("group_bias", groups), ("bias", c.symbols))
    times = sum(x[-sum(n for _, n in sizes):] for x in rounds)
    assert len(rounds) == lm.ROUNDS and times[:c.symbols].sum() == c.tokens > 10000
    assert times[-c.symbols:][c.end] == c.texts


def test_held_out_texts_against_counts_and_shuffled(spark):
    """Held-out texts: better than single tokens, and better in order than shuffled."""
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text")
    held = T.id_bucket("doc_id", 5) == 1
    rng = random.Random(1)
    rows = [(r.doc_id, r.text) for r in docs.where(held).collect()]
    again = []
    for i, t in rows:
        w = t.split()
        rng.shuffle(w)
        again.append((i + 10 ** 6, " ".join(w)))
    both = docs.union(spark.createDataFrame(again, docs.schema))
    got = {r.doc_id: r for r in lm.score(both, (F.col("doc_id") >= 10 ** 6) | held).collect()}

    tokens = sum(got[i].n_tokens for i, _ in rows)
    ours, base = (sum(getattr(got[i], c) for i, _ in rows) / tokens for c in ("score", "base_score"))
    assert ours > base + 0.2
    long = [i for i, t in rows if len(t.split()) >= 20]
    higher = sum(got[i].score > got[i + 10 ** 6].score for i in long)
    assert len(long) > 150 and higher >= 0.9 * len(long), higher / len(long)


def test_a_step_follows_the_exact_gradient():
    """The first step of Adam goes against the sign of the exact loss's gradient, all symbols being priced."""
    rng = np.random.default_rng(5)
    s, first = 12, np.array([0, 4, 8, 12])
    x = rng.integers(0, s, (200, 3))
    start = lm._Trainer(np.ones(s), first, 1, {k: 10 * v for k, v in lm._Trainer(np.ones(s), first, 1).p.items()})

    def loss(p):
        return -lm._model(first, p).log10(x[:, 2], x[:, 0], x[:, 1]).mean()

    before = {k: v.astype(float).copy() for k, v in start.p.items()}
    start.step(x, 0.001)
    for key, at in (("near", (3, 5)), ("far", (7, 0)), ("group", (1, 9)), ("out", (10, 31)), ("group_bias", (2, 0)), ("bias", (6, 0))):
        up, down = ({k: v.copy() for k, v in before.items()} for _ in range(2))
        up[key][at] += 0.1
        down[key][at] -= 0.1
        slope = loss(up) - loss(down)
        assert abs(slope) > 1e-4 and (start.p[key][at] - before[key][at]) * slope < 0, key
    assert loss(start.p) < loss(before)


def test_several_texts_taken_together_give_what_each_gives():
    raws = [b"", b"a Bb a", b" \n ", b"one", "é Été x\ty ".encode(), b"w" * (T.BLOCK + 9), b"a b " * T.BLOCK, b"", b"last one"]
    got = list(lm.tokens(raws))
    assert len(got) < len(raws)
    words, endings, counts = (np.concatenate(x) for x in zip(*got))
    each = [lm.words_and_endings(r) for r in raws]
    assert counts.tolist() == [len(w) for w, _ in each]
    assert (words == np.concatenate([w for w, _ in each])).all() and (endings == np.concatenate([e for _, e in each])).all()
    head = np.unique(words)[:4]
    c = lm.Counts(1, 1, 1, head, np.ones(4), head, np.arange(4), 4 + np.arange(lm.TAIL), 4 + lm.TAIL, np.ones(lm.TAIL))
    for i, part in enumerate(zip(*(lm.symbols(w, e, c) for w, e in each))):
        assert (lm.symbols(words, endings, c, counts)[i] == np.concatenate(part)).all()


def test_tokens_are_stored_without_a_row_each(spark, monkeypatch):
    """Rows of the stored symbols: a few for many texts; read back, they are the triples of every text."""
    monkeypatch.setattr(lm, "ROW", 50)
    T.prepare(spark)
    docs = spark.createDataFrame([("a b c a b",), (None,), ("",), ("x " * 120 + "a",), ("b",)] * 20, "text string").coalesce(1)
    c, _, _ = lm._gather(docs)
    rows = lm._stream(docs, type("S", (), {"value": c})).toArrow()
    assert rows.num_rows < 2 + c.tokens / 50
    got = np.concatenate(list(lm._chunks(rows.to_batches(), c.symbols, c.end)))
    want = [np.stack((near, far, own), axis=1) for own, near, far, _ in
            (lm.symbols(*lm.words_and_endings((r.text or "").encode()), c) for r in docs.collect())]
    assert len(got) == c.tokens and (got == np.concatenate(want)).all()
    for nth in range(4):
        assert (np.concatenate(list(lm._chunks(rows.to_batches(), c.symbols, c.end, nth, 4))) == got[nth::4]).all()
