"""Bounded labelled samples: whole, and the same whatever the order of the rows."""

import random

import numpy as np
from pyspark.sql import functions as F

from tests.conftest import spark  # noqa: F401
from tickbook.llm import quality, toxicity
from tickbook.llm import text as T


def frame(spark, rows, schema="doc_id bigint, text string"):
    return spark.createDataFrame(rows, schema)


def label_rows(spark, rows):
    return frame(spark, rows, "doc_id bigint, quality int, toxic int")


def test_all_values_of_a_label_are_sampled(spark):
    docs = frame(spark, [(i, f"text {i}") for i in range(1500)])
    lab = label_rows(spark, [(i, i, 0) for i in range(1500)])
    got = T.labelled_sample(docs, lab, "quality", 3)
    assert got.count() == 1500 and got.select("y").distinct().count() == 1500


def test_a_repeated_id_has_one_text_and_one_label(spark):
    docs = frame(spark, [(1, "b"), (1, "a"), (1, "a"), (2, None), (2, "x"), (None, "n"), (3, "z")])
    lab = label_rows(spark, [(1, 1, 0), (1, 0, 0), (1, None, 0), (2, 1, 0), (None, 1, 0), (9, 1, 0)])
    got = sorted(tuple(r) for r in T.labelled_sample(docs, lab, "quality", 10).collect())
    assert got == [(1, "a", 0), (2, "", 1)]
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        old, T.MOST_IDS = T.MOST_IDS, 0                           # too many ids to broadcast: joined
        assert sorted(tuple(r) for r in T.labelled_sample(docs, lab, "quality", 10).collect()) == got
    finally:
        T.MOST_IDS = old
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_models_do_not_depend_on_the_order_of_rows(spark):
    rng = random.Random(3)
    rows = []
    for i in range(300):
        words = ["good", "long", "text", "of", "many", "words"] if i % 2 else ["buy", "now", "$$$", "click", "here", "free"]
        rows.append((i // 2 * 2 + i % 2, " ".join(rng.choices(words, k=60))))
    rows += [(i, f"other text of {i} " * 9) for i in range(0, 300, 3)]        # ids with two texts
    lab = [(i, i % 2, 1 - i % 2) for i in range(300)]
    models = []
    for order in (1, -1):
        docs = frame(spark, rows[::order]).repartition(2 if order > 0 else 5)
        labs = label_rows(spark, lab[::order])
        models.append((quality.fit(docs, labs), toxicity.fit(docs, labs)))
    (a, s), (b, t) = models
    assert (a.good, a.bad, a.mean, a.slope, a.offset) == (b.good, b.bad, b.mean, b.slope, b.offset) and a.slope != 0
    assert np.array_equal(s.weights, t.weights) and np.array_equal(s.cuts, t.cuts) and s.weights.any()


def test_long_texts_are_represented_by_pieces(spark):
    docs = frame(spark, [(i, (f"w{i} " + ("nice " if i % 2 else "bad ")) * 20000) for i in range(12)])
    lab = label_rows(spark, [(i, i % 2, i % 2) for i in range(12)])
    model = toxicity.fit(docs, lab, class_bytes=6000)
    assert model.grades == [0, 1] and model.weights.any()
    limits = quality.class_limits(T.labelled_sample(docs, lab, "toxic", 100), 6000)
    assert limits == {0: 1000, 1: 1000}
    out = toxicity.severity(docs, lab).where(F.col("_grade") == F.col("doc_id") % 2)
    assert out.count() == 12
