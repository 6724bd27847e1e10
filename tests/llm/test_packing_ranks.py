"""Ranks within a length: rows that are equal in all columns still spread over shards."""

import public_tokenizers
from tests.conftest import spark  # noqa: F401
from tickbook.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_equal_rows_are_packed_each_and_ranked_in_shards(spark, monkeypatch):
    monkeypatch.setattr(packing, "RANKS_PER_SHARD", 100)
    docs = spark.createDataFrame([(None, "")] * 3000 + [(7, "some words here")] * 500, "doc_id bigint, text string").repartition(4)
    out = packing.pack(docs, PATH, 64)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "xxhash64(_tag" in plan and "SortMergeJoin" in plan       # the offsets are not broadcast
    rows = out.collect()
    assert len(rows) == 3500
    places: dict = {}
    for r in rows:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in places.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 64
    total = sum(r.length for r in rows)
    assert len(places) <= total // 64 + 2
