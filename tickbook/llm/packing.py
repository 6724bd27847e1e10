"""Best-fit packing of tokenised documents into fixed-length sequences.

The plan is made over the *histogram* of piece lengths (at most ``capacity``
counts, whatever the number of documents): lengths go from long to short, and
every count is placed into the open sequences with the least room that still
fits.  Sequences of equal history are handled as runs, so the plan is a short
table of (length, first rank, number of ranks) -> (first sequence, offset):
its size depends on the distinct lengths and not on the documents.
Pieces then take their planned slot by their rank among the pieces of the
same length.  Ranks are counted in two levels (hash shard, then position in
the shard), so a length that a third of all pieces share is not one group.
"""

from __future__ import annotations

import bisect
import os

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import text as T

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
RANKS_PER_SHARD = 1 << 20


def _letter_ends(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions where an ASCII or Latin-1 letter ends / starts (lower-cased bytes)."""
    ascii_letter = (buf >= 0x61) & (buf <= 0x7A)
    lead = np.concatenate(([False], buf[:-1] == 0xC3))
    # U+00D7 and U+00F7 are the two signs among U+00C0-U+00FF
    latin = lead & (buf != 0x97) & (buf != 0xB7)
    return ascii_letter | latin, ascii_letter | np.concatenate((latin[1:], [False]))


class WordTokenizer:
    """Token ids of many texts at a time, each distinct word encoded once.

    The tokenizer drops white space and splits words from punctuation, so a
    text's ids are the ids of its parts between white space, and between a
    letter and ASCII punctuation other than an apostrophe.  Parts are hashed
    in numpy and only those not yet in the cache are given to the tokenizer.
    Texts that spell a special token, or hold a part of over 64 KB, are
    encoded whole.  The cache is emptied at ``cache_words`` entries.
    """

    PUNCT = np.zeros(256, bool)
    PUNCT[[c for c in range(0x21, 0x7F) if not chr(c).isalnum() and c != 0x27]] = True

    def __init__(self, path: str, cache_words: int = 1_500_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")   # Spark runs the tasks in parallel
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.special = [s.content.encode() for s in self.tok.get_added_tokens_decoder().values()]
        self.cache_words = cache_words
        self.id_type = np.uint16 if self.tok.get_vocab_size() <= 1 << 16 else np.uint32
        self._reset()

    def _reset(self):
        self.known = np.empty(0, np.uint64)       # sorted word hashes
        self.first = np.empty(0, np.uint32)       # where the word's ids start in the pool
        self.count = np.empty(0, np.uint32)
        self.pool = np.empty(0, self.id_type)

    def _learn(self, hashes: np.ndarray, words: list[str]):
        ids = [e.ids for e in self.tok.encode_batch_fast(words, add_special_tokens=False)]
        n = np.fromiter(map(len, ids), np.int64, len(ids))
        at = len(self.pool) + np.concatenate(([0], np.cumsum(n)[:-1])).astype(np.int64)
        flat = np.fromiter((i for x in ids for i in x), self.id_type, int(n.sum()))
        where = np.searchsorted(self.known, hashes)
        self.known = np.insert(self.known, where, hashes)
        self.first = np.insert(self.first, where, at.astype(np.uint32))
        self.count = np.insert(self.count, where, n.astype(np.uint32))
        self.pool = np.concatenate((self.pool, flat))

    def _plain(self, raw: bytes) -> bool:
        return not any(s in raw for s in self.special)

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        """Ids of each UTF-8 text."""
        out: list = [None] * len(texts)
        easy = []
        for i, t in enumerate(texts):
            if len(t) <= T.BLOCK and self._plain(t):
                easy.append(i)
            else:
                out[i] = np.array(self.tok.encode(t.decode(), add_special_tokens=False).ids, np.uint32)
        for a, b in T.by_size([texts[i] for i in easy]):
            for i, ids in zip(easy[a:b], self._encode([texts[i] for i in easy[a:b]]), strict=True):
                out[i] = ids
        return out

    def _encode(self, texts: list[bytes]) -> list[np.ndarray]:
        joined = b" ".join(texts).lower() + b" "
        buf = np.frombuffer(joined, np.uint8)
        s, e = T.runs(~T.SPACES[buf])
        ends, begins = _letter_ends(buf)
        punct = self.PUNCT[buf]
        cut = np.flatnonzero((ends[:-1] & punct[1:]) | (punct[:-1] & begins[1:])) + 1
        s, e = np.sort(np.concatenate((s, cut))), np.sort(np.concatenate((e, cut)))
        h = T.hash_runs(buf, s, e)
        distinct, sample, inverse = np.unique(h, return_index=True, return_inverse=True)
        if len(self.known) + len(distinct) > self.cache_words:
            self._reset()
        new = ~np.isin(distinct, self.known, assume_unique=True)
        if new.any():
            self._learn(distinct[new], [joined[s[i]:e[i]].decode() for i in sample[new]])
        where = np.searchsorted(self.known, distinct)
        n = self.count[where][inverse].astype(np.int64)
        stop = np.cumsum(n)
        begin = stop - n
        flat = self.pool[np.repeat(self.first[where][inverse].astype(np.int64) - begin, n) + np.arange(n.sum())]
        lengths = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
        last_part = np.searchsorted(s, np.cumsum(lengths))     # parts before each text's end
        upto = np.concatenate(([0], stop))[last_part]
        return np.split(flat, upto[:-1])


_shared: dict[str, WordTokenizer] = {}


def shared_tokenizer(path: str) -> WordTokenizer:
    """One tokenizer and cache per Python worker process."""
    if path not in _shared:
        _shared[path] = WordTokenizer(path)
    return _shared[path]


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32.

    A document's ids are the tokenizer's plus ``end_id`` (a NULL or empty text
    is just that).  Only documents over ``capacity`` ids are cut, into pieces
    of ``capacity`` and a shorter last one.  Other columns are ignored."""
    import zlib

    def run(batches):
        tok = shared_tokenizer(tokenizer_path)
        for b in batches:
            cols: list[list] = [[], [], [], [], []]
            ids = b.column(0).to_pylist()
            for doc, own in zip(ids, tok.encode(T.utf8(b.column(1))), strict=True):
                own = np.append(own, end_id).astype("<u4")
                for k, at in enumerate(range(0, len(own), capacity)):
                    part = own[at:at + capacity]
                    for c, v in zip(cols, (doc, k, at, len(part), zlib.crc32(part.tobytes())), strict=True):
                        c.append(v)
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)],
                                             names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(run, PIECES)


def plan(histogram: dict[int, int], capacity: int = 2048) -> list[tuple]:
    """Best-fit-decreasing over counts.

    Rows (length, rank0, ranks, seq0, per_seq, room): the pieces of that
    length with rank in [rank0, rank0 + ranks) go to sequence
    seq0 + (rank - rank0) div per_seq, at offset
    capacity - room + ((rank - rank0) mod per_seq) * length."""
    rooms: dict[int, list] = {}      # room left -> runs (first sequence, sequences)
    order: list[int] = []            # rooms with runs, ascending
    rows, next_seq = [], 0

    def put(room, run):
        if room not in rooms:
            rooms[room] = []
            bisect.insort(order, room)
        rooms[room].append(run)

    for length in sorted((n for n, c in histogram.items() if c > 0), reverse=True):
        if not 0 < length <= capacity:
            raise ValueError(f"length {length} outside 1..{capacity}")
        left, rank = histogram[length], 0
        while left:
            at = bisect.bisect_left(order, length)
            if at < len(order):
                room = order[at]
                seq, n = rooms[room].pop()
                if not rooms[room]:
                    del rooms[room]
                    order.pop(at)
            else:
                room, seq, n = capacity, next_seq, -(-left // (capacity // length))
                next_seq += n
            per = room // length
            full = min(n, left // per)
            if full:
                rows.append((length, rank, full * per, seq, per, room))
                rank += full * per
                left -= full * per
                if room - per * length:
                    put(room - per * length, (seq, full))
            if full < n and left and left < per:      # one sequence takes the rest
                rows.append((length, rank, left, seq + full, per, room))
                put(room - left * length, (seq + full, 1))
                rank, left, full = rank + left, 0, full + 1
            if full < n:
                put(room, (seq + full, n - full))
    return rows


PLAN = "p_length bigint, rank0 bigint, ranks bigint, seq0 bigint, per_seq bigint, room bigint"


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """Pieces with sequence_id and offset; every sequence is gapless from 0.

    Repeated rows and doc_ids are packed each on their own; an empty table
    gives no rows.  The broadcast plan has a few rows per distinct length (at most ``capacity``
    lengths, each meeting at most two open runs per longer length)."""
    spark = docs.sparkSession
    T.prepare(spark)
    # the tag is stored with the pieces, so it stays; it tells rows apart that are equal in all else
    base = T.stored(pieces(docs, tokenizer_path, capacity, end_id).withColumn("_tag", F.monotonically_increasing_id()), "pieces")
    rows = base.count()
    shards = max(1, -(-rows // RANKS_PER_SHARD), int(spark.conf.get("spark.sql.shuffle.partitions")))
    # length is part of the key, so the shard alone need not be even; the offsets have a row per
    # length and shard, which grows with the input: they are joined where the ranks are, not broadcast
    base = base.withColumn("_s", F.pmod(F.xxhash64("_tag"), F.lit(shards)))
    counts = base.groupBy("length", "_s").agg(F.count(F.lit(1)).alias("_c"))
    counts = T.stored(counts, "piece-counts")
    histogram = {r[0]: r[1] for r in counts.groupBy("length").agg(F.sum("_c")).collect()}
    before = Window.partitionBy("length").orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(F.col("length").alias("_l"), F.col("_s").alias("_s2"),
                            (F.coalesce(F.sum("_c").over(before), F.lit(0))).alias("_before"))
    inside = Window.partitionBy("length", "_s").orderBy("_tag")
    ranked = (base.withColumn("_r", F.row_number().over(inside) - 1)
                  .join(offsets.hint("merge"), (F.col("length") == F.col("_l")) & (F.col("_s") == F.col("_s2")))
                  .withColumn("_rank", F.col("_r") + F.col("_before")))
    slots = spark.createDataFrame(plan(histogram, capacity), PLAN)
    k = F.col("_rank") - F.col("rank0")
    return (ranked.join(F.broadcast(slots), (F.col("length") == F.col("p_length"))
                        & (k >= 0) & (k < F.col("ranks")))
            .select("doc_id", "piece", "start", "length", "ids_crc32",
                    (F.col("seq0") + F.floor(k / F.col("per_seq"))).cast("bigint").alias("sequence_id"),
                    (F.lit(capacity) - F.col("room") + (k % F.col("per_seq")) * F.col("length"))
                    .cast("bigint").alias("offset")))
