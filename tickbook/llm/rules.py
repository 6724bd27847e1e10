"""Document quality rules whose cutoffs come with a guarantee.

Every rule is a number per document (``RULES``; larger is worse).  Labelled
documents are dealt in two halves by the hash of the id.  On the first half,
each stratum (language) and rule gets, for every leniency in ``LEVELS``, the
cutoff that separates the labels best while it rejects at most that share of
good documents.  The second half is the holdout: levels are tried from lenient
to strict, and a level is certified while the exact binomial (Clopper-Pearson)
upper bound on the share of good documents that *any* of its rules rejects
stays at or below ``alpha``.  Stopping at the first failure (fixed-sequence
testing) needs no correction along the levels; over the strata the error
``delta`` is divided by Bonferroni.  So with probability 1 - delta no stratum
loses more than ``alpha`` of its good documents to the rules.  A stratum whose
labels certify nothing rejects nothing.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import text as T

_SYMBOLS = list(b"#*$%&|<>")
_UPPER = slice(0x41, 0x5B)
_CONTINUED = slice(0x80, 0xC0)      # UTF-8 bytes that start no character
_MARKS = [c for c in range(0x21, 0x7F) if not chr(c).isalnum() and chr(c) not in ".,;:'\"-()"]

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_marks",
          "n_same_next")
RULES = ("symbols", "marks", "upper", "dup_lines", "repeats", "same_next", "long_words", "short_words", "brevity")
BINS = 200          # cutoffs tried per rule
LEVELS = (0.0, 0.0005, 0.001, 0.002, 0.004)   # shares of good documents a rule may reject on the first half
REPEAT_WINDOW = 8
MAX_BROADCAST_STRATA = 10_000


def counts(raw: bytes) -> tuple[int, ...]:
    """The base numbers of one text, in the order of ``COUNTS``."""
    w = T.word_hashes(raw)
    of = np.zeros(256, np.int64)
    for at in range(0, len(raw), T.BLOCK):
        of += np.bincount(np.frombuffer(raw, np.uint8, min(T.BLOCK, len(raw) - at), at), minlength=256)
    chars = int(of.sum() - of[_CONTINUED].sum() - of[T.SPACES].sum())
    symbols, upper, marks = int(of[_SYMBOLS].sum()), int(of[_UPPER].sum()), int(of[_MARKS].sum())
    seen, lines, dup = set(), 0, 0
    for line in raw.split(b"\n"):
        if line.strip(b" \t\r\x0b\x0c"):
            lines += 1
            dup += line in seen
            seen.add(line)
    repeat = 0
    h = T.windows(w, REPEAT_WINDOW)
    in_order = np.sort(h)
    twice = np.unique(in_order[1:][in_order[1:] == in_order[:-1]])
    if len(twice):
        place = np.flatnonzero(np.isin(h, twice))
        edge = np.zeros(len(w) + 1, np.int64)
        np.add.at(edge, place, 1)
        np.add.at(edge, place + REPEAT_WINDOW, -1)
        repeat = int((np.cumsum(edge) > 0).sum())
    same = int((w[1:] == w[:-1]).sum())
    return len(w), chars, symbols, dup, repeat, lines, upper, marks, same


def count_struct(column: Column) -> Column:
    """The counts of a text column as one struct."""

    @F.arrow_udf("struct<" + ",".join(f"{c}:bigint" for c in COUNTS) + ">")
    def count(text: pa.Array) -> pa.Array:
        rows = np.array([counts(raw) for raw in T.utf8(text)], np.int64).reshape(-1, len(COUNTS))
        return pa.StructArray.from_arrays([pa.array(rows[:, i]) for i in range(len(COUNTS))], names=list(COUNTS))

    return count(column)


def rule_columns(m: str = "_m") -> dict[str, Column]:
    """The rules as columns over the struct ``m`` of counts, each in [0, 1]."""
    c = {k: F.col(f"{m}.{k}") for k in COUNTS}
    words, chars = F.greatest(c["n_words"], F.lit(1)), F.greatest(c["word_chars"], F.lit(1))
    mean = chars / words
    return {"symbols": F.least(F.lit(1.0), c["n_symbols"] / words), "marks": F.least(F.lit(1.0), c["n_marks"] / words),
            "upper": c["n_upper"] / chars, "dup_lines": c["n_dup_lines"] / F.greatest(c["n_lines"], F.lit(1)),
            "repeats": c["n_repeat_words"] / words, "same_next": c["n_same_next"] / words,
            "long_words": F.least(F.lit(1.0), mean / 20), "short_words": F.lit(1.0) / F.greatest(F.lit(1.0), mean),
            "brevity": F.lit(20.0) / (F.lit(20.0) + c["n_words"])}


def base_failed(m: str = "_m") -> Column:
    """Fewer than 20 words, or over 30 % of the words in repeated windows."""
    words = F.col(f"{m}.n_words")
    return (words < 20) | (100 * F.col(f"{m}.n_repeat_words") > 30 * words)


def _bin(c: Column) -> Column:
    return F.floor(c * BINS).cast("int")


def upper_bound(k: int, n: int, delta: float) -> float:
    """Clopper-Pearson: the largest rate at which k or fewer of n has probability delta."""
    if n == 0 or k >= n:
        return 1.0
    logs = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) for i in range(k + 1)]

    def at_most(p):
        return sum(math.exp(v + i * math.log(p) + (n - i) * math.log1p(-p)) for i, v in enumerate(logs))

    lo, hi = 0.0, 1.0
    for _ in range(60):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if 0 < mid < 1 and at_most(mid) > delta else (lo, mid)
    return hi


def choose(good: np.ndarray, bad: np.ndarray, share: float) -> int | None:
    """The cutoff bin (reject at or above it) that separates the counts per bin
    best while it rejects at most ``share`` of the good ones, or None."""
    lost, caught = np.cumsum(good[::-1])[::-1], np.cumsum(bad[::-1])[::-1]
    gain = caught / max(1, bad.sum()) - lost / max(1, good.sum())
    gain[(lost > share * good.sum()) | (caught == 0)] = -1.0
    gain[0] = -1.0
    best = len(gain) - 1 - int(gain[::-1].argmax())
    return best if gain[best] > 0 else None


def certify(rows: DataFrame, alpha: float = 0.01, delta: float = 0.05) -> dict[str, dict[str, int]]:
    """stratum -> rule -> cutoff bin, from rows (doc_id, _stratum, _y, one bin column per rule).

    What reaches the driver is a count per stratum, rule and bin, and one per
    stratum and level, for strata with enough good documents to certify
    anything (so at most the number of labels over ``need``)."""
    need = math.ceil(math.log(delta) / math.log1p(-alpha))
    rows = T.stored(rows.withColumn("_hold", F.pmod(F.xxhash64("doc_id", F.lit("hold")), F.lit(2)) == 1), "rule-labels")
    strata = (rows.where("_y > 0 AND _hold").groupBy("_stratum").count().where(F.col("count") >= need)
                  .select("_stratum"))
    rows = rows.join(strata, "_stratum", "left_semi")
    long = (rows.where("NOT _hold").select("_stratum", "_y", F.explode(F.array(*[
                F.struct(F.lit(r).alias("rule"), F.col(r).alias("bin")) for r in RULES])).alias("_r"))
                .groupBy("_stratum", "_r.rule", "_r.bin", (F.col("_y") > 0).alias("_g")).count())
    table: dict = {}
    for stratum, rule, b, y, n in long.toLocalIterator():
        table.setdefault((stratum, rule), np.zeros((2, BINS + 1), np.int64))[int(y), b] += n
    cuts: dict[str, dict[str, list]] = {}
    for (stratum, rule), v in sorted(table.items()):
        cuts.setdefault(stratum, {})[rule] = [choose(v[1], v[0], s) for s in LEVELS]
    if not cuts:
        return {}
    none = BINS + 1
    spark = rows.sparkSession
    at = spark.createDataFrame([(s, *[[none if c is None else c for c in by.get(r, [None] * len(LEVELS))] for r in RULES])
                                for s, by in cuts.items()],
                               "_s string, " + ", ".join(f"_cut_{r} array<int>" for r in RULES))
    if len(cuts) <= MAX_BROADCAST_STRATA:
        at = F.broadcast(at)
    hit = [F.expr(f"cast(array_position(transform(_cut_{r}, c -> {r} >= c), true) as int)") for r in RULES]
    first = F.least(*[F.when(h > 0, h).otherwise(len(LEVELS) + 1) for h in hit])     # first level that rejects it
    got = (rows.where("_hold AND _y > 0").join(at, F.col("_stratum") == F.col("_s"))
               .groupBy("_stratum", first.alias("level")).count().collect())
    lost: dict[str, np.ndarray] = {}
    for stratum, level, n in got:
        lost.setdefault(stratum, np.zeros(len(LEVELS) + 2, np.int64))[level] += n
    out: dict[str, dict[str, int]] = {}
    for stratum, v in lost.items():
        n, rejected = int(v.sum()), np.cumsum(v)
        for level in range(1, len(LEVELS) + 1):
            k = int(rejected[level])
            if k > alpha * n or upper_bound(k, n, delta / len(cuts)) > alpha:
                break
            out[stratum] = {r: c[level - 1] for r, c in cuts[stratum].items() if c[level - 1] is not None}
    return out


def judge(docs: DataFrame, labels: DataFrame, stratum: str = "lang", alpha: float = 0.01, delta: float = 0.05,
          metrics: DataFrame | None = None) -> DataFrame:
    """``docs`` with struct ``_m`` of counts, ``_failed`` and ``_kept``.

    ``_failed``: the base rule; ``_kept``: not failed, and below every
    certified cutoff of the stratum.  A NULL stratum is a stratum of its own,
    NULL texts have no words (and so fail), unlabelled documents are judged
    but not learned from, repeated label rows count once.  ``metrics``: the
    counts (doc_id, ``_m``, ``_stratum``) if the caller has them stored."""
    spark = docs.sparkSession
    T.prepare(spark)
    key = F.coalesce(F.col(stratum).cast("string"), F.lit("\x00"))
    counted = docs.withColumn("_m", count_struct(F.col("text").cast("string"))).withColumn("_stratum", key)
    base = metrics if metrics is not None else counted
    lab = (labels.select(F.col("doc_id").alias("_id"), F.col("quality").cast("int").alias("_y"))
                 .where("_id IS NOT NULL AND _y IS NOT NULL").groupBy("_id").agg(F.min("_y").alias("_y")))
    rows = base.select("doc_id", "_stratum", *[_bin(c).alias(k) for k, c in rule_columns().items()])
    cuts = certify(rows.join(lab, F.col("doc_id") == F.col("_id")), alpha, delta)
    none = BINS + 1
    table = spark.createDataFrame([(s, *[c.get(r, none) for r in RULES]) for s, c in cuts.items()],
                                  "_s string, " + ", ".join(f"_cut_{r} int" for r in RULES))
    if len(cuts) <= MAX_BROADCAST_STRATA:      # beyond that the join is left to the planner
        table = F.broadcast(table)
    out = (counted if metrics is None else metrics).join(table, F.col("_stratum") == F.col("_s"), "left")
    bad = F.lit(False)
    for r, c in rule_columns().items():
        bad = bad | (_bin(c) >= F.coalesce(F.col(f"_cut_{r}"), F.lit(none)))
    return (out.withColumn("_failed", base_failed()).withColumn("_kept", ~F.col("_failed") & ~bad)
               .drop("_s", "_stratum", *[f"_cut_{r}" for r in RULES]))
