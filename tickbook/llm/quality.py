"""Compression classifier of text quality.

Two zstandard dictionaries are built, one from text labelled good and one
from text labelled bad: by zstandard's trainer, or, where the trainer finds
too little to keep (it drops what repeats inside a sample, as junk does), of
pieces drawn evenly from all sampled texts.  A text is cut into pieces of
``PIECE`` bytes (so that the dictionary, and not the text's own history,
decides), every piece is compressed with either dictionary, and the difference
of the summed sizes over the text's length is the raw score; the mean score
counts as ``PRIOR`` more bytes, so that a few words alone decide little.  A
logistic curve fitted on labelled documents that took no part in the
dictionaries turns it into a probability.

Dictionaries and curve come from a bounded sample of labelled rows: at most
``per_class`` documents and ``class_bytes`` bytes per label.  If the documents
have more bytes, no document is left out: the longest are represented by
evenly spaced pieces, as many as fill the bound.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import text as T

PIECE = 1024
PRIOR = 64
PER_CLASS = 3000
CLASS_BYTES = 12 << 20
DICT_BYTES = 1 << 20


@dataclass
class Model:
    good: bytes
    bad: bytes
    mean: float
    slope: float
    offset: float


def _dictionary(texts: list[bytes], size: int = DICT_BYTES) -> bytes:
    import zstandard

    samples = [t[i:i + 2048] for t in texts for i in range(0, len(t), 2048)]
    samples = [s for s in samples if len(s) >= 16]
    size = min(size, sum(map(len, samples)) // 2)
    try:
        trained = zstandard.train_dictionary(size, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):   # too few samples to train on
        trained = b""
    if 2 * len(trained) >= size and trained:
        return trained
    cut, rng = 256, np.random.default_rng(len(texts))
    per = max(1, size // cut // max(1, len(texts)))
    pieces = []
    for t in texts:
        n = max(1, len(t) // cut)
        pieces += [t[i * cut:(i + 1) * cut] for i in sorted(rng.choice(n, min(n, per), replace=False))]
    return b"".join(pieces)[-max(size, cut):]


class Sizes:
    """Compressed sizes of texts under the two dictionaries."""

    def __init__(self, good: bytes, bad: bytes):
        import zstandard

        def tool(d):
            kind = zstandard.DICT_TYPE_AUTO
            more = {"dict_data": zstandard.ZstdCompressionDict(d, dict_type=kind)} if len(d) >= 8 else {}
            return zstandard.ZstdCompressor(level=3, write_checksum=False, write_content_size=False,
                                            write_dict_id=False, **more)

        self.tools = tool(good), tool(bad)

    def difference(self, raw: bytes) -> tuple[int, int]:
        """(size under bad - size under good, length); (0, 0) for an empty text."""
        good, bad = (sum(len(t.compress(raw[i:i + PIECE])) for i in range(0, len(raw), PIECE)) for t in self.tools)
        return bad - good, len(raw)


def normalised(pairs: list[tuple[int, int]], mean: float) -> np.ndarray:
    d = np.array(pairs, float).reshape(-1, 2)
    return (d[:, 0] + PRIOR * mean) / (d[:, 1] + PRIOR)


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None, ridge: float = 1e-3) -> tuple[float, float]:
    """Slope and offset of a one-variable logistic curve (Newton steps, with
    half an example of either label so that separable data stay finite)."""
    w = np.ones(len(x)) if weight is None else weight.astype(float)
    if not w.sum():
        return 0.0, 0.0
    share = (w @ y + 0.5) / (w.sum() + 1)
    if y.min() == y.max():
        return 0.0, float(np.log(share / (1 - share)))
    scale = x.std() or 1.0
    z, t = x / scale, np.where(y > 0, 1 - 0.5 / (w @ y + 1), 0.5 / (w @ (1 - y) + 1))
    a, b = 0.0, float(np.log(share / (1 - share)))
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * z + b, -35, 35)))
        g = np.array([w @ ((t - p) * z) - ridge * a, w @ (t - p)])
        v = w * p * (1 - p) + 1e-9
        h = np.array([[v @ (z * z) + ridge, v @ z], [v @ z, v.sum()]])
        step = np.clip(np.linalg.solve(h, g), -2, 2)
        a, b = a + step[0], b + step[1]
        if abs(step).max() < 1e-8:
            break
    return float(a / scale), float(b)


def share(lengths: list[int], limit: int) -> int:
    """The largest length to which texts must be cut so that together they have at most ``limit`` bytes."""
    left = limit
    for i, n in enumerate(sorted(lengths)):
        if n * (len(lengths) - i) > left:
            return left // (len(lengths) - i)
        left -= n
    return max(lengths, default=0)


def pieces(raw: bytes, limit: int) -> bytes:
    """A text of at most ``limit`` bytes, or evenly spaced pieces of a longer one."""
    if len(raw) <= limit:
        return raw
    size, n = min(PIECE, limit), max(1, limit // PIECE)
    return b"".join(raw[i:i + size] for i in np.linspace(0, len(raw) - size, n).astype(int))


def class_limits(rows: DataFrame, class_bytes: int) -> dict[int, int]:
    """By label, the length to which the texts of a sample (text, y) are cut so that a label has at most ``class_bytes``."""
    lengths: dict = {}
    for y, n in rows.select("y", F.octet_length("text")).collect():     # one number a sampled document
        lengths.setdefault(y, []).append(n)
    return {y: share(n, class_bytes) for y, n in lengths.items()}


def fit(docs: DataFrame, labels: DataFrame, where: Column | None = None, per_class: int = PER_CLASS,
        class_bytes: int = CLASS_BYTES) -> Model:
    """Dictionaries and curve from labelled documents (``labels.quality``).

    ``where`` restricts the label rows (column ``_id``).  Two thirds of the
    sample build the dictionaries, a third the curve."""
    rows = T.stored(T.labelled_sample(docs, labels, "quality", per_class, where), "quality-sample")
    limits = class_limits(rows, class_bytes)

    @F.arrow_udf("binary")
    def cut(text: pa.Array, y: pa.Array) -> pa.Array:
        return pa.array([pieces(raw, limits[c]) for raw, c in zip(T.utf8(text), y.to_pylist(), strict=True)], pa.binary())

    got = [(bytes(r[1]), int(r[2] > 0), T.py_bucket(f"cut-{r[0]}", 3) != 0)
           for r in rows.select("doc_id", cut("text", "y"), "y").orderBy(F.xxhash64("doc_id"), "doc_id").collect()]
    good, bad = (_dictionary([t for t, y, d in got if d and y == k]) for k in (1, 0))
    sizes = Sizes(good, bad)
    held = [(sizes.difference(t), y) for t, y, d in got if not d]
    pairs, y = [h[0] for h in held], np.array([h[1] for h in held], float)
    mean = sum(p[0] for p in pairs) / max(1, sum(p[1] for p in pairs))
    a, b = logistic(normalised(pairs, mean), y) if len(held) else (0.0, 0.0)
    return Model(good, bad, mean, a, b)


def score_column(spark, model: Model):
    """Arrow UDF: text -> probability that its label is 1 (NULL as empty text)."""
    shared = spark.sparkContext.broadcast(model)
    tools: list = []

    @F.arrow_udf("double")
    def score(text: pa.Array) -> pa.Array:
        m = shared.value
        if not tools:
            tools.append(Sizes(m.good, m.bad))
        d = normalised([tools[0].difference(raw) for raw in T.utf8(text)], m.mean)
        return pa.array(1 / (1 + np.exp(-np.clip(m.slope * d + m.offset, -35, 35))))

    return score


def classify(docs: DataFrame, labels: DataFrame, where: Column | None = None, threshold: float = 0.7,
             per_class: int = PER_CLASS) -> DataFrame:
    """``docs`` with ``_score`` (0 to 1) and ``_predicted`` (1 if at least ``threshold``).

    NULL texts score as empty ones; labels of absent documents, NULL labels
    and repeated label rows are ignored; without labels every score is 0.5.
    A text of any length is scored whole, piece by piece; rows that repeat have equal
    scores; an empty table gives no rows.  All columns of ``docs`` pass through."""
    T.prepare(docs.sparkSession)
    score = score_column(docs.sparkSession, fit(docs, labels, where, per_class))
    return (docs.withColumn("_score", score(F.col("text").cast("string")))
                .withColumn("_predicted", (F.col("_score") >= threshold).cast("int")))
