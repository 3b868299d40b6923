"""Quality classifier by positive-unlabelled learning.

Trusted positives (labels that say quality 1) and a sample of all text are what it learns from; no negatives are
needed. First a plain classifier tells positives from unlabelled text; where its scores are highest, the ratio of
unlabelled to positive rows bounds the share of positives from above, and the best bound estimates the class prior.
Then logistic weights minimise the non-negative unbiased risk: the positives' loss times the prior, plus the loss of
unlabelled text as negatives less the positives' part of it, kept from falling below zero by stepping back.

Features come from whole texts: shares of byte classes and of their pairs, repeated, shouted and symbol words,
different words, word lengths and repeated lines. The samples are bounded by ``POSITIVES`` and ``UNLABELLED`` and drawn by hash.

Null and empty texts have all features zero and get the score that follows from them. Without positives nothing can
be learnt and every score is 0.5. Columns of the names that are added are replaced; repeated rows get equal scores.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from weftline.llm.registry import query, table
from weftline.llm.sampling import crc_of_id, draw
from weftline.llm.words import LOWER, SPACES, add_columns, find_words, hash_spans, text_buffer

POSITIVES = 20_000
UNLABELLED = 40_000
ACCEPT = 0.7
STEPS = 600
STEP_BACK = 1.0

# Byte classes: lower, upper, digit, space, line feed, full stop or comma, other ASCII, not ASCII.
CLASSES = np.full(256, 6, np.int64)
CLASSES[0x61:0x7B], CLASSES[0x41:0x5B], CLASSES[0x30:0x3A], CLASSES[0x80:] = 0, 1, 2, 7
CLASSES[[0x20, 0x09]], CLASSES[[0x0A, 0x0D]], CLASSES[[0x2E, 0x2C]] = 3, 4, 5
N_CLASSES = 8
LINE_FEED = np.zeros(256, bool)
LINE_FEED[0x0A] = True
N_FEATURES = N_CLASSES + N_CLASSES ** 2 + 9


def features(texts: pa.Array) -> np.ndarray:
    """A row of ``N_FEATURES`` numbers for each text."""
    raw, offsets = text_buffer(texts)
    n, sizes = len(offsets) - 1, np.diff(offsets)
    out = np.zeros((n, N_FEATURES), np.float32)
    if not raw.size:
        return out
    doc, kind = np.repeat(np.arange(n), sizes), CLASSES[raw]
    out[:, :N_CLASSES] = np.bincount(doc * N_CLASSES + kind, minlength=n * N_CLASSES).reshape(n, -1) / np.maximum(sizes, 1)[:, None]
    pair = doc[:-1] * N_CLASSES ** 2 + kind[:-1] * N_CLASSES + kind[1:]
    pair = pair[doc[:-1] == doc[1:]]
    at = N_CLASSES + N_CLASSES ** 2
    out[:, N_CLASSES:at] = np.bincount(pair, minlength=n * N_CLASSES ** 2).reshape(n, -1) / np.maximum(sizes - 1, 1)[:, None]
    start, end, owner = find_words(raw, offsets, SPACES)
    words = np.maximum(np.bincount(owner, minlength=n), 1)

    def share(mask: np.ndarray, own: np.ndarray = owner, of: np.ndarray = words) -> np.ndarray:
        return np.bincount(own[mask], minlength=n) / of

    hashes = hash_spans(LOWER[raw], start, end)
    again = np.zeros(start.size, bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    out[:, at] = share(again)
    first_class, last_class = kind[start], kind[end - 1]
    upper = np.append(0, np.cumsum(kind == 1))
    letters = np.append(0, np.cumsum((kind < 2) | (kind == 7)))
    out[:, at + 1] = share((upper[end] - upper[start] == letters[end] - letters[start]) & (letters[end] - letters[start] > 1))
    out[:, at + 2] = share(letters[end] == letters[start])
    out[:, at + 3] = share((last_class == 6) & (end - start > 1))
    out[:, at + 4] = share(first_class == 6)
    order = np.lexsort((hashes, owner))
    fresh = np.ones(order.size, bool)
    fresh[1:] = (hashes[order][1:] != hashes[order][:-1]) | (owner[order][1:] != owner[order][:-1])
    # Different words, set against what texts of that length have: long texts repeat more.
    out[:, at + 5] = np.log(np.maximum(np.bincount(owner[order][fresh], minlength=n), 1)) - 0.8 * np.log(words)
    out[:, at + 6] = np.minimum(np.bincount(owner, (end - start).astype(float), minlength=n) / words, 40) / 10
    begin, stop, line_owner = find_words(raw, offsets, LINE_FEED)
    lines = np.maximum(np.bincount(line_owner, minlength=n), 1)
    line = hash_spans(raw, begin, stop)
    order = np.lexsort((line, line_owner))
    same = np.zeros(order.size, bool)
    same[1:] = (line[order][1:] == line[order][:-1]) & (line_owner[order][1:] == line_owner[order][:-1])
    out[:, at + 7] = share(same, line_owner[order], lines)
    out[:, at + 8] = np.log1p(sizes) / 10
    return out


class Model:
    """Logistic weights over scaled features; without ``weights`` every score is 0.5."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, weights: np.ndarray | None, prior: float = float("nan")):
        self.mean, self.scale, self.weights, self.prior = mean, scale, weights, prior

    def scores(self, rows: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(rows), 0.5)
        return _sigmoid(_scaled(rows, self.mean, self.scale) @ self.weights)


def _scaled(rows: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    z = np.clip((rows.astype(np.float64) - mean) / scale, -8, 8)
    return np.hstack([z, np.ones((len(rows), 1))])


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * z))


def _adam(gradient, size: int, steps: int, rate: float = 0.05) -> np.ndarray:
    w, m, v = np.zeros(size), np.zeros(size), np.zeros(size)
    for t in range(1, steps + 1):
        g = gradient(w)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - rate * (1 - t / (steps + 1)) * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return w


def class_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Share of positives among unlabelled rows from scores of held-out rows: the least ratio of the shares that lie above a bound.

    Each ratio carries a margin for its sampling error, so that a bound with few rows above it isn't taken.
    """
    bounds = np.unique(positive)
    above_p = 1 - np.searchsorted(np.sort(positive), bounds, "left") / positive.size
    above_u = 1 - np.searchsorted(np.sort(unlabelled), bounds, "left") / unlabelled.size
    margin = 1 / np.sqrt(positive.size) + 1 / np.sqrt(unlabelled.size)
    best = int(np.argmin((above_u + margin) / above_p))
    return float(np.clip(above_u[best] / above_p[best], 0.01, 0.99))


def fit_samples(positive: np.ndarray, unlabelled: np.ndarray, steps: int = STEPS, decay: float = 1e-3) -> Model:
    """Weights from feature rows of both samples."""
    mean, scale = np.zeros(N_FEATURES), np.ones(N_FEATURES)
    if not len(positive) or not len(unlabelled):
        return Model(mean, scale, None)
    mean, scale = unlabelled.mean(0), unlabelled.std(0) + 1e-3
    p, u = _scaled(positive, mean, scale), _scaled(unlabelled, mean, scale)
    size = p.shape[1]

    def tell_apart(w: np.ndarray) -> np.ndarray:
        return (_sigmoid(p[::2] @ w) - 1) @ p[::2] / len(p[::2]) + _sigmoid(u[::2] @ w) @ u[::2] / len(u[::2]) + decay * w

    first = _adam(tell_apart, size, steps // 2)
    held_p, held_u = (p[1::2], u[1::2]) if len(p) > 1 and len(u) > 1 else (p, u)
    prior = class_prior(held_p @ first, held_u @ first)

    def risk(w: np.ndarray) -> np.ndarray:
        fp, fu = p @ w, u @ w
        as_negative = np.logaddexp(0, fu).mean() - prior * np.logaddexp(0, fp).mean()
        down = _sigmoid(fu) @ u / len(u) - prior * (_sigmoid(fp) @ p) / len(p)
        if as_negative < 0:
            return -STEP_BACK * down
        return prior * ((_sigmoid(fp) - 1) @ p) / len(p) + down + decay * w

    return Model(mean, scale, _adam(risk, size, steps), prior)


def _feature_rows(df: DataFrame, size: int) -> np.ndarray:
    """Features of the first ``size`` drawn rows."""
    def run(batches):
        from weftline.llm.words import slices

        for batch in batches:
            for part in slices(batch, "text"):
                rows = features(part.column("text"))
                yield pa.RecordBatch.from_arrays([part.column("_draw"), pa.array([r.tobytes() for r in rows], pa.binary())], names=["_draw", "row"])

    drawn = df.select("_draw", "text").mapInArrow(run, "_draw long, row binary").orderBy("_draw", "row").limit(size)
    return np.array([np.frombuffer(r.row, np.float32) for r in drawn.select("row").collect()]).reshape(-1, N_FEATURES)


def fit(docs: DataFrame, positives: DataFrame, text: str = "text", n_positives: int = POSITIVES, n_unlabelled: int = UNLABELLED) -> Model:
    """Fit on ``docs`` (doc_id, text) with ``positives`` (doc_id) as trusted ids. Both samples are bounded."""
    docs = docs.select("doc_id", docs[f"`{text}`"].alias("text"))
    # At most ``n_positives`` ids are sent out.
    trusted = draw(positives.select("doc_id").filter("doc_id IS NOT NULL").distinct(), n_positives, "doc_id").orderBy("_draw").limit(n_positives)
    own = docs.join(F.broadcast(trusted), "doc_id").select("_draw", "text")
    return fit_samples(_feature_rows(own, n_positives), _feature_rows(draw(docs, n_unlabelled, "doc_id", "text"), n_unlabelled))


def score(df: DataFrame, model: Model, text: str = "text", accept: float = ACCEPT) -> DataFrame:
    """``df`` with score and predicted (1 from ``accept`` on)."""
    added = StructType([StructField("score", DoubleType()), StructField("predicted", IntegerType())])

    def compute(texts: pa.Array, _: pa.RecordBatch) -> dict[str, object]:
        found = model.scores(features(texts))
        return {"score": pa.array(found, pa.float64()), "predicted": pa.array((found >= accept).astype(np.int32), pa.int32())}

    return add_columns(df, text, added, compute)


def fit_labels(docs: DataFrame, labels: DataFrame) -> Model:
    """Fit on the rows that aren't held out: those whose crc32 of the id leaves another remainder than 2 by 4."""
    learn = crc_of_id(F.col("doc_id")) % 4 != 2
    return fit(docs.filter(learn), labels.filter(learn & (F.col("quality") == 1)))


@query("op2_quality")
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_labels(docs, table(spark, sf_dir, "labels"))
    held = (crc_of_id(F.col("doc_id")) % 4 == 2).alias("held_out")
    return score(docs, model).select("doc_id", held, "score", "predicted")
