"""Toxic spans by a linear-chain conditional random field, and document scores from its marginals.

Labels say which documents are toxic, not where. Over all labelled documents that may be learnt from, the documents that have a unit
(a word, its first four or five bytes, its last four) are counted by label; units whose lower confidence bound of being in a toxic
document reaches one half are cues. A word of a toxic document with a cue is a toxic token, all other tokens of labelled documents are clean.

From those tokens the field learns two tags: weights of hashed units of a word and of its neighbours, and of the steps between tags. It
is fitted on windows of a bounded sample of labelled documents (``SAMPLE`` of each label, ``WINDOWS`` windows each). The forward and backward
passes over whole texts are products of 2 by 2 matrices: products inside chunks for all chunks at once, then from chunk to chunk. A document's
largest marginal and the evidence of all of them give its score by a logistic curve fitted on a second bounded sample. Runs of tokens whose
marginal reaches one half are the offending spans, in characters.

Tokens are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after A-Z has been lower-cased. Null and empty texts have no tokens, no spans and the least score. Repeated
rows get equal scores. Several labels of an id count as toxic if one does; a null id or label is no label. Without both kinds of labels every score is 0.5, without cues the share of toxic labels.
Empty tables give no rows. Columns of the names that are added are replaced. A long text is worked on in blocks of ``BLOCK`` tokens; about 60 bytes a token are held.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StructField, StructType

from weftline.llm import shared
from weftline.llm.registry import query, table
from weftline.llm.sampling import crc_of_id, hash_bound
from weftline.llm.words import LOWER, NOT_ALNUM, add_columns, find_words, hash_spans, mix, slices, text_buffer

#: Documents of each label that the field, and then the score, is fitted on; windows of a document and their tokens.
SAMPLE = 4000
WINDOWS = 2
WIDTH = 24
#: Cues are kept up to this number, the strongest first.
CUES = 20_000
CONFIDENCE = 2.5
ACCEPT = 0.7
SPAN = 0.5
LEFT_OUT = 0.4
BUCKET_BITS = 20
BLOCK = 1 << 19
CHUNK = 64
LABELS_A_RANGE = 500_000
FLUSH_UNITS = 2_000_000

# Units of a word: itself, its first four and five bytes, its last four; then the words before and after it.
KINDS = 4
SALTS = mix(np.arange(1, KINDS + 3, dtype=np.uint64))


# Tokens and units.

class Tokens:
    """Tokens of all texts in turn; ``doc`` has the text of each."""

    def __init__(self, texts: pa.Array):
        self.raw, self.offsets = text_buffer(texts)
        self.raw = LOWER[self.raw]
        self.start, self.end, self.doc = find_words(self.raw, self.offsets, NOT_ALNUM)
        self.n = len(self.offsets) - 1

    def units(self, low: int, high: int) -> np.ndarray:
        """Hashes of the units of the tokens from ``low`` to ``high``, a column for each kind."""
        start, end = self.start[low:high], self.end[low:high]
        spans = ((start, end), (start, np.minimum(start + 4, end)), (start, np.minimum(start + 5, end)), (np.maximum(end - 4, start), end))
        return np.stack([mix(hash_spans(self.raw, a, b) ^ SALTS[k]) for k, (a, b) in enumerate(spans)], axis=1)

    def features(self, low: int, high: int) -> np.ndarray:
        """Buckets of each token: its units and the words beside it in the same text (bucket 0 where there is none)."""
        first, last = max(low - 1, 0), min(high + 1, self.start.size)
        words = np.zeros(high - low + 2, np.uint64)
        words[first - low + 1:last - low + 1] = mix(hash_spans(self.raw, self.start[first:last], self.end[first:last]))
        doc = np.full(high - low + 2, -1)
        doc[first - low + 1:last - low + 1] = self.doc[first:last]
        out = np.zeros((high - low, KINDS + 2), np.int32)
        out[:, :KINDS] = _bucket(self.units(low, high))
        for k, other in ((KINDS, slice(0, -2)), (KINDS + 1, slice(2, None))):
            out[:, k] = np.where(doc[other] == doc[1:-1], _bucket(mix(words[other] ^ SALTS[k])), 0)
        return out


def _bucket(hashes: np.ndarray) -> np.ndarray:
    return np.maximum(hashes >> np.uint64(64 - BUCKET_BITS), np.uint64(1)).astype(np.int32)


# The field.

def _steps(scores: np.ndarray, first: np.ndarray, moves: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """A matrix for each token: from the tag before it to its own, scaled to at most 1."""
    out = np.empty((scores.size, 2, 2))
    out[:] = moves
    out[first] = begin
    out[:, :, 1] += scores[:, None]
    out -= out.max(axis=(1, 2), keepdims=True)
    return np.exp(out)


def _run(steps: np.ndarray, entry: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row vectors after each matrix, scaled to sum 1, and the last of them; ``entry`` goes in first."""
    n = len(steps)
    chunks = -(-n // CHUNK)
    padded = np.tile(np.eye(2), (chunks * CHUNK, 1, 1))
    padded[:n] = steps
    products = padded.reshape(chunks, CHUNK, 2, 2)
    for t in range(1, CHUNK):
        before, own = products[:, t - 1], products[:, t].copy()
        for j in range(2):
            products[:, t, :, j] = before[:, :, 0] * own[:, 0, j, None] + before[:, :, 1] * own[:, 1, j, None]
        products[:, t] /= products[:, t].max(axis=(1, 2))[:, None, None]
    entries = np.empty((chunks, 2))
    a, b = entry.tolist()
    for k, ((p, q), (r, s)) in enumerate(products[:, -1].tolist()):
        entries[k] = a, b
        a, b = a * p + b * r, a * q + b * s
        a, b = a / (a + b), b / (a + b)
    out = entries[:, 0, None, None] * products[:, :, 0] + entries[:, 1, None, None] * products[:, :, 1]
    out = out.reshape(-1, 2)[:n]
    return out / out.sum(axis=1, keepdims=True), np.array([a, b])


def marginals(scores: np.ndarray, first: np.ndarray, moves: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Probability of the toxic tag for each token of several texts in turn; ``first`` marks the first token of each."""
    n = scores.size
    forward, backward = np.empty(n), np.empty(n)
    entry = np.array([0.5, 0.5])
    for low in range(0, n, BLOCK):
        part = slice(low, min(low + BLOCK, n))
        found, entry = _run(_steps(scores[part], first[part], moves, begin), entry)
        forward[part] = found[:, 1]
    # Backwards the matrices are transposed, each applied to what follows its own token.
    entry = np.array([0.5, 0.5])
    for high in range(n, 0, -BLOCK):
        low = max(high - BLOCK, 0)
        turned = _steps(scores[low:high], first[low:high], moves, begin)[::-1].transpose(0, 2, 1)
        found, after = _run(turned, entry)
        backward[low:high] = np.append(entry[1], found[:-1, 1])[::-1]
        entry = after
    both = forward * backward
    return both / (both + (1 - forward) * (1 - backward))


def log_likelihood(scores: np.ndarray, tags: np.ndarray, inside: np.ndarray, moves: np.ndarray, begin: np.ndarray) -> tuple[float, np.ndarray, np.ndarray, np.ndarray]:
    """Log-likelihood of windows (rows) and its gradients by ``scores``, ``moves`` and ``begin``; ``inside`` marks the tokens of shorter windows."""
    rows, width = scores.shape
    emitted = np.zeros((rows, width, 2))
    emitted[:, :, 1] = scores
    alpha, beta = np.empty((rows, width, 2)), np.zeros((rows, width, 2))
    alpha[:, 0] = begin + emitted[:, 0]
    for t in range(1, width):
        step = np.logaddexp.reduce(alpha[:, t - 1, :, None] + moves, axis=1) + emitted[:, t]
        alpha[:, t] = np.where(inside[:, t, None], step, alpha[:, t - 1])
    total = np.logaddexp.reduce(alpha[:, -1], axis=1)
    for t in range(width - 2, -1, -1):
        step = np.logaddexp.reduce(moves + (emitted[:, t + 1] + beta[:, t + 1])[:, None, :], axis=2)
        beta[:, t] = np.where(inside[:, t + 1, None], step, beta[:, t + 1])
    each = np.exp(alpha + beta - total[:, None, None]) * inside[:, :, None]
    truth = np.stack([1 - tags, tags], axis=2) * inside[:, :, None]
    pairs = np.exp(alpha[:, :-1, :, None] + moves + (emitted[:, 1:] + beta[:, 1:])[:, :, None, :] - total[:, None, None, None]) * inside[:, 1:, None, None]
    seen = truth[:, :-1, :, None] * truth[:, 1:, None, :]
    said = (truth[:, :, 1] * scores).sum() + (truth[:, 0] * begin).sum() + (seen * moves).sum()
    return float(said - total.sum()), (truth - each)[:, :, 1], (seen - pairs).sum(axis=(0, 1)), (truth - each)[:, 0].sum(axis=0)


def fit_field(features: np.ndarray, tags: np.ndarray, inside: np.ndarray, updates: int = 600, batch: int = 256, rate: float = 0.2, decay: float = 1e-6) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(weights of buckets, moves, begin) by AdaGrad over windows, some ``updates`` steps whatever their number; ``features`` has buckets by window, token and kind."""
    weights, sums = np.zeros(1 << BUCKET_BITS, np.float64), np.full(1 << BUCKET_BITS, 1e-3)
    small = {"moves": np.zeros((2, 2)), "begin": np.array([0.0, -2.0])}
    small_sums = {k: np.full(v.shape, 1e-3) for k, v in small.items()}
    order = np.random.default_rng(1)
    for _ in range(-(-updates * batch // max(len(features), batch))):
        shuffled = order.permutation(len(features))
        for at in range(0, len(shuffled), batch):
            own = shuffled[at:at + batch]
            live = inside[own]
            # Features left out at random: a word that was never seen must do with those it shares with others.
            f = np.where(order.random(features[own].shape) < LEFT_OUT, 0, features[own])
            _, by_score, by_moves, by_begin = log_likelihood(weights[f].sum(axis=2), tags[own], live, small["moves"], small["begin"])
            where, back = np.unique(f[live], return_inverse=True)
            gradient = np.bincount(back.ravel(), np.repeat(by_score[live], f.shape[2]), minlength=where.size) / len(own) - decay * weights[where]
            sums[where] += gradient ** 2
            weights[where] += rate * gradient / np.sqrt(sums[where])
            weights[0] = 0
            for k, g in (("moves", by_moves / len(own)), ("begin", by_begin / len(own))):
                small_sums[k] += g ** 2
                small[k] = small[k] + rate * g / np.sqrt(small_sums[k])
    return weights.astype(np.float32), small["moves"], small["begin"]


@dataclass
class Model:
    """A fitted field, its weights as a mapped file, and the curve of the score; without a field every score is ``share``."""

    share: float
    folder: str = ""
    moves: np.ndarray | None = None
    begin: np.ndarray | None = None
    curve: np.ndarray | None = None

    def probabilities(self, tokens: Tokens) -> np.ndarray:
        n = tokens.start.size
        if self.moves is None or not n:
            return np.zeros(n)
        weights = shared.mapped(self.folder, "weights").view(np.float32)
        scores = np.concatenate([weights[tokens.features(low, min(low + BLOCK, n))].sum(axis=1) for low in range(0, n, BLOCK)])
        return marginals(scores, np.diff(tokens.doc, prepend=-1) != 0, self.moves, self.begin)

    def evidence(self, tokens: Tokens, chances: np.ndarray) -> np.ndarray:
        """For each text its largest marginal and the evidence of all marginals."""
        out = np.zeros((tokens.n, 2))
        np.maximum.at(out[:, 0], tokens.doc, chances)
        out[:, 1] = np.log1p(np.bincount(tokens.doc, -np.log1p(-np.minimum(chances, 1 - 1e-9)), minlength=tokens.n))
        return out

    def scores(self, evidence: np.ndarray) -> np.ndarray:
        if self.curve is None:
            return np.full(len(evidence), self.share)
        return 0.5 * (1 + np.tanh(0.5 * (evidence @ self.curve[:2] + self.curve[2])))


def fit_curve(rows: np.ndarray, toxic: np.ndarray, weight: np.ndarray, decay: float = 1e-4, steps: int = 30) -> np.ndarray:
    """Weights of a logistic curve over ``rows`` and a constant, by Newton steps."""
    x, w = np.hstack([rows, np.ones((len(rows), 1))]), np.zeros(rows.shape[1] + 1)
    weight = weight / weight.sum()
    for _ in range(steps):
        p = 0.5 * (1 + np.tanh(0.5 * (x @ w)))
        slope = x.T @ (weight * (toxic - p)) - decay * w
        bend = (x * (weight * p * (1 - p))[:, None]).T @ x + decay * np.eye(w.size)
        w = w + np.linalg.solve(bend, slope)
    return w


# Labels as mapped arrays.

def _range_of(ids: np.ndarray, ranges: int) -> np.ndarray:
    return (mix(ids.view(np.uint64)) % np.uint64(ranges)).astype(np.int64)


def write_labels(labels: DataFrame, folder: str) -> tuple[int, int, int]:
    """Files of (doc_id, toxic) in order of ids; (number of files, toxic ids, clean ids). ``labels`` has one row for each id."""
    counts = {r.toxic: r.n for r in labels.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    ranges = max(1, -(-sum(counts.values()) // LABELS_A_RANGE))

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_numpy().astype(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(_range_of(ids, ranges))], names=["doc_id", "toxic", "range"])

    def write(group: pa.Table) -> pa.Table:
        ids, toxic = group.column("doc_id").to_numpy(), group.column("toxic").to_numpy()
        order = np.argsort(ids)
        shared.put(folder, f"labels-{group.column('range')[0].as_py():07d}", ids[order], toxic[order].astype(np.uint8))
        return pa.table({"done": pa.array([group.num_rows], pa.int64())})

    labels.select("doc_id", "toxic").mapInArrow(spread, "doc_id long, toxic int, range long").groupBy("range").applyInArrow(write, "done long").write.format("noop").mode("overwrite").save()
    return ranges, counts.get(1, 0), counts.get(0, 0)


def labels_of(ids: pa.Array, folder: str, ranges: int) -> np.ndarray:
    """1 or 0 for labelled ids, else -1."""
    out, known = np.full(len(ids), -1, np.int64), np.asarray(ids.is_valid())
    own = ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    at = _range_of(own, ranges)
    for r in np.unique(at[known]).tolist():
        rows = np.flatnonzero(known & (at == r))
        try:
            sorted_ids, toxic = shared.columns(shared.mapped(folder, f"labels-{r:07d}"), "i8", "u1")
        except FileNotFoundError:  # no label in this range
            continue
        place = np.minimum(np.searchsorted(sorted_ids, own[rows]), sorted_ids.size - 1)
        met = sorted_ids[place] == own[rows]
        out[rows[met]] = toxic[place[met]]
    return out


# Cues.

def lower_bound(toxic: np.ndarray, clean: np.ndarray, confidence: float = CONFIDENCE) -> np.ndarray:
    """Lower bound (Wilson) of the share of toxic documents among those of a unit."""
    n = np.maximum(toxic + clean, 1)
    p, z = toxic / n, confidence * confidence / n
    return (p + z / 2 - np.sqrt(z * (p * (1 - p) + z / 4))) / (1 + z)


def _labelled(batches: Iterator[pa.RecordBatch], folder: str, ranges: int, wanted: int | None = None) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Slices of the labelled rows, or of those with one label, and their labels."""
    for batch in batches:
        toxic = labels_of(batch.column("doc_id"), folder, ranges)
        keep = toxic >= 0 if wanted is None else toxic == wanted
        kept, toxic = batch.filter(pa.array(keep)), toxic[keep]
        at = 0
        for part in slices(kept, "text"):
            yield part, toxic[at:at + part.num_rows]
            at += part.num_rows


def _units_by_document(tokens: Tokens) -> tuple[np.ndarray, np.ndarray]:
    """(unit, text): every different unit of each text once."""
    units = tokens.units(0, tokens.start.size).ravel()
    doc = np.repeat(tokens.doc, KINDS)
    order = np.lexsort((units, doc))
    units, doc = units[order], doc[order]
    fresh = np.ones(units.size, bool)
    fresh[1:] = (units[1:] != units[:-1]) | (doc[1:] != doc[:-1])
    return units[fresh], doc[fresh]


def find_cues(docs: DataFrame, folder: str, ranges: int, limit: int = CUES) -> np.ndarray:
    """Units whose documents are mostly toxic, in order, from all labelled rows of ``docs`` (doc_id, text)."""
    def in_toxic(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            units, counts = np.unique(np.concatenate(held) if held else np.zeros(0, np.uint64), return_counts=True)
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(units.view(np.int64)), pa.array(counts.astype(np.int64))], names=["unit", "toxic"])

        for part, _ in _labelled(batches, folder, ranges, 1):
            held.append(_units_by_document(Tokens(part.column("text")))[0])
            if sum(map(len, held)) >= FLUSH_UNITS:
                yield flush()
        yield flush()

    # A unit in fewer toxic documents than that can't be a cue.
    least = int(np.ceil(CONFIDENCE ** 2))
    summed = docs.mapInArrow(in_toxic, "unit long, toxic long").groupBy("unit").agg(F.sum("toxic").alias("toxic")).filter(F.col("toxic") >= least)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        units = [b.column("unit").to_numpy().view(np.uint64) for b in batches]
        counts = np.sort(np.concatenate(units)) if units else np.zeros(0, np.uint64)
        name = f"candidates-{TaskContext.get().partitionId():06d}"
        if counts.size:
            shared.put(folder, name, counts)
        yield pa.RecordBatch.from_pydict({"name": pa.array([name] if counts.size else [], pa.string())})

    names = sorted(r.name for r in summed.select("unit").mapInArrow(write, "name string").collect())

    def everywhere(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = [shared.mapped(folder, n).view(np.uint64) for n in names]
        counts = [np.zeros((f.size, 2), np.int64) for f in files]
        for part, toxic in _labelled(batches, folder, ranges):
            units, doc = _units_by_document(Tokens(part.column("text")))
            for kind in (0, 1):
                own, n = np.unique(units[toxic[doc] == kind], return_counts=True)
                for file, count in zip(files, counts, strict=True):
                    place = np.minimum(np.searchsorted(file, own), file.size - 1)
                    met = file[place] == own
                    count[place[met], kind] += n[met]
        for file, count in zip(files, counts, strict=True):
            met = count.any(axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(file[met].view(np.int64)), pa.array(count[met, 1]), pa.array(count[met, 0])], names=["unit", "toxic", "clean"])

    if not names:
        return np.zeros(0, np.uint64)
    n, z = F.col("toxic") + F.col("clean"), CONFIDENCE ** 2
    bound = (F.col("toxic") + z / 2 - CONFIDENCE * F.sqrt(F.col("toxic") * F.col("clean") / n + z / 4)) / (n + z)
    found = docs.mapInArrow(everywhere, "unit long, toxic long, clean long").groupBy("unit").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    kept = found.withColumn("bound", bound).filter("bound >= 0.5").orderBy(F.desc("bound"), "unit").limit(limit).select("unit")
    return np.sort(np.array([r.unit for r in kept.collect()], np.int64).view(np.uint64))


def tags_of(tokens: Tokens, toxic: np.ndarray, cues: np.ndarray) -> np.ndarray:
    """1 for tokens of toxic texts that have a cue."""
    units = tokens.units(0, tokens.start.size)
    place = np.minimum(np.searchsorted(cues, units), cues.size - 1)
    return ((cues[place] == units).any(axis=1) & (toxic[tokens.doc] == 1)).astype(np.int64)


# Fitting.

def _draw(docs: DataFrame, size: int, rows: int, salt: str) -> DataFrame:
    """Rows of ``docs`` drawn by a hash of their id: some ``size`` of the ``rows`` labelled ones of one label."""
    drawn = docs.withColumn("_draw", F.shiftrightunsigned(F.xxhash64(F.lit(salt), "doc_id"), 1))
    return drawn.filter(F.col("_draw") <= hash_bound((1.2 * size + 20) / max(rows, 1)))


def _windows(docs: DataFrame, folder: str, ranges: int, cues: np.ndarray, label: int, rows: int, size: int) -> list:
    """Windows of drawn documents of one label, as (buckets, tags) of ``WIDTH`` tokens or fewer."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, toxic in _labelled(batches, folder, ranges, label):
            tokens = Tokens(part.column("text"))
            tags = tags_of(tokens, toxic, cues)
            counts = np.bincount(tokens.doc, minlength=tokens.n)
            first = np.cumsum(counts) - counts
            draws, said, truth = [], [], []
            for i, draw in enumerate(part.column("_draw").to_pylist()):
                # A toxic text without a cue says nothing about its tokens.
                marked = np.flatnonzero(tags[first[i]:first[i] + counts[i]])
                if not counts[i] or (label and not marked.size):
                    continue
                for w in range(WINDOWS):
                    pick = int(mix(np.array([draw + w], np.uint64))[0])
                    middle = int(marked[pick % marked.size]) if label and not w else pick % int(counts[i])
                    low = first[i] + max(0, min(middle - WIDTH // 2, int(counts[i]) - WIDTH))
                    high = min(low + WIDTH, first[i] + int(counts[i]))
                    draws.append(draw)
                    said.append(tokens.features(low, high).tobytes())
                    truth.append(tags[low:high].astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(draws, pa.int64()), pa.array(said, pa.binary()), pa.array(truth, pa.binary())], names=["draw", "buckets", "tags"])

    drawn = _draw(docs, size, rows, "windows").mapInArrow(cut, "draw long, buckets binary, tags binary")
    return drawn.orderBy("draw", "buckets").limit(size * WINDOWS).collect()


def _evidence(docs: DataFrame, model: Model, folder: str, ranges: int, label: int, rows: int, size: int) -> np.ndarray:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, _ in _labelled(batches, folder, ranges, label):
            tokens = Tokens(part.column("text"))
            own = model.evidence(tokens, model.probabilities(tokens))
            yield pa.RecordBatch.from_arrays([part.column("_draw"), pa.array(own[:, 0]), pa.array(own[:, 1])], names=["draw", "a", "b"])

    drawn = _draw(docs, size, rows, "curve").mapInArrow(run, "draw long, a double, b double").orderBy("draw", "a", "b").limit(size)
    return np.array([(r.a, r.b) for r in drawn.select("a", "b").collect()]).reshape(-1, 2)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Learn from all rows of ``docs`` (doc_id, text) that ``labels`` (doc_id, toxic) names."""
    folder = shared.new_folder(docs.sparkSession, "toxicity")
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    known = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    ranges, toxic, clean = write_labels(known, folder)
    if not toxic or not clean:
        return Model(0.5)
    share = toxic / (toxic + clean)
    cues = find_cues(docs, folder, ranges)
    if not cues.size:
        return Model(share)
    rows = [r for label, n in ((1, toxic), (0, clean)) for r in _windows(docs, folder, ranges, cues, label, n, sample)]
    features, tags, inside = np.zeros((len(rows), WIDTH, KINDS + 2), np.int32), np.zeros((len(rows), WIDTH), np.int64), np.zeros((len(rows), WIDTH), bool)
    for i, r in enumerate(rows):
        n = len(r.tags)
        features[i, :n], tags[i, :n], inside[i, :n] = np.frombuffer(r.buckets, np.int32).reshape(n, -1), np.frombuffer(r.tags, np.uint8), True
    if not tags.any():
        return Model(share)
    weights, moves, begin = fit_field(features, tags, inside)
    shared.put(folder, "weights", weights)
    model = Model(share, folder, moves, begin)
    found = [_evidence(docs, model, folder, ranges, label, n, sample) for label, n in ((1, toxic), (0, clean))]
    if not len(found[0]) or not len(found[1]):
        return Model(share)
    truth = np.repeat([1.0, 0.0], [len(f) for f in found])
    weight = np.concatenate([np.full(len(f), part / len(f)) for f, part in zip(found, (share, 1 - share), strict=True)])
    model.curve = fit_curve(np.concatenate(found), truth, weight)
    return model


# Results.

def spans_of(tokens: Tokens, chances: np.ndarray, least: float = SPAN) -> pa.Array:
    """For each text the (start, end) in characters of runs of tokens whose marginal is ``least`` or more."""
    hit = chances >= least
    same = np.diff(tokens.doc, prepend=-1) == 0
    begins = np.flatnonzero(hit & ~(np.append(False, hit[:-1]) & same))
    stops = np.flatnonzero(hit & ~(np.append(hit[1:], False) & np.append(same[1:], False)))
    counts = np.bincount(tokens.doc[begins], minlength=tokens.n)
    # Characters up to a byte: all bytes but those that go on with a character.
    upto = np.append(0, np.cumsum((tokens.raw & 0xC0) != 0x80))
    base = upto[tokens.offsets[tokens.doc[begins]]]
    pairs = pa.StructArray.from_arrays([pa.array(upto[tokens.start[begins]] - base), pa.array(upto[tokens.end[stops]] - base)], names=["start", "end"])
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts)).astype(np.int32)), pairs)


def score(df: DataFrame, model: Model, text: str = "text", accept: float = ACCEPT) -> DataFrame:
    """``df`` with score, predicted (1 from ``accept`` on) and the offending ``spans``."""
    span = StructType([StructField("start", LongType()), StructField("end", LongType())])
    added = StructType([StructField("score", DoubleType()), StructField("predicted", IntegerType()), StructField("spans", ArrayType(span))])

    def compute(texts: pa.Array, _: pa.RecordBatch) -> dict[str, object]:
        tokens = Tokens(texts)
        chances = model.probabilities(tokens)
        found = model.scores(model.evidence(tokens, chances))
        return {"score": pa.array(found, pa.float64()), "predicted": pa.array((found >= accept).astype(np.int32)), "spans": spans_of(tokens, chances)}

    return add_columns(df, text, added, compute)


def fit_labels(docs: DataFrame, labels: DataFrame) -> Model:
    """Fit on the rows that aren't held out: those whose crc32 of the id leaves another remainder than 1 by 3."""
    learn = crc_of_id(F.col("doc_id")) % 3 != 1
    return fit(docs.filter(learn), labels.filter(learn))


@query("op11_toxicity")
def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_labels(docs, table(spark, sf_dir, "labels"))
    held = (crc_of_id(F.col("doc_id")) % 3 == 1).alias("held_out")
    return score(docs, model).select("doc_id", held, "score", "predicted", "spans")
