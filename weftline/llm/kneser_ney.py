"""Interpolated modified Kneser-Ney n-gram model: counted in Spark, stored as sorted hash arrays, mapped for scoring.

Counting. A task counts the n-grams of its texts and packs them by hash range: a package has the different words once
and n-grams as numbers of them. The packages of a range meet in one group, whose size follows from the bytes of text
for each range and not from the number of equal n-grams: each task sends an n-gram once. A group adds up its n-grams,
writes them as a sorted array of hashes with small counts, and sends what the next lower order needs: for each n-gram
without its first word one more left neighbour, for each without its last word its followers and how many of those
were met once, twice or more often. The same happens a level down until single words are left.

Storing. A range of an order is one file in the shared folder; files in order of their ranges make one sorted array.
Counts take a byte, larger ones stand in a list beside them. Workers map the files and search them with sorted keys.

The lowest order is interpolated with a uniform share over all known words and one unknown. A text starts after a
mark that is never predicted and ends with the end token. Orders below the highest count left neighbours, but n-grams
that begin at the start of a text keep their counts.

Null and empty texts have the end token alone. Without training texts every probability is that of the uniform share.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from weftline.llm import shared
from weftline.llm.registry import query, table
from weftline.llm.sampling import crc_of_id
from weftline.llm.words import LOWER, SPACES, add_columns, find_words, fold, hash_spans, slices, text_buffer

ORDER = 2
#: Bytes of text for each hash range; a group holds at most the n-grams of so much text.
RANGE_BYTES = 12 << 20
FLUSH_NGRAMS = 2_000_000
BEGIN, END = np.uint64(0x6A09E667F3BCC908), np.uint64(0xBB67AE8584CAA73B)
#: Counts of a stored n-gram. The first belongs to the n-gram, the others to it as a context.
FIELDS = ("raw", "left", "total", "once", "twice", "more")
PACKAGE = "level int, range int, package binary"


def sequences(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes of all texts in turn, each between its two marks; place in its text of each; text of each)."""
    raw, offsets = text_buffer(texts)
    raw = LOWER[raw]
    start, end, doc = find_words(raw, offsets, SPACES)
    n = len(offsets) - 1
    counts = np.bincount(doc, minlength=n) + 2
    first = np.cumsum(counts) - counts
    out = np.empty(int(counts.sum()), np.uint64)
    out[first], out[first + counts - 1] = BEGIN, END
    owner = np.repeat(np.arange(n), counts)
    place = np.arange(out.size) - first[owner]
    inner = np.ones(out.size, bool)
    inner[first] = inner[first + counts - 1] = False
    out[inner] = hash_spans(raw, start, end)
    return out, place, owner


def key_of(words: np.ndarray) -> np.ndarray:
    """Hash of n-grams given as rows of word hashes; single words are their own hash."""
    key = words[:, 0]
    for k in range(1, words.shape[1]):
        key = fold(key, words[:, k])
    return key


def range_of(keys: np.ndarray, ranges: int) -> np.ndarray:
    return (((keys >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)).astype(np.int64)


def summed(words: np.ndarray, fields: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(keys, words, fields) of the different rows of ``words`` in order of their keys; fields are added up."""
    keys = key_of(words)
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if keys.size else np.zeros(0, np.int64)
    out = np.stack([np.add.reduceat(f[order], first) for f in fields]) if keys.size else fields
    return keys[first], words[order[first]], out


# Packages.

def pack(words: np.ndarray, fields: np.ndarray) -> bytes:
    vocabulary, ids = np.unique(words, return_inverse=True)
    ids = ids.reshape(words.shape).T
    kind = np.uint16 if vocabulary.size < 1 << 16 else np.uint32
    small = fields.max(initial=0) < 256
    body = vocabulary.tobytes() + ids.astype(kind).tobytes() + fields.astype(np.uint8 if small else np.int64).tobytes()
    header = np.array([len(words), words.shape[1], len(fields), vocabulary.size, np.dtype(kind).itemsize, small, len(body)], np.int64)
    return header.tobytes() + pa.compress(body, "zstd", asbytes=True)


def unpack(package: bytes) -> tuple[np.ndarray, np.ndarray]:
    n, width, n_fields, size, kind, small, full = np.frombuffer(package, np.int64, 7).tolist()
    body = pa.decompress(package[56:], full, "zstd", asbytes=True)
    vocabulary = np.frombuffer(body, np.uint64, size)
    ids = np.frombuffer(body, np.uint16 if kind == 2 else np.uint32, n * width, 8 * size).reshape(width, n)
    fields = np.frombuffer(body, np.uint8 if small else np.int64, n * n_fields, 8 * size + kind * n * width).reshape(n_fields, n)
    return vocabulary[ids].T, fields


def packages(level: int, keys: np.ndarray, words: np.ndarray, fields: np.ndarray, ranges: int) -> Iterator[pa.RecordBatch]:
    """One package for each range; rows stand in order of their keys."""
    at = range_of(keys, ranges)
    edges = np.flatnonzero(np.diff(at, prepend=-1, append=ranges))
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        yield pa.RecordBatch.from_arrays([pa.array([level], pa.int32()), pa.array([at[a]], pa.int32()), pa.array([pack(words[a:b], fields[:, a:b])], pa.binary())], names=["level", "range", "package"])


# Files.

def pack_counts(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a byte for each count, places of those above 254, their values)."""
    large = np.flatnonzero(counts > 254)
    return np.minimum(counts, 255).astype(np.uint8), large.astype(np.int64), counts[large].astype(np.int64)


def write_range(folder: str, name: str, keys: np.ndarray, fields: list[np.ndarray], statistics: list[int]) -> None:
    packed = [pack_counts(f) for f in fields]
    header = np.array([keys.size, len(fields), *statistics, *(p[1].size for p in packed)], np.int64)
    shared.put(folder, name, np.array([header.size], np.int64), header, keys, *(x for p in packed for x in (p[1], p[2])), *(p[0] for p in packed))


class Range:
    """A mapped file."""

    def __init__(self, raw: np.ndarray):
        size = int(raw[:8].view(np.int64)[0])
        header = raw[8:8 + 8 * size].view(np.int64).tolist()
        n, n_fields = header[:2]
        self.statistics, large, at = header[2:-n_fields], header[-n_fields:], 8 + 8 * size
        self.keys = raw[at:at + 8 * n].view(np.uint64)
        at += 8 * n
        self.large = []
        for m in large:
            self.large.append((raw[at:at + 8 * m].view(np.int64), raw[at + 8 * m:at + 16 * m].view(np.int64)))
            at += 16 * m
        self.small = [raw[at + i * n:at + (i + 1) * n] for i in range(n_fields)]

    def values(self, field: int, rows: np.ndarray) -> np.ndarray:
        out = self.small[field][rows].astype(np.int64)
        high = np.flatnonzero(out == 255)
        if high.size:
            places, values = self.large[field]
            out[high] = values[np.searchsorted(places, rows[high])]
        return out


def range_name(level: int, number: int) -> str:
    return f"order-{level}-{number:07d}"


@dataclass
class Model:
    """What a worker needs to find and read the arrays. ``discounts`` has D1, D2, D3 for each order."""

    folder: str
    order: int
    ranges: list[int]
    discounts: list[tuple[float, float, float]]
    tokens: int
    different: int
    left_total: int
    uniform_share: float

    def look_up(self, level: int, keys: np.ndarray) -> list[np.ndarray]:
        """Fields of each key at an order; zeros where it is unknown. The highest order has its count alone."""
        wanted, inverse = np.unique(keys, return_inverse=True)
        n_fields = 1 if level == self.order else len(FIELDS)
        out = np.zeros((n_fields, wanted.size), np.int64)
        at = range_of(wanted, self.ranges[level])
        edges = np.flatnonzero(np.diff(at, prepend=-1, append=self.ranges[level]))
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            try:
                held = Range(shared.mapped(self.folder, range_name(level, int(at[a]))))
            except FileNotFoundError:  # no n-gram fell into this range
                continue
            rows = np.minimum(np.searchsorted(held.keys, wanted[a:b]), held.keys.size - 1)
            met = np.flatnonzero(held.keys[rows] == wanted[a:b])
            for f in range(n_fields):
                out[f, a + met] = held.values(f, rows[met])
        return list(out[:, inverse])

    def discount(self, level: int, counts: np.ndarray) -> np.ndarray:
        return np.array([0.0, *self.discounts[level]])[np.minimum(counts, 3)]

    def probabilities(self, words: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(probability, training count) of each place of ``sequences`` that isn't a start mark."""
        told = np.flatnonzero(place > 0)
        key, context = words.copy(), None
        p, count = np.empty(0), np.empty(0, np.int64)
        for level in range(1, self.order + 1):
            fields = self.look_up(level, key)
            if level == 1:
                count, adjusted = fields[0][told], fields[1][told]
                p = np.full(told.size, self.uniform_share / (self.different + 1))
                if self.left_total:
                    p += (adjusted - self.discount(1, adjusted)) / self.left_total
            else:
                reach = place[told] >= level - 1
                begins = place[told] == level - 1
                _, _, total, once, twice, more = (f[told - 1] for f in context)
                known = reach & (total > 0)
                own = fields[0][told]
                if level < self.order:
                    own = np.where(begins, own, fields[1][told])
                d1, d2, d3 = self.discounts[level]
                # Contexts that don't reach so far back, or that training never met, leave the lower order as it is.
                divisor = np.where(known, total, 1)
                higher = ((own - self.discount(level, own)) + (d1 * once + d2 * twice + d3 * more) * p) / divisor
                p = np.where(known, higher, p)
            if level < self.order:
                context = fields
                # The n-gram one longer that ends at the same place.
                longer = key.copy()
                longer[1:] = _extend(words, level)[1:]
                key = longer
        return p, count


def _extend(words: np.ndarray, level: int) -> np.ndarray:
    """Keys of the (level + 1)-grams that end at each place; the first ``level`` places repeat the start."""
    columns = np.stack([words[np.maximum(np.arange(words.size) - back, 0)] for back in range(level, -1, -1)], 1)
    return key_of(columns)


def discounts_of(counts: list[int]) -> tuple[float, float, float]:
    """D1, D2, D3 from how many n-grams have the counts 1 to 4; fixed values where some don't occur."""
    n1, n2, n3, n4 = counts
    if not all(counts):
        return 0.5, 1.0, 1.5
    y = n1 / (n1 + 2 * n2)
    found = [k - (k + 1) * y * b / a for k, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]
    return tuple(min(max(d, 0.05), k) for k, d in enumerate(found, 1))


def train(df: DataFrame, text: str = "text", order: int = ORDER, range_bytes: int = RANGE_BYTES) -> Model:
    """Count all texts of ``df`` and store the model. ``order`` is 2 or more."""
    if order < 2:
        raise ValueError("order must be 2 or more")
    spark = df.sparkSession
    folder = shared.new_folder(spark, "kneser-ney")
    rows = df.select(df[f"`{text}`"].alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = [max(1, -(-size // range_bytes)) if k == order else max(1, -(-size // (4 * range_bytes))) for k in range(order + 1)]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for level, parts in held.items():
                keys, words, fields = summed(*(np.concatenate(x, axis) for x, axis in zip(zip(*parts, strict=True), (0, 1), strict=True)))
                yield from packages(level, keys, words, fields, ranges[level])
            held.clear()

        for batch in batches:
            for part in slices(batch, "text"):
                words, place, _ = sequences(part.column("text"))
                for level in range(2, order + 1):
                    ends = np.flatnonzero(place >= level - 1) if level == order else np.flatnonzero(place == level - 1)
                    grams = np.stack([words[ends - back] for back in range(level - 1, -1, -1)], 1)
                    held.setdefault(level, []).append(summed(grams, np.ones((1, ends.size), np.int64))[1:])
                if sum(len(w) for parts in held.values() for w, _ in parts) >= FLUSH_NGRAMS:
                    yield from flush()
        yield from flush()

    def merge(level: int):
        def run(group: pa.Table) -> pa.Table:
            out, parts = [], []
            for row_level, batch in zip(group.column("level").to_pylist(), group.to_batches(max_chunksize=1) if group.num_rows else [], strict=True):
                if row_level == level:
                    parts.append(unpack(batch.column("package")[0].as_py()))
                else:
                    out.append(batch.select(["level", "range", "package"]))
            if parts:
                fields = [np.vstack([f, np.zeros((len(FIELDS) - len(f), f.shape[1]), f.dtype)]) if level < order and len(f) == 1 else f for _, f in parts]
                keys, words, fields = summed(np.concatenate([w for w, _ in parts]), np.concatenate(fields, 1, dtype=np.int64))
                parts.clear()
                adjusted = fields[0] if level == order else np.where((words[:, 0] == BEGIN) & (level > 1), fields[0], fields[1])
                statistics = [int((adjusted == k).sum()) for k in (1, 2, 3, 4)] + [int((adjusted > 2).sum()), int(adjusted.sum()), int(fields[0].sum()), int((fields[0] > 0).sum())]
                number = int(range_of(keys[:1], ranges[level])[0])
                write_range(folder, range_name(level, number), keys, list(fields), statistics)
                if level > 1:
                    more = np.zeros((2, len(FIELDS), keys.size), np.int64)
                    more[0, 0], more[0, 1] = fields[0], 1
                    more[1, 2], more[1, 3], more[1, 4], more[1, 5] = adjusted, adjusted == 1, adjusted == 2, adjusted > 2
                    lower = summed(np.concatenate([words[:, 1:], words[:, :-1]]), np.concatenate([more[0], more[1]], 1))
                    out += packages(level - 1, *lower, ranges[level - 1])
            return pa.Table.from_batches(out, group.select(["level", "range", "package"]).schema)

        return run

    flowing = rows.mapInArrow(count, PACKAGE)
    for level in range(order, 0, -1):
        # Packages of lower orders ride along to any group.
        flowing = flowing.withColumn("group", F.col("range") % ranges[level]).groupBy("group").applyInArrow(merge(level), PACKAGE)
    flowing.write.format("noop").mode("overwrite").save()

    def statistics_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            levels, rows = [], []
            for level, number in zip(batch.column("level").to_pylist(), batch.column("range").to_pylist(), strict=True):
                try:
                    rows.append(Range(shared.mapped(folder, range_name(level, number))).statistics)
                    levels.append(level)
                except FileNotFoundError:  # no n-gram fell into this range
                    continue
            yield pa.RecordBatch.from_arrays([pa.array(levels, pa.int32()), *(pa.array([r[i] for r in rows], pa.int64()) for i in range(8))], names=["level", *(f"s{i}" for i in range(8))])

    files = spark.range(0).select(F.lit(1).alias("level"), F.col("id").cast("int").alias("range"))
    for level in range(1, order + 1):
        files = files.unionAll(spark.range(ranges[level]).select(F.lit(level).alias("level"), F.col("id").cast("int").alias("range")))
    schema = "level int, " + ", ".join(f"s{i} long" for i in range(8))
    sums = {r.level: list(r)[1:] for r in files.mapInArrow(statistics_of, schema).groupBy("level").agg(*[F.sum(f"s{i}").alias(f"s{i}") for i in range(8)]).collect()}
    by_level = [sums.get(k, [0] * 8) for k in range(order + 1)]
    discounts = [discounts_of(s[:4]) for s in by_level]
    n1, n2, _, _, more, left_total, tokens, different = by_level[1]
    d1, d2, d3 = discounts[1]
    return Model(folder, order, ranges, discounts, tokens, different, left_total, (d1 * n1 + d2 * n2 + d3 * more) / left_total if left_total else 1.0)


ADDED = StructType([StructField("n_tokens", LongType()), StructField("n_known", LongType()), StructField("train_tokens", LongType()),
                    StructField("base_score", DoubleType()), StructField("score", DoubleType()), StructField("perplexity", DoubleType())])


def score(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``df`` with the columns of ``ADDED``: log10 probabilities of whole texts and the perplexity by token."""
    def compute(texts: pa.Array, _: pa.RecordBatch) -> dict[str, object]:
        words, place, owner = sequences(texts)
        p, count = model.probabilities(words, place)
        owner, n = owner[place > 0], len(texts)
        tokens = np.bincount(owner, minlength=n)
        own = np.bincount(owner, np.log10(p), minlength=n)
        base = np.bincount(owner, np.log10((count + 0.5) / (model.tokens + 0.5 * (model.different + 1))), minlength=n)
        return {
            "n_tokens": pa.array(tokens, pa.int64()), "n_known": pa.array(np.bincount(owner[count > 0], minlength=n), pa.int64()),
            "train_tokens": pa.array(np.full(n, model.tokens), pa.int64()), "base_score": pa.array(base, pa.float64()),
            "score": pa.array(own, pa.float64()), "perplexity": pa.array(10 ** (-own / np.maximum(tokens, 1)), pa.float64())}

    return add_columns(df, text, ADDED, compute)


@query("op1_kneser_ney")
def op1_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held = crc_of_id(F.col("doc_id")) % 5 == 1
    model = train(docs.filter(~held))
    return score(docs, model).select("doc_id", held.alias("held_out"), *ADDED.fieldNames())
