"""Language identification by a convolutional network over bytes.

Texts are cut into windows of ``WINDOW`` bytes, the last one filled up with spaces. Filters of several widths slide
over a window; the highest value of each filter passes through a ramp and a softmax layer. A filter over one-hot bytes
is a sum of table rows, one table for each of its places. A text's logits are the mean over all its windows, by their bytes.
Learning runs in numpy on windows of labelled texts: at most ``DOCS_A_LANGUAGE`` texts a language, ``WINDOWS_A_DOC``
windows each, drawn by hash.

Null texts and texts without a letter are ``und`` with score 0. Without labelled texts all are ``und``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from weftline.llm.registry import query, table
from weftline.llm.sampling import crc_of_id, hash_bound
from weftline.llm.words import LOWER, add_columns, slices, text_buffer

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
DOCS_A_LANGUAGE = 1500
WINDOWS_A_DOC = 3
EPOCHS = 8
BATCH = 64
UNKNOWN = "und"
#: Under this score the filtering stage rejects a text.
LEAST_SCORE = 0.5
BLOCK = 256

LETTER = regex.compile(r"\p{L}")
ASCII_LETTER = np.zeros(256, bool)
ASCII_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True


def windows(raw: np.ndarray, offsets: np.ndarray, width: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(windows as rows of bytes, text of each window, bytes of the text in each window)."""
    sizes = np.diff(offsets)
    per = -(-sizes // width)
    doc = np.repeat(np.arange(sizes.size), per)
    index = np.arange(doc.size) - np.repeat(np.cumsum(per) - per, per)
    start = offsets[doc] + index * width
    length = np.minimum(offsets[doc + 1] - start, width)
    out = np.full((doc.size, width), 0x20, np.uint8)
    inside = np.arange(width) < length[:, None]
    out[inside] = raw
    return LOWER[out], doc, length


class Network:
    def __init__(self, languages: list[str], seed: int = 7):
        rng = np.random.default_rng(seed)
        self.languages = languages
        self.tables = [rng.normal(0, 0.1, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS]
        self.bias = np.zeros(FILTERS * len(WIDTHS), np.float32)
        self.out = rng.normal(0, 0.1, (FILTERS * len(WIDTHS), len(languages))).astype(np.float32)
        self.out_bias = np.zeros(len(languages), np.float32)

    def convolve(self, rows: np.ndarray, width: int) -> np.ndarray:
        """(window, place, filter) values of the filters of one width."""
        tables, places = self.tables[WIDTHS.index(width)], rows.shape[1] - width + 1
        values = tables[0][rows[:, :places]]
        for k in range(1, width):
            values += tables[k][rows[:, k:k + places]]
        return values

    def pooled(self, rows: np.ndarray) -> np.ndarray:
        highest = np.concatenate([self.convolve(rows, w).max(1) for w in WIDTHS], 1)
        return np.maximum(highest + self.bias, 0)

    def logits(self, rows: np.ndarray) -> np.ndarray:
        parts = [self.pooled(rows[i:i + BLOCK]) @ self.out + self.out_bias for i in range(0, len(rows), BLOCK)]
        return np.concatenate(parts) if parts else np.zeros((0, len(self.languages)), np.float32)

    def train(self, rows: np.ndarray, target: np.ndarray, epochs: int = EPOCHS, rate: float = 0.01, seed: int = 11) -> None:
        rng = np.random.default_rng(seed)
        weights = [*self.tables, self.bias, self.out, self.out_bias]
        first, second, t = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
        for epoch in range(epochs):
            for at in np.array_split(rng.permutation(len(rows)), max(1, len(rows) // BATCH)):
                t += 1
                step = rate * (1 - epoch / epochs)
                for w, g, m, v in zip(weights, self._gradients(rows[at], target[at]), first, second, strict=True):
                    m += 0.1 * (g - m)
                    v += 0.01 * (g * g - v)
                    w -= step * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-6)

    def _gradients(self, rows: np.ndarray, target: np.ndarray) -> list[np.ndarray]:
        places, highest = [], []
        for w in WIDTHS:
            values = self.convolve(rows, w)
            best = values.argmax(1)
            places.append(best)
            highest.append(np.take_along_axis(values, best[:, None, :], 1)[:, 0])
        hidden = np.concatenate(highest, 1) + self.bias
        active = np.maximum(hidden, 0)
        wrong = softmax(active @ self.out + self.out_bias)
        wrong[np.arange(len(rows)), target] -= 1
        wrong /= len(rows)
        back = (wrong @ self.out.T) * (hidden > 0)
        tables = []
        for i, w in enumerate(WIDTHS):
            grad, own = np.zeros_like(self.tables[i]), back[:, i * FILTERS:(i + 1) * FILTERS]
            columns = np.broadcast_to(np.arange(FILTERS), own.shape)
            for k in range(w):
                np.add.at(grad[k], (np.take_along_axis(rows, places[i] + k, 1), columns), own)
            tables.append(grad)
        return [*tables, back.sum(0), active.T @ wrong, wrong.sum(0)]


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def has_letter(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    seen = np.append(0, np.cumsum(ASCII_LETTER[raw]))
    found = seen[offsets[1:]] > seen[offsets[:-1]]
    for i in np.flatnonzero(~found & (np.diff(offsets) > 0)).tolist():
        found[i] = LETTER.search(raw[offsets[i]:offsets[i + 1]].tobytes().decode("utf-8", "replace")) is not None
    return found


def sample_windows(docs: DataFrame, text: str = "text", lang: str = "lang") -> tuple[np.ndarray, list[str]]:
    """(windows, language of each) of up to ``DOCS_A_LANGUAGE`` texts of each language, ``WINDOWS_A_DOC`` of each.

    Texts are drawn by a hash of their id, where there is one, and of themselves, so that copies of a text are drawn apart. Every language is cut by itself.
    """
    ident = [docs["doc_id"]] if "doc_id" in docs.columns else []
    labelled = docs.select(F.xxhash64(F.lit("draw"), *ident, docs[f"`{text}`"]).alias("_hash"), docs[f"`{text}`"].alias("text"), docs[f"`{lang}`"].alias("lang")).filter("lang IS NOT NULL AND text IS NOT NULL")
    drawn = labelled.withColumn("_draw", F.shiftrightunsigned("_hash", 1))
    counts = {r.lang: r.n for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return np.zeros((0, WINDOW), np.uint8), []
    # One bound for each language of the label set.
    bounds = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, hash_bound((1.2 * DOCS_A_LANGUAGE + 20) / n))])
    own = drawn.filter(F.col("_draw") <= bounds[F.col("lang")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                raw, offsets = text_buffer(part.column("text"))
                rows, doc, _ = windows(raw, offsets)
                number = np.arange(doc.size) - np.searchsorted(doc, doc)
                per = np.bincount(doc, minlength=part.num_rows)[doc]
                # Windows spread evenly over the text.
                step = np.maximum(per // WINDOWS_A_DOC, 1)
                keep = np.flatnonzero((number % step == 0) & (number // step < WINDOWS_A_DOC))
                at = pa.array(doc[keep])
                yield pa.RecordBatch.from_arrays([part.column("_draw").take(at), part.column("lang").take(at), pa.array(number[keep]), pa.array([rows[i].tobytes() for i in keep], pa.binary())], names=["_draw", "lang", "number", "bytes"])

    found = own.select("_draw", "lang", "text").mapInArrow(run, "_draw long, lang string, number long, bytes binary")
    # Each task keeps the first windows of each language before they meet.
    first = Window.partitionBy("lang").orderBy("_draw", "number", "bytes")
    kept = found.withColumn("_place", F.row_number().over(first)).filter(F.col("_place") <= DOCS_A_LANGUAGE * WINDOWS_A_DOC)
    got = kept.select("bytes", "lang", "_place").orderBy("_place", "lang").collect()
    return np.array([np.frombuffer(r.bytes, np.uint8) for r in got]).reshape(-1, WINDOW), [r.lang for r in got]


def fit(docs: DataFrame, text: str = "text", lang: str = "lang") -> Network:
    rows, langs = sample_windows(docs, text, lang)
    languages = sorted(set(langs))
    network = Network(languages)
    if languages:
        network.train(rows, np.array([languages.index(x) for x in langs]))
    return network


def fit_labels(docs: DataFrame) -> Network:
    """Fit on the rows that aren't held out: those whose crc32 of the id leaves another remainder than 2 by 4."""
    return fit(docs.filter(crc_of_id(F.col("doc_id")) % 4 != 2))


def identify(df: DataFrame, network: Network, text: str = "text") -> DataFrame:
    """``df`` with lang_pred and score; columns of these names are replaced."""
    added = StructType([StructField("lang_pred", StringType()), StructField("score", DoubleType())])

    def compute(texts: pa.Array, _: pa.RecordBatch) -> dict[str, object]:
        raw, offsets = text_buffer(texts)
        n, k = len(offsets) - 1, len(network.languages)
        letter = has_letter(raw, offsets) if k else np.zeros(n, bool)
        sums, weight = np.zeros((n, max(k, 1))), np.maximum(np.diff(offsets), 1)
        rows, doc, length = windows(raw, offsets)
        if k and len(rows):
            logits = network.logits(rows) * length[:, None]
            for j in range(k):
                sums[:, j] = np.bincount(doc, logits[:, j], minlength=n)
        chance = softmax(sums / weight[:, None])
        best = chance.argmax(1)
        names = [network.languages[b] if ok else UNKNOWN for b, ok in zip(best.tolist(), letter.tolist(), strict=True)]
        return {"lang_pred": pa.array(names, pa.string()), "score": pa.array(np.where(letter, chance[np.arange(n), best], 0.0), pa.float64())}

    return add_columns(df, text, added, compute)


@query("op6_language")
def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    network = fit_labels(docs.select("doc_id", "text", "lang"))
    held = (crc_of_id(F.col("doc_id")) % 4 == 2).alias("held_out")
    return identify(docs.select("doc_id", "text"), network).select("doc_id", held, "lang_pred", "score")
