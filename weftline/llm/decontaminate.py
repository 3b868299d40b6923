"""Benchmark decontamination with a positional inverted index of the training words.

The index is split by documents: a segment holds about two megabytes of whole texts and stores, for each different
word, the sorted positions where it stands. Positions of a segment count on through its documents with a gap of one
between them, so no phrase crosses documents. Segments are rows of a stored table; building them takes no shuffle,
and a document of any length is one segment at most.

Test items are cut into windows of ``WINDOW`` words; a shorter item is one window. In each segment a window starts
from the posting list of its rarest word there, moved back by that word's offset; the lists of its other words, next
rarest first, are moved likewise and intersected with what is left. What remains are exact phrase matches.
``proximity`` finds places where all words of a query stand within a given span, in any order.

Items are written to the shared folder as arrays that workers map into memory, so their number has no bound.

Null and empty texts have no words, no hits and aren't contaminated. An item without words occurs nowhere. Items of
one id count as one item; a null id is the empty name. Repeated documents are judged alike, each with its own row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.llm import shared
from weftline.llm.registry import query, table
from weftline.llm.words import LOWER, NOT_ALNUM, find_words, hash_spans, slices, text_buffer
from weftline.session import cut_lineage

WINDOW = 13
#: A document is contaminated from this share of hit words on.
WORDS_A_HIT = 20
CANDIDATES = 1 << 20

SEGMENT = "doc_ids array<long>, text_keys array<long>, n_words array<int>, terms binary, starts binary, positions binary"


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word of all texts in turn, number of words of each text)."""
    raw, offsets = text_buffer(texts)
    raw = LOWER[raw]
    start, end, doc = find_words(raw, offsets, NOT_ALNUM)
    return hash_spans(raw, start, end), np.bincount(doc, minlength=len(offsets) - 1)


def doc_starts(n_words: np.ndarray) -> np.ndarray:
    """Position of the first word of each document of a segment."""
    return np.cumsum(n_words) - n_words + np.arange(n_words.size)


# The index.

def build_index(df: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Stored segments of all documents of ``df``. ``text_keys`` has a hash of each text, for joining results back."""
    rows = df.select(df[f"`{id_column}`"].cast("long").alias("id"), df[f"`{text}`"].alias("text"), F.xxhash64(df[f"`{text}`"]).alias("key"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                hashes, counts = word_hashes(part.column("text"))
                place = np.arange(hashes.size) + np.repeat(np.arange(counts.size), counts)
                span = hashes.size + counts.size + 1
                terms, which = np.unique(hashes, return_inverse=True)
                posting = np.sort(which * span + place)
                term, position = np.divmod(posting, span) if posting.size else (posting, posting)
                starts = np.searchsorted(term, np.arange(terms.size + 1))
                yield pa.RecordBatch.from_arrays([
                    pa.array([part.column("id").to_pylist()], pa.list_(pa.int64())), pa.array([part.column("key").to_pylist()], pa.list_(pa.int64())),
                    pa.array([counts], pa.list_(pa.int32())), pa.array([terms.tobytes()], pa.binary()),
                    pa.array([starts.astype(np.int64).tobytes()], pa.binary()), pa.array([position.astype(np.int32).tobytes()], pa.binary()),
                ], names=["doc_ids", "text_keys", "n_words", "terms", "starts", "positions"])

    return cut_lineage(rows.mapInArrow(run, SEGMENT))


class Segment:
    def __init__(self, n_words: np.ndarray, terms: bytes, starts: bytes, positions: bytes):
        self.n_words = n_words.astype(np.int64)
        self.first = doc_starts(self.n_words)
        self.span = int(self.n_words.sum()) + self.n_words.size + 1
        self.terms, self.starts = np.frombuffer(terms, np.uint64), np.frombuffer(starts, np.int64)
        self.positions = np.frombuffer(positions, np.int32).astype(np.int64)
        self.sizes = np.diff(self.starts)
        # Posting lists one after another as one sorted array, for membership tests.
        self.keyed = np.repeat(np.arange(self.terms.size), self.sizes) * self.span + self.positions

    def lists_of(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(posting list of each hash, whether there is one)."""
        if not self.terms.size:
            return np.zeros(hashes.shape, np.int64), np.zeros(hashes.shape, bool)
        at = np.minimum(np.searchsorted(self.terms, hashes), self.terms.size - 1)
        return at, self.terms[at] == hashes

    def holds(self, lists: np.ndarray, places: np.ndarray) -> np.ndarray:
        wanted = lists * self.span + places
        at = np.minimum(np.searchsorted(self.keyed, wanted), self.keyed.size - 1)
        return (places >= 0) & (places < self.span) & (self.keyed[at] == wanted)

    def phrases(self, windows: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(row of ``windows``, position of its first word) of all matches, in blocks."""
        lists, known = self.lists_of(windows)
        rows = np.flatnonzero(known.all(1))
        if not rows.size:
            return
        lists = lists[rows]
        order = np.argsort(self.sizes[lists], axis=1, kind="stable")
        rarest = lists[np.arange(rows.size), order[:, 0]]
        # Windows in blocks whose rarest lists have about CANDIDATES places together.
        block = np.cumsum(self.sizes[rarest]) // CANDIDATES
        for b in np.unique(block):
            here = np.flatnonzero(block == b)
            sizes = self.sizes[rarest[here]]
            window = np.repeat(here, sizes)
            inner = np.arange(window.size) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            place = self.positions[self.starts[rarest[window]] + inner] - order[window, 0]
            for k in range(1, windows.shape[1]):
                offset = order[window, k]
                same = self.holds(lists[window, offset], place + offset)
                window, place = window[same], place[same]
                if not window.size:
                    break
            if window.size:
                yield rows[window], place

    def documents_at(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first, places, "right") - 1


def segments(batch: pa.RecordBatch) -> Iterator[tuple[Segment, list, list]]:
    for i in range(batch.num_rows):
        row = {n: batch.column(n)[i] for n in batch.schema.names}
        counts = row["n_words"].values.to_numpy(zero_copy_only=False)
        yield Segment(counts, *(row[n].as_py() for n in ("terms", "starts", "positions"))), row["doc_ids"].as_py(), row["text_keys"].as_py()


# Test items.

def write_items(items: DataFrame, id_column: str = "item_id", text: str = "text") -> tuple[str, list[str]]:
    """Word hashes of all items as files; (folder, names). A file is its items' sizes, the ends of their names, their words and their names."""
    folder = shared.new_folder(items.sparkSession, "test-items")
    rows = items.select(F.coalesce(items[f"`{id_column}`"].cast("string"), F.lit("")).alias("id"), items[f"`{text}`"].alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, names = TaskContext.get().partitionId(), []
        for batch in batches:
            for rows in slices(batch, "text"):
                hashes, counts = word_hashes(rows.column("text"))
                ids = [i.encode() for i in rows.column("id").to_pylist()]
                ends = np.cumsum([len(i) for i in ids], dtype=np.int64)
                names.append(f"items-{part:06d}-{len(names):06d}")
                shared.put(folder, names[-1], np.array([counts.size, ends[-1]], np.int64), counts.astype(np.int64), ends, hashes, b"".join(ids))
        yield pa.RecordBatch.from_pydict({"name": pa.array(names, pa.string())})

    return folder, sorted(r.name for r in rows.mapInArrow(run, "name string").collect())


def windows_of(folder: str, names: list[str], length: int) -> Iterator[tuple[list[str], np.ndarray, np.ndarray]]:
    """(names of the items of a file, item of each window, words of each window), for each file and window length."""
    for name in names:
        raw = shared.mapped(folder, name)
        n, size = raw[:16].view(np.int64).tolist()
        counts = raw[16:16 + 8 * n].view(np.int64)
        ends, said = raw[16 + 8 * n:16 + 16 * n].view(np.int64).tolist(), raw[raw.size - size:].tobytes()
        ids = [said[a:b].decode() for a, b in zip([0, *ends], ends, strict=False)]
        hashes = np.asarray(raw[16 + 16 * n:raw.size - size]).view(np.uint64)
        first = np.cumsum(counts) - counts
        for width in np.unique(np.minimum(counts, length)).tolist():
            if width:
                own = np.flatnonzero(np.minimum(counts, length) == width)
                per = counts[own] - width + 1
                item = np.repeat(own, per)
                at = first[item] + np.arange(item.size) - np.repeat(np.cumsum(per) - per, per)
                yield ids, item, hashes[at[:, None] + np.arange(width)]


# Results.

def judge(index: DataFrame, items: tuple[str, list[str]], window: int = WINDOW, words_a_hit: int = WORDS_A_HIT) -> DataFrame:
    """(doc_id, text_key, n_words, n_hit, n_items, items_sha256, contaminated), one row for each document of the index."""
    folder, names = items

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for segment, doc_ids, keys in segments(batch):
                change = np.zeros(segment.span + window + 1, np.int64)
                found: list[set[str]] = [set() for _ in doc_ids]
                for ids, item, words in windows_of(folder, names, window):
                    for rows, places in segment.phrases(words):
                        np.add.at(change, places, 1)
                        np.add.at(change, places + words.shape[1], -1)
                        docs = segment.documents_at(places)
                        for pair in np.unique(docs * len(ids) + item[rows]).tolist():
                            found[pair // len(ids)].add(ids[pair % len(ids)])
                covered = np.append(0, np.cumsum(np.cumsum(change) > 0))
                n_hit = covered[segment.first + segment.n_words] - covered[segment.first]
                digests = [hashlib.sha256(",".join(sorted(f)).encode()).hexdigest() for f in found]
                yield pa.RecordBatch.from_arrays([
                    pa.array(doc_ids, pa.int64()), pa.array(keys, pa.int64()), pa.array(segment.n_words, pa.int64()), pa.array(n_hit, pa.int64()),
                    pa.array([len(f) for f in found], pa.int64()), pa.array(digests, pa.string()),
                    pa.array((n_hit > 0) & (words_a_hit * n_hit >= segment.n_words), pa.bool_())],
                    names=["doc_id", "text_key", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"])

    return index.mapInArrow(run, "doc_id long, text_key long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean")


def phrase_matches(index: DataFrame, items: tuple[str, list[str]], window: int = WINDOW) -> DataFrame:
    """(doc_id, item_id, start, length) of every occurrence of a window; ``start`` counts the document's words from 0."""
    folder, names = items

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for segment, doc_ids, _ in segments(batch):
                for ids, item, words in windows_of(folder, names, window):
                    for rows, places in segment.phrases(words):
                        docs = segment.documents_at(places)
                        yield pa.RecordBatch.from_arrays([
                            pa.array([doc_ids[d] for d in docs.tolist()], pa.int64()), pa.array([ids[i] for i in item[rows].tolist()], pa.string()),
                            pa.array(places - segment.first[docs], pa.int64()), pa.array(np.full(places.size, words.shape[1]), pa.int64())],
                            names=["doc_id", "item_id", "start", "length"])

    return index.mapInArrow(run, "doc_id long, item_id string, start long, length long")


def proximity(index: DataFrame, words: str, span: int) -> DataFrame:
    """(doc_id, start, end): the shortest stretch from each start that holds all ``words`` within ``span`` words."""
    wanted = np.unique(word_hashes(pa.array([words]))[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for segment, doc_ids, _ in segments(batch):
                lists, known = segment.lists_of(wanted)
                if not wanted.size or not known.all():
                    continue
                own = [segment.positions[segment.starts[i]:segment.starts[i + 1]] for i in lists]
                start = np.sort(np.concatenate(own))
                # The next place of every word at or after each start; past the end there is none.
                nexts = [np.append(p, np.int64(1) << 60)[np.searchsorted(p, start)] for p in own]
                end = np.max(nexts, axis=0)
                near = end - start < span
                start, end = start[near], end[near]
                docs = segment.documents_at(start)
                same = docs == segment.documents_at(end)
                docs, start, end = docs[same], start[same], end[same]
                yield pa.RecordBatch.from_arrays([
                    pa.array([doc_ids[d] for d in docs.tolist()], pa.int64()), pa.array(start - segment.first[docs], pa.int64()),
                    pa.array(end - segment.first[docs], pa.int64())], names=["doc_id", "start", "end"])

    return index.mapInArrow(run, "doc_id long, start long, end long")


def clean(df: DataFrame, items: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``df`` without contaminated rows; all columns are kept, rows with null texts too."""
    judged = judge(build_index(df, id_column, text), write_items(items))
    bad = judged.filter("contaminated").select(F.col("text_key").alias("_bad")).distinct()
    return df.join(bad, F.xxhash64(df[f"`{text}`"]) == bad["_bad"], "left_anti")


@query("op10_decontaminate")
def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = build_index(table(spark, sf_dir, "documents").select("doc_id", "text"))
    judged = judge(index, write_items(table(spark, sf_dir, "benchmark")))
    return judged.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
