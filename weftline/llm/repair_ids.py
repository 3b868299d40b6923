"""Token ids in files compressed by a Re-Pair grammar, with access to any single document.

Documents are put in ascending id order over range partitions; each partition writes one file, cut into shards of
whole documents with about ``SHARD_IDS`` ids. In a shard the most frequent pairs of adjacent symbols are replaced by
new symbols again and again, a few thousand rules a round, until no pair is frequent or a round gains little. Pairs
never cross documents. A shard stores for each rule its two symbols and how many ids it expands to, and for each
document where its symbols start and how many ids it has, so one document can be read without the others.

A file is a row of shards, then one int64 start for each shard and their number. A shard is nine int64 (documents,
rules, symbols, first rule symbol, bytes of the four packed parts, ids) and the parts, each packed by zstd.

Null texts are empty and have only the end id; null ids come first. Documents of one id stand in the order of a hash
of their text. Repeated rows are kept.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weftline.llm import shared
from weftline.llm.pieces import IdStore, cut, side_by_side
from weftline.llm.registry import query, table
from weftline.llm.words import slices, text_buffer
from weftline.session import cut_lineage

SHARD_IDS = 2_000_000
RULES_A_ROUND = 4096
LEAST_USES = 8
LEAST_GAIN = 0.02
COUNTERS_BITS = 20
END_ID = 0
VOCABULARY = "byte_bpe_50k.json"
HEADER = 9


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


# The grammar.

def rank_of(chosen: np.ndarray, size: int) -> np.ndarray:
    """For each of ``size`` places its rank among the ``chosen`` ones."""
    ranks = np.zeros(size, np.int64)
    ranks[chosen] = np.arange(chosen.size)
    return ranks


def count_pairs(keys: np.ndarray, cell: np.ndarray, fullest: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(different keys in order, which of them each key is, uses of each), as ``np.unique`` gives them.

    One key of each counter is counted in place; only the others that share its counter are sorted.
    """
    cells = np.flatnonzero(fullest)
    slot = rank_of(cells, fullest.size)[cell]
    first = np.zeros(cells.size, np.int64)
    first[slot] = keys
    other = np.flatnonzero(first[slot] != keys)
    # A counter is only full by keys, so each slot has one.
    more, inverse = np.unique(keys[other], return_inverse=True)
    slot[other] = cells.size + inverse
    every = np.concatenate([first, more])
    uses = np.bincount(slot, minlength=every.size)
    order = np.argsort(every)
    return every[order], rank_of(order, every.size)[slot], uses[order]


def compress(ids: np.ndarray, starts: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(symbols, first symbol of each document, rules as rows of two symbols); rule i is the symbol ``base + i``.

    ``starts`` has the first id of each document; ids are below ``base``.
    """
    symbols = ids.astype(np.int32)
    bounds = starts.astype(np.int64)
    rules: list[np.ndarray] = []
    made = base
    while symbols.size > 1:
        closed = np.unique(bounds[(bounds > 0) & (bounds < symbols.size)]) - 1
        keys = symbols[:-1].astype(np.int64)
        keys <<= 32
        keys |= symbols[1:]
        cell = keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        cell >>= np.uint64(64 - COUNTERS_BITS)
        cell = cell.view(np.int64)
        counts = np.bincount(cell, minlength=1 << COUNTERS_BITS) - np.bincount(cell[closed], minlength=1 << COUNTERS_BITS)
        # Pairs share counters, so a counter only bounds a pair's uses; those of the fullest counters are counted exactly.
        full = counts[counts >= LEAST_USES]
        floor = int(np.partition(full, -RULES_A_ROUND)[-RULES_A_ROUND]) if full.size >= RULES_A_ROUND else LEAST_USES
        fullest = counts >= floor
        hit = fullest[cell]
        hit[closed] = False
        likely = np.flatnonzero(hit)
        pairs, which, uses = count_pairs(keys[likely], cell[likely], fullest)
        chosen = np.zeros(pairs.size, bool)
        chosen[np.argsort(-uses, kind="stable")[:RULES_A_ROUND]] = True
        chosen &= uses >= LEAST_USES
        at, which = likely[chosen[which]], which[chosen[which]]
        if not at.size:
            break
        # Where chosen pairs overlap, every second one of the run is replaced, from the left.
        place = np.arange(at.size)
        heads = np.append(True, np.diff(at) != 1)
        even = (place - np.maximum.accumulate(np.where(heads, place, 0))) & 1 == 0
        at, which = at[even], which[even]
        used = np.bincount(which, minlength=pairs.size)
        good = used[which] > 2
        at, which = at[good], which[good]
        if at.size < LEAST_GAIN * symbols.size:
            break
        kept = np.flatnonzero(used > 2)
        number = rank_of(kept, pairs.size)[which]
        rules.append(np.stack([pairs[kept] >> 32, pairs[kept] & 0xFFFFFFFF], 1).astype(np.int32))
        symbols[at] = made + number
        made += kept.size
        keep = np.ones(symbols.size, bool)
        keep[at + 1] = False
        bounds = bounds - np.searchsorted(at + 1, bounds)
        symbols = symbols[keep]
    return symbols, bounds, np.concatenate(rules) if rules else np.zeros((0, 2), np.int32)


def expansions(rules: np.ndarray, base: int) -> np.ndarray:
    """How many ids each rule stands for. A rule only uses rules before it, a round at a time."""
    lengths = np.zeros(len(rules), np.int64)
    wait = np.arange(len(rules))
    while wait.size:
        inner = rules[wait].astype(np.int64) - base
        sides = np.where(inner >= 0, lengths[np.maximum(inner, 0)], 1)
        ready = (sides > 0).all(1)
        lengths[wait[ready]] = sides[ready].sum(1)
        wait = wait[~ready]
    return lengths


def expand(symbols: np.ndarray, rules: np.ndarray, base: int) -> np.ndarray:
    """The ids that ``symbols`` stand for."""
    while True:
        nested = symbols >= base
        if not nested.any():
            return symbols
        at = np.cumsum(np.where(nested, 2, 1)) - np.where(nested, 2, 1)
        out = np.empty(symbols.size + int(nested.sum()), np.int32)
        out[at[~nested]] = symbols[~nested]
        pair = rules[symbols[nested] - base]
        out[at[nested]], out[at[nested] + 1] = pair[:, 0], pair[:, 1]
        symbols = out


# Shards and files.

def pack_shard(doc_ids: np.ndarray, missing: np.ndarray, ids: np.ndarray, counts: np.ndarray, base: int) -> bytes:
    ends = np.cumsum(counts)
    symbols, bounds, rules = compress(ids, ends - counts, base)
    parts = [
        doc_ids.astype(np.int64).tobytes() + counts.astype(np.int64).tobytes() + bounds.astype(np.int64).tobytes() + missing.astype(np.uint8).tobytes(),
        rules.astype(np.int32).tobytes(), expansions(rules, base).tobytes(), symbols.astype(np.int32).tobytes()]
    packed = [pa.compress(p, "zstd", asbytes=True) for p in parts]
    header = np.array([len(doc_ids), len(rules), symbols.size, base, *map(len, packed), ids.size], np.int64)
    return header.tobytes() + b"".join(packed)


class Shard:
    """A packed shard; documents are decoded one by one or all together."""

    def __init__(self, raw: np.ndarray):
        docs, n_rules, n_symbols, self.base, *sizes, self.n_ids = raw[:8 * HEADER].view(np.int64).tolist()
        at, plain = 8 * HEADER, [docs * 25, n_rules * 8, n_rules * 8, n_symbols * 4]
        parts = []
        for size, full in zip(sizes, plain, strict=True):
            parts.append(np.frombuffer(pa.decompress(raw[at:at + size].tobytes(), full, "zstd", asbytes=True), np.uint8))
            at += size
        self.doc_ids, self.counts, self.bounds = parts[0][:docs * 24].view(np.int64).reshape(3, docs)
        self.missing = parts[0][docs * 24:].astype(bool)
        self.rules, self.lengths, self.symbols = parts[1].view(np.int32).reshape(-1, 2), parts[2].view(np.int64), parts[3].view(np.int32)

    def document(self, index: int) -> np.ndarray:
        end = self.bounds[index + 1] if index + 1 < len(self.bounds) else self.symbols.size
        return expand(self.symbols[self.bounds[index]:end], self.rules, self.base)

    def id_at(self, index: int, position: int) -> int:
        """The id at a position of a document, found by going down the expansion lengths."""
        end = self.bounds[index + 1] if index + 1 < len(self.bounds) else self.symbols.size
        own = self.symbols[self.bounds[index]:end].astype(np.int64) - self.base
        ends = np.cumsum(np.where(own >= 0, self.lengths[np.maximum(own, 0)] if len(self.lengths) else 1, 1))
        step = int(np.searchsorted(ends, position, "right"))
        symbol, left = int(own[step]) + self.base, position - (int(ends[step - 1]) if step else 0)
        while symbol >= self.base:
            first, second = self.rules[symbol - self.base].tolist()
            size = 1 if first < self.base else int(self.lengths[first - self.base])
            symbol, left = (first, left) if left < size else (second, left - size)
        return symbol

    def all_ids(self) -> np.ndarray:
        """The ids of all documents: each rule is expanded once, then copied to where it stands."""
        rules = expand(np.arange(self.base, self.base + len(self.rules), dtype=np.int32), self.rules, self.base)
        source = np.concatenate([rules, self.symbols])
        begin, counts = np.arange(rules.size, source.size), np.ones(self.symbols.size, np.int64)
        nested = np.flatnonzero(self.symbols >= self.base)
        rule = self.symbols[nested] - self.base
        begin[nested], counts[nested] = (np.cumsum(self.lengths) - self.lengths)[rule], self.lengths[rule]
        begin -= np.cumsum(counts) - counts
        return source[np.repeat(begin, counts) + np.arange(self.n_ids)]


def shards_of(raw: np.ndarray) -> Iterator[Shard]:
    n = int(raw[-8:].view(np.int64)[0])
    starts = np.frombuffer(raw[raw.size - 8 * (n + 1):].tobytes(), np.int64)[:n]
    for start in starts.tolist():
        yield Shard(np.frombuffer(raw[start:].tobytes(), np.uint8) if start % 8 else raw[start:])


# Encoding with the library.

class Library:
    """The tokenizers library over pieces: those that can stand side by side are encoded as one text, whose ids are
    dealt out to the pieces by the bytes that each id stands for."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        vocab = self.library.get_vocab(with_added_tokens=False)
        self.added = [t.content.encode() for t in self.library.get_added_tokens_decoder().values()]
        # A letter of a byte-level token stands for one byte.
        self.lengths = np.zeros(self.library.get_vocab_size() + 1, np.int64)
        self.lengths[list(vocab.values())] = [len(t) for t in vocab]

    def encode(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        plain = side_by_side(pieces)
        together = b"".join(pieces)
        for token in self.added:
            if token in together:
                plain &= np.array([token not in p for p in pieces])
        where, rest = np.flatnonzero(plain), np.flatnonzero(~plain)
        found: list[np.ndarray] = []
        counts = np.zeros(len(pieces), np.int64)
        if where.size:
            own = [pieces[i] for i in where.tolist()]
            ids = np.array(self._ids([b"".join(own)])[0], np.int32)
            ends = np.searchsorted(np.cumsum(self.lengths[ids]), np.cumsum([len(p) for p in own])) + 1
            counts[where] = np.diff(ends, prepend=0)
            found.append(ids)
        for i, ids in zip(rest.tolist(), self._ids([pieces[i] for i in rest.tolist()]), strict=True):
            counts[i] = len(ids)
            found.append(np.array(ids, np.int32))
        # Side by side first, then the others: put them in the order of the pieces.
        order = np.concatenate([where, rest])
        sizes = counts[order]
        begin = np.empty(len(pieces), np.int64)
        begin[order] = np.cumsum(sizes) - sizes
        at = np.repeat(begin - (np.cumsum(counts) - counts), counts) + np.arange(int(counts.sum()))
        return (np.concatenate(found) if found else np.zeros(0, np.int32))[at], counts

    def _ids(self, texts: list[bytes]) -> list[list[int]]:
        return [e.ids for e in self.library.encode_batch_fast([t.decode("utf-8", "surrogatepass") for t in texts], add_special_tokens=False)]


@cache
def _store(path: str) -> IdStore:
    return IdStore(Library(path).encode, limit=1_000_000)


def encode_texts(texts: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts in turn, each text followed by the end id; number of ids of each text)."""
    raw, offsets = text_buffer(texts)
    start, end, pieces = cut(raw, offsets)
    if not start.size:
        return np.full(len(pieces), END_ID, np.int32), np.ones(len(pieces), np.int64)
    store = _store(path)
    ids, sizes = store.ids_at(store.look_up(raw, start, end))
    ends = np.append(0, np.cumsum(sizes))[np.cumsum(pieces)]
    return np.insert(ids, ends, END_ID), np.diff(ends, prepend=0) + 1


def write_ids(df: DataFrame, id_column: str = "doc_id", text: str = "text", path: str | None = None, folder: str | None = None) -> tuple[str, DataFrame]:
    """Encode and write all texts; (folder, manifest of (file, part, n_docs, n_ids)). ``id_column`` is an integer or null."""
    spark, path = df.sparkSession, path or vocabulary_path()
    folder = folder or shared.new_folder(spark, "repair-ids")
    base = _base(path)
    rows = df.select(df[f"`{id_column}`"].cast("long").alias("id"), df[f"`{text}`"].alias("text"), F.xxhash64(df[f"`{text}`"]).alias("tie"))
    ordered = rows.repartitionByRange("id", "tie").sortWithinPartitions("id", "tie")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        name, starts, held, size, docs, total = f"part-{part:06d}.ids", [], [], 0, 0, 0

        def flush() -> None:
            nonlocal held, size
            starts.append(out.size)
            out.write(pack_shard(*(np.concatenate(x) for x in zip(*held, strict=True)), base))
            held, size = [], 0

        with shared.writer(folder, name) as out:
            for batch in batches:
                for rows in slices(batch, "text"):
                    ids, counts = encode_texts(rows.column("text"), path)
                    column = rows.column("id")
                    held.append((column.fill_null(0).to_numpy(zero_copy_only=False), np.asarray(column.is_null()), ids, counts))
                    size, docs, total = size + ids.size, docs + counts.size, total + ids.size
                    if size >= SHARD_IDS:
                        flush()
            if held:
                flush()
            out.write(np.array([*starts, len(starts)], np.int64))
        yield pa.RecordBatch.from_pydict({"file": [name], "part": [part], "n_docs": [docs], "n_ids": [total]})

    return folder, cut_lineage(ordered.mapInArrow(run, "file string, part long, n_docs long, n_ids long").filter("n_docs > 0"))


def _base(path: str) -> int:
    import json

    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    return max([*spec["model"]["vocab"].values(), *(t["id"] for t in spec["added_tokens"])]) + 1


def read_ids(folder: str, manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files. Files are read whole, a shard at a time."""
    # One row for each file: the order of the files is the order of the documents.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.withColumn("before", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))
    files = max(1, manifest.count())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, start in zip(batch.column("file").to_pylist(), batch.column("before").to_pylist(), strict=True):
                for shard in shards_of(shared.mapped(folder, file)):
                    ids = shard.all_ids()
                    ends = np.cumsum(shard.counts)
                    sums = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip((ends - shard.counts).tolist(), ends.tolist(), strict=True)]
                    yield pa.RecordBatch.from_arrays([
                        pa.array(shard.doc_ids, pa.int64(), mask=shard.missing), pa.array(start + ends - shard.counts, pa.int64()),
                        pa.array(shard.counts, pa.int64()), pa.array(sums, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])
                    start += shard.n_ids

    return placed.select("file", "before").repartition(files).mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


@query("op4_repair_ids")
def op4_repair_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_ids(*write_ids(table(spark, sf_dir, "documents").select("doc_id", "text")))
