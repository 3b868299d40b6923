"""Vectorised words and hashes of Arrow text columns, and a map over rows that keeps all other columns.

Texts are cut into slices of whole documents of about ``SLICE_BYTES``, so memory follows the longest single
document rather than the size of a batch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

SLICE_BYTES = 2 << 20

#: ``[^\x20\x09-\x0D]+``: a byte table of what separates words.
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing: digits, a-z and all that is not ASCII are kept.
NOT_ALNUM = np.ones(256, bool)
NOT_ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

_STEP = 0x9E3779B97F4A7C15


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values; one-to-one."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


#: Spans up to this length are hashed in blocks of 8 bytes, all at once; longer ones one by one.
LONG_SPAN = 512


def text_buffer(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts end to end and their n + 1 offsets; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "").cast(pa.large_string())
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, offsets - offsets[0]


def slices(batch: pa.RecordBatch, text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """``batch`` in runs of whole rows with about ``limit`` bytes of text each."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    # Short texts count too, so that many empty rows don't make one slice.
    group = (np.cumsum(sizes + 64) - 1) // limit
    edges = np.flatnonzero(np.diff(group, prepend=-1, append=group[-1] + 1))
    for start, end in zip(edges[:-1], edges[1:], strict=True):
        yield batch.slice(int(start), int(end - start))


def find_words(raw: np.ndarray, offsets: np.ndarray, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, document index) of every run of bytes that aren't separators; no run crosses documents."""
    if not raw.size:
        none = np.zeros(0, np.int64)
        return none, none, none
    inside = ~separators[raw]
    edge = np.zeros(raw.size + 1, bool)
    edge[offsets] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:-1]
    stops = inside
    stops[:-1] &= ~inside[1:] | edge[1:-1]
    start, end = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    return start, end, np.searchsorted(offsets, start, "right") - 1


def blocks_at(raw: np.ndarray) -> np.ndarray:
    """The 8 bytes from each place on as one number; zeros follow the end."""
    padded = np.zeros(raw.size + 8, np.uint8)
    padded[:raw.size] = raw
    return np.ndarray((raw.size + 1,), "<u8", padded.data, strides=(1,))


def _masked(blocks: np.ndarray, at: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Blocks at the places ``at``, without the bytes beyond the ``left`` ones that belong to the span."""
    shift = ((8 - np.minimum(left, 8)) * 8).astype(np.uint64)
    return blocks[at] & (np.uint64(0xFFFFFFFFFFFFFFFF) >> shift)


def hash_spans(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span: its length, then its blocks of 8 bytes, each mixed into what came before.

    Long spans get an XXH3 hash. Both kinds chain their blocks, so no regular pair of texts has equal hashes.
    """
    length = end - start
    out = mix((length.astype(np.uint64) + np.uint64(1)) * np.uint64(_STEP))
    if not start.size:
        return out
    blocks = blocks_at(raw)
    short = length <= LONG_SPAN
    left = np.flatnonzero(short & (length > 0))
    done = 0
    while left.size:
        out[left] = mix(out[left] * np.uint64(_STEP) + _masked(blocks, start[left] + done, length[left] - done))
        done += 8
        left = left[length[left] > done]
    for i in np.flatnonzero(~short).tolist():
        out[i] = xxhash.xxh3_64_intdigest(memoryview(np.ascontiguousarray(raw[start[i]:end[i]])))
    return out


def equal_spans(raw: np.ndarray, start: np.ndarray, end: np.ndarray, other: np.ndarray, other_start: np.ndarray, other_end: np.ndarray) -> np.ndarray:
    """Whether each span of ``raw`` has the bytes of the span of ``other`` beside it."""
    length = end - start
    same = length == other_end - other_start
    mine, theirs = blocks_at(raw), blocks_at(other)
    left = np.flatnonzero(same & (length > 0) & (length <= LONG_SPAN))
    done = 0
    while left.size:
        rest = length[left] - done
        differ = _masked(mine, start[left] + done, rest) != _masked(theirs, other_start[left] + done, rest)
        same[left[differ]] = False
        done += 8
        left = left[~differ & (rest > 8)]
    for i in np.flatnonzero(same & (length > LONG_SPAN)).tolist():
        same[i] = np.array_equal(raw[start[i]:end[i]], other[other_start[i]:other_end[i]])
    return same


def fold(hashes: np.ndarray, nxt: np.ndarray) -> np.ndarray:
    """Hash of a sequence one element longer."""
    return mix(hashes * np.uint64(_STEP) + nxt)


def add_columns(df: DataFrame, text: str, added: StructType, compute: Callable[[pa.Array, pa.RecordBatch], dict[str, object]]) -> DataFrame:
    """``df`` with the ``added`` columns that ``compute(texts, rows)`` gives for each slice of rows.

    Every row and every other column is kept; a column of ``df`` that has the name of an added one is replaced.
    """
    kept = [f for f in df.schema.fields if f.name not in added.fieldNames() or f.name == text]
    hidden = text in added.fieldNames()
    df = df.select([df[f"`{f.name}`"] for f in kept])
    out = StructType([f for f in kept if not (hidden and f.name == text)] + added.fields)
    arrow = to_arrow_schema(out, prefers_large_types=False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                new = compute(part.column(text), part)
                columns = []
                for field in arrow:
                    if field.name in new:
                        values = new[field.name]
                        values = values if isinstance(values, pa.Array) else pa.array(values)
                    else:
                        values = part.column(field.name)
                    columns.append(values.cast(field.type) if values.type != field.type else values)
                yield pa.RecordBatch.from_arrays(columns, names=arrow.names)

    return df.mapInArrow(run, out)
