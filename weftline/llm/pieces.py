"""Texts cut into pieces that byte-level BPE can encode one by one, so that each different piece is encoded once.

The pre-tokenizer of a byte-level BPE file always cuts before a single space between two characters that aren't
white space, and on both sides of a single line feed between two such characters: none of its patterns holds a
character of a word followed by white space, and none looks back. Encoding the pieces apart and joining the ids
therefore equals encoding the whole text. Special tokens hold no white space, so they stay whole as well.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from weftline.llm.words import equal_spans, hash_spans

#: White_Space of Unicode: ASCII, then the UTF-8 forms of the others.
ASCII_SPACE = np.zeros(256, bool)
ASCII_SPACE[[0x20, *range(0x09, 0x0E)]] = True
WIDE_SPACES = ["\u0085", " ", " ", *map(chr, range(0x2000, 0x200B)), " ", " ", " ", " ", "　"]


def space_mask(raw: np.ndarray) -> np.ndarray:
    """Which bytes belong to white space."""
    mask = ASCII_SPACE[raw]
    for lead in {c.encode()[0] for c in WIDE_SPACES}:
        at = np.flatnonzero(raw == lead)
        if not at.size:
            continue
        for wide in (c.encode() for c in WIDE_SPACES if c.encode()[0] == lead):
            here = at[at + len(wide) <= raw.size]
            for k, byte in enumerate(wide[1:], 1):
                here = here[raw[here + k] == byte]
            for k in range(len(wide)):
                mask[here + k] = True
    return mask


def cut(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end) of the pieces of all texts, and the number of pieces of each text."""
    if not raw.size:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets) - 1, np.int64)
    space = space_mask(raw)
    single = np.zeros(raw.size, bool)
    single[1:-1] = space[1:-1] & ~space[:-2] & ~space[2:]
    edge = np.zeros(raw.size + 1, bool)
    edge[offsets] = True
    # A white space byte at the rim of a text isn't between two characters of it.
    single &= ~edge[:-1] & ~edge[1:]
    begin = edge[:-1].copy()
    begin |= single & (raw == 0x20)
    line = np.flatnonzero(single & (raw == 0x0A))
    begin[line] = True
    begin[line + 1] = True
    start = np.flatnonzero(begin)
    end = np.append(start[1:], raw.size)
    return start, end, np.diff(np.searchsorted(start, offsets))


class PieceStore:
    """What ``encode`` gives for each different piece, kept between slices up to ``limit`` pieces.

    Pieces are found by hash and then compared byte by byte; one whose hash belongs to another piece is kept by its bytes.
    """

    def __init__(self, encode: Callable[[list[bytes]], list], limit: int = 300_000):
        self.encode, self.limit = encode, limit
        self.clear()

    def clear(self) -> None:
        self.keys, self.places, self.values = np.zeros(0, np.uint64), np.zeros(0, np.int64), []
        self.raw, self.ends, self.clashing = np.zeros(0, np.uint8), np.zeros(1, np.int64), {}

    def add(self, pieces: list[bytes]) -> None:
        self.values.extend(self.encode(pieces))

    def _append(self, pieces: list[bytes]) -> np.ndarray:
        """Places of new pieces."""
        known = self.ends.size - 1
        self.add(pieces)
        self.raw = np.concatenate([self.raw, np.frombuffer(b"".join(pieces), np.uint8)])
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum([len(p) for p in pieces])])
        return np.arange(known, known + len(pieces))

    def look_up(self, raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Places in ``self.values`` for each span; unknown pieces are encoded first."""
        if self.keys.size + len(self.clashing) > self.limit:
            self.clear()
        keys, first, inverse = np.unique(hash_spans(raw, start, end), return_index=True, return_inverse=True)
        at = np.searchsorted(self.keys, keys)
        known = at < self.keys.size
        known[known] = self.keys[at[known]] == keys[known]
        found = np.empty(keys.size, np.int64)
        found[known] = self.places[at[known]]
        if not known.all():
            fresh = np.flatnonzero(~known)
            data, a, b = raw.tobytes(), start[first[fresh]].tolist(), end[first[fresh]].tolist()
            found[fresh] = self._append([data[i:j] for i, j in zip(a, b, strict=True)])
            self.keys = np.insert(self.keys, at[fresh], keys[fresh])
            self.places = np.insert(self.places, at[fresh], found[fresh])
        places = found[inverse]
        for i in np.flatnonzero(~equal_spans(raw, start, end, self.raw, self.ends[places], self.ends[places + 1])).tolist():
            piece = raw[start[i]:end[i]].tobytes()
            if piece not in self.clashing:
                self.clashing[piece] = int(self._append([piece])[0])
            places[i] = self.clashing[piece]
        return places


class IdStore(PieceStore):
    """The ids of each different piece in one flat array; ``encode`` gives the ids of all its pieces in turn and their numbers."""

    def clear(self) -> None:
        super().clear()
        self.flat, self.counts = np.zeros(0, np.int32), np.zeros(0, np.int64)
        self.first = self.counts

    def add(self, pieces: list[bytes]) -> None:
        flat, counts = self.encode(pieces)
        self.flat, self.counts = np.concatenate([self.flat, flat]), np.concatenate([self.counts, counts])
        self.first = np.cumsum(self.counts) - self.counts

    def ids_at(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the pieces in turn, number of ids of each)."""
        counts = self.counts[places]
        begin = self.first[places] - (np.cumsum(counts) - counts)
        return self.flat[np.repeat(begin, counts) + np.arange(int(counts.sum()))], counts


def side_by_side(pieces: list[bytes]) -> np.ndarray:
    """Which pieces can stand next to each other in one text without changing their ids: one space in front, no other white space."""
    raw = np.frombuffer(b"".join(pieces), np.uint8)
    ends = np.cumsum([len(p) for p in pieces])
    starts = np.append(0, ends[:-1])
    return (np.add.reduceat(space_mask(raw).astype(np.int32), starts) == 1) & (raw[starts] == 0x20) & (ends - starts > 1)
