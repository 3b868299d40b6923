"""Byte-level BPE in numpy: encoding and decoding with a public vocabulary file.

Texts are cut into pieces (see ``pieces.py``) and each different piece is encoded once per task. Its words become
rows of symbols in one flat array. A round looks up the rank of every adjacent pair by binary search over the sorted
pair keys, finds the lowest rank of each word and merges all places that have it, in all words together; words
without a known pair leave the array. New pairs always rank above the merge that made their symbol, so merging every
place of the lowest rank at once gives what merging one by one gives.

Null and empty texts have no ids and decode to the empty text. Special tokens of the file are found in the text
as the file says. Ids that the vocabulary lacks are skipped on decoding.
"""

from __future__ import annotations

import hashlib
import json
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from weftline.llm.pieces import WIDE_SPACES, PieceStore, cut, space_mask
from weftline.llm.registry import query, table
from weftline.llm.words import add_columns, text_buffer

VOCABULARY = "byte_bpe_50k.json"
NO_RANK = np.int32(1 << 30)
SHIFT = np.int64(20)

# Fixed value: the split pattern of this vocabulary, with white space spelled out.
_S = r"\t-\r " + "".join(WIDE_SPACES)
WORDS = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_S}\p{{L}}\p{{N}}]+|[{_S}]+(?![^{_S}])|[{_S}]+")


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies: printable Latin-1 as it is, others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(rest)}


#: Ids, their number, their decimal text joined by commas, and the bytes they stand for.
Coded = tuple[list[int], int, bytes, bytes]


class Bpe:
    """A vocabulary ready for batches of pieces."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters, vocab = byte_letters(), spec["model"]["vocab"]
        self.special = {t["content"].encode(): t["id"] for t in spec["added_tokens"]}
        self.bytes_of = {i: bytes(letters[c] for c in token) for token, i in vocab.items()} | {i: t for t, i in self.special.items()}
        self.decimal = [str(i).encode() for i in range(max(self.bytes_of) + 1)]
        self.first = np.zeros(256, np.int32)
        for letter, byte in letters.items():
            self.first[byte] = vocab[letter]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        keys = np.array([(vocab[a] << int(SHIFT)) | vocab[b] for a, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        order = np.argsort(keys)
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int32), made.astype(np.int32)
        self.split = regex.compile("(" + "|".join(regex.escape(t.decode()) for t in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        wanted = (left.astype(np.int64) << SHIFT) | right
        at = np.minimum(np.searchsorted(self.keys, wanted), self.keys.size - 1)
        return np.where(self.keys[at] == wanted, self.ranks[at], NO_RANK)

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words in turn, number of ids of each word)."""
        lengths = np.array([len(w) for w in words], np.int64)
        symbols = self.first[np.frombuffer(b"".join(words), np.uint8)]
        word = np.repeat(np.arange(len(words), dtype=np.int32), lengths)
        ranks = np.full(symbols.size, NO_RANK)
        inner = np.flatnonzero(word[1:] == word[:-1])
        ranks[inner] = self.rank(symbols[inner], symbols[inner + 1])
        done = []
        while symbols.size:
            begins = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            lowest = np.repeat(np.minimum.reduceat(ranks, begins), np.diff(np.append(begins, symbols.size)))
            active = lowest < NO_RANK
            if not active.all():
                done.append((word[~active], symbols[~active]))
                symbols, word, ranks, lowest = symbols[active], word[active], ranks[active], lowest[active]
                if not symbols.size:
                    break
            at = np.flatnonzero(ranks == lowest)
            # In a run of overlapping places every second one merges, from the left.
            heads = np.append(True, np.diff(at) != 1)
            if not heads.all():
                run = np.cumsum(heads) - 1
                at = at[(np.arange(at.size) - np.flatnonzero(heads)[run]) % 2 == 0]
            symbols[at] = self.made[ranks[at]]
            ranks[at] = ranks[at + 1]
            keep = np.ones(symbols.size, bool)
            keep[at + 1] = False
            moved = at - np.arange(at.size)
            symbols, word, ranks = symbols[keep], word[keep], ranks[keep]
            # Only pairs that touch a merged symbol have a new rank.
            touched = np.zeros(symbols.size, bool)
            touched[moved] = True
            touched[moved[moved > 0] - 1] = True
            touched = np.flatnonzero(touched[:-1])
            inner = word[touched] == word[touched + 1]
            ranks[touched[~inner]] = NO_RANK
            if moved.size and moved[-1] == symbols.size - 1:
                ranks[-1] = NO_RANK
            touched = touched[inner]
            ranks[touched] = self.rank(symbols[touched], symbols[touched + 1])
        if not done:
            return np.zeros(0, np.int32), np.zeros(len(words), np.int64)
        word, symbols = (np.concatenate(x) for x in zip(*done, strict=True))
        return symbols[np.argsort(word, kind="stable")], np.bincount(word, minlength=len(words))

    def coded_words(self, words: list[str]) -> dict[str, Coded]:
        """Each different word with what its ids give."""
        different = list(dict.fromkeys(words))
        flat, counts = self.merge([w.encode("utf-8", "surrogatepass") for w in different])
        ids, ends, decimal, spelled, out = flat.tolist(), np.cumsum(counts).tolist(), self.decimal, self.bytes_of, {}
        at = 0
        for w, end in zip(different, ends, strict=True):
            own = ids[at:end]
            out[w] = (own, end - at, b",".join([decimal[i] for i in own]), b"".join([spelled[i] for i in own]))
            at = end
        return out

    def encode(self, pieces: list[bytes]) -> list[Coded]:
        """What the ids of each piece give."""
        raw = np.frombuffer(b"".join(pieces), np.uint8)
        ends = np.cumsum([len(p) for p in pieces])
        starts = np.append(0, ends[:-1])
        # One space at the front and no other white space: such pieces can stand side by side in one text.
        plain = (np.add.reduceat(space_mask(raw).astype(np.int32), starts) == 1) & (raw[starts] == 0x20) & (ends - starts > 1)
        if self.special:
            plain &= np.array([not any(t in p for t in self.special) for p in pieces])
        words: list[list[str | int]] = [[] for _ in pieces]
        together = WORDS.findall(b"".join([p for p, ok in zip(pieces, plain.tolist(), strict=True) if ok]).decode("utf-8", "surrogatepass"))
        place = iter(np.flatnonzero(plain).tolist())
        own: list = []
        for w in together:
            if w[0] == " ":
                own = words[next(place)]
            own.append(w)
        rest = []
        for i in np.flatnonzero(~plain).tolist():
            text = pieces[i].decode("utf-8", "surrogatepass")
            for segment in self.split.split(text) if self.split else [text]:
                words[i] += [self.special[segment.encode()]] if segment.encode("utf-8", "surrogatepass") in self.special else WORDS.findall(segment)
            rest += [w for w in words[i] if not isinstance(w, int)]
        coded = self.coded_words(together + rest)
        coded |= {i: ([i], 1, self.decimal[i], t) for t, i in self.special.items()}
        return [coded[w[0]] if len(w) == 1 else joined([coded[x] for x in w]) for w in words]

    def decode_bytes(self, ids: list[int]) -> bytes:
        return b"".join([self.bytes_of[i] for i in ids if i in self.bytes_of])


def joined(parts: list[Coded]) -> Coded:
    return [i for p in parts for i in p[0]], sum(p[1] for p in parts), b",".join([p[2] for p in parts]), b"".join([p[3] for p in parts])


@cache
def bpe(path: str) -> Bpe:
    return Bpe(path)


@cache
def _coded(path: str) -> PieceStore:
    return PieceStore(bpe(path).encode, limit=120_000)


def _pieces_of(texts: pa.Array, path: str) -> tuple[list, list[int]]:
    """What the store has for each piece of all texts in turn, and where each text's pieces end."""
    raw, offsets = text_buffer(texts)
    start, end, counts = cut(raw, offsets)
    store = _coded(path)
    places = store.look_up(raw, start, end) if start.size else np.zeros(0, np.int64)
    return list(map(store.values.__getitem__, places.tolist())), [0, *np.cumsum(counts).tolist()]


def encode(df: DataFrame, text: str = "text", ids: str = "ids", path: str | None = None) -> DataFrame:
    """``df`` with the token ids of ``text`` as an array; null and empty texts get an empty array."""
    path = path or vocabulary_path()

    def compute(texts: pa.Array, _: pa.RecordBatch) -> dict[str, object]:
        found, ends = _pieces_of(texts, path)
        return {ids: pa.array([[i for p in found[a:b] for i in p[0]] for a, b in zip(ends, ends[1:], strict=False)], pa.list_(pa.int32()))}

    return add_columns(df, text, StructType([StructField(ids, ArrayType(IntegerType()))]), compute)


def decode(df: DataFrame, ids: str = "ids", text: str = "decoded", path: str | None = None) -> DataFrame:
    """``df`` with the text of the ids; bytes that aren't UTF-8 become U+FFFD. Null ids give an empty text."""
    path = path or vocabulary_path()
    kept = [df[f"`{c}`"] for c in df.columns if c != text]
    schema = StructType([f for f in df.schema.fields if f.name != text] + [StructField(text, StringType())])

    def run(batches):
        coder = bpe(path)
        for batch in batches:
            column = batch.column(ids).to_pylist()
            said = pa.array([coder.decode_bytes(i or []).decode("utf-8", "replace") for i in column], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, said], names=[*batch.schema.names, text])

    return df.select(kept).mapInArrow(run, schema)


def round_trip(df: DataFrame, text: str = "text", path: str | None = None) -> DataFrame:
    """``df`` with n_tokens and the SHA-256 of the decimal ids joined by commas and of the decoded text."""
    path = path or vocabulary_path()
    added = StructType([StructField("n_tokens", LongType()), StructField("ids_sha256", StringType()), StructField("decoded_sha256", StringType())])

    def compute(texts: pa.Array, _: pa.RecordBatch) -> dict[str, object]:
        found, ends = _pieces_of(texts, path)
        n, ids, decoded = [], [], []
        for a, b in zip(ends, ends[1:], strict=False):
            own = found[a:b]
            n.append(sum([p[1] for p in own]))
            ids.append(hashlib.sha256(b",".join([p[2] for p in own])).hexdigest())
            decoded.append(hashlib.sha256(b"".join([p[3] for p in own]).decode("utf-8", "replace").encode()).hexdigest())
        return {"n_tokens": pa.array(n, pa.int64()), "ids_sha256": pa.array(ids, pa.string()), "decoded_sha256": pa.array(decoded, pa.string())}

    return add_columns(df, text, added, compute)


@query("op5_bpe")
def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return round_trip(docs).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
