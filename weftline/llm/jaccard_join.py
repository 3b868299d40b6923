"""Near-duplicate groups by word shingles: a Jaccard join with prefixes of token combinations.

Equal sets are one node, so copies never pair with each other. Tokens (shingle hashes) are ordered by the number of
documents that have them, then by hash. A set with n tokens can only reach the threshold with a set that shares one
of its n - ceil(t n) + 1 first tokens; with k - 1 more tokens in the prefix it shares at least k.

* Tokens that one set alone has can't be shared: sets that are unlike all others leave the join here, without a row.
* Rare tokens (in up to ``RARE`` sets) of the extended prefix are indexed singly; their lists are short by definition.
* Frequent tokens of the extended prefix are dealt into g classes by hash. With k = g + 1, a pair that shares no rare
  token shares k frequent ones, hence two of one class: only combinations of two tokens of a class are indexed. g
  grows with the size of the sets, so combinations grow with the prefix and not with its square. Partners differ in size
  by at most the threshold, hence lie in the same or in neighbouring bands of sizes; a set is indexed for both of its borders.

Lists of combinations can be long where thousands of near copies share everything. Members of a list are first compared
with two hubs alone. One is the set with the fewest tokens of its own: what all others were copied from has none, and links with every member that
can link with any. Groups are formed from the links. Only lists that still hold several groups are
joined in full, and only between members of different groups: first a sixteenth of the lists, whose links join most of
what belongs together, then all lists. A large group of near copies so costs rows, not pairs.

Candidates pass a filter of sizes, of the numbers of tokens that one set alone has and of 512 parity bits of the other
tokens (all of the former differ, and of the latter at least as many as bits do), then the sets themselves are compared.
So members with many own tokens, which link with nothing, don't meet all others of their group in each of its lists.
Nothing is sampled or cut.

Document frequencies and the list of copies are arrays in the shared folder that workers map into memory.

Texts without words have empty sets and link with nothing, not even with each other. Documents with fewer words than a shingle have one
token. Repeated rows link like copies. The smallest id ignores null ids; a group without any id has a null component.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.llm import shared
from weftline.llm.registry import query, table
from weftline.llm.words import LOWER, SPACES, find_words, fold, hash_spans, mix, slices, text_buffer
from weftline.session import cut_lineage, scratch_path

WORDS = 3
PERCENT = 90
RARE = 16
RANGE_BYTES = 16 << 20
FLUSH_TOKENS = 3_000_000
COPIES_A_RANGE = 500_000
TOKENS_A_CLASS = 4
#: Every so-manyth list is joined, then all.
LIST_SHARES = (16, 1)
SKETCH_WORDS = 8
SKETCH = [f"s{i}" for i in range(SKETCH_WORDS)]


# Sets.

class Sets:
    """Distinct tokens of each text: ``tokens`` of text i stand from ``first[i]``, ``sizes[i]`` of them in order of their hashes."""

    def __init__(self, texts: pa.Array, words: int):
        raw, offsets = text_buffer(texts)
        raw = LOWER[raw]
        start, end, doc = find_words(raw, offsets, SPACES)
        hashes, n = hash_spans(raw, start, end), len(offsets) - 1
        counts = np.bincount(doc, minlength=n)
        first = np.cumsum(counts) - counts
        place = np.arange(hashes.size) - first[doc]
        per = np.where(counts >= words, counts - words + 1, np.minimum(counts, 1))
        head = np.flatnonzero(place < per[doc])
        token, width = hashes[head], np.minimum(counts[doc[head]], words)
        for k in range(1, words):
            longer = np.flatnonzero(width > k)
            token[longer] = fold(token[longer], hashes[head[longer] + k])
        token, owner = mix(token + width.astype(np.uint64)), doc[head]
        order = np.lexsort((token, owner))
        token, owner = token[order], owner[order]
        fresh = np.ones(token.size, bool)
        fresh[1:] = (token[1:] != token[:-1]) | (owner[1:] != owner[:-1])
        self.tokens, self.owner = token[fresh], owner[fresh]
        self.sizes = np.bincount(self.owner, minlength=n)
        self.first = np.cumsum(self.sizes) - self.sizes
        self.n = n

    def prints(self) -> np.ndarray:
        """128 bits for each set, two columns; sums over its tokens, so equal sets have equal prints."""
        out = np.zeros((self.n, 2), np.uint64)
        if self.tokens.size:
            for k in range(2):
                running = np.append(np.uint64(0), np.cumsum(mix(self.tokens ^ np.uint64(0x9E3779B97F4A7C15 * (k + 1) % (1 << 64)))))
                out[:, k] = mix(running[self.first + self.sizes] - running[self.first] + self.sizes.astype(np.uint64))
        return out

    def sketches(self, counted: np.ndarray | slice = slice(None)) -> np.ndarray:
        """Parity bits for each set, or for its ``counted`` tokens, as ``SKETCH_WORDS`` columns."""
        bits = 64 * SKETCH_WORDS
        cell = self.owner[counted] * bits + (mix(self.tokens[counted] ^ np.uint64(0xD1B54A32D192ED03)) % np.uint64(bits)).astype(np.int64)
        odd = (np.bincount(cell, minlength=self.n * bits) & 1).astype(np.uint8).reshape(self.n, bits)
        return np.packbits(odd, axis=1).view(np.int64).reshape(self.n, SKETCH_WORDS)


def print_column(prints: np.ndarray) -> pa.Array:
    return pa.array([p.tobytes() for p in prints], pa.binary())


def ceil_share(n: np.ndarray, percent: int) -> np.ndarray:
    return (n * percent + 99) // 100


def set_table(rows: DataFrame, words: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                own = Sets(part.column("text"), words)
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("key"), pa.array(own.sizes, pa.int64()), print_column(own.prints())], names=["id", "key", "n", "print"])

    return cut_lineage(rows.mapInArrow(run, "id long, key long, n long, print binary"))


# Copies and frequencies as mapped arrays.

def range_of(high: np.ndarray, ranges: int) -> np.ndarray:
    return (((high >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)).astype(np.int64)


def write_copies(sets: DataFrame, folder: str, rows: int) -> int:
    """Prints that several rows share with the smallest id of those rows; the number of files."""
    ranges = max(1, -(-rows // COPIES_A_RANGE))
    shared_prints = sets.filter("n > 0").groupBy("print").agg(F.count("*").alias("rows"), F.min("id").alias("id")).filter("rows > 1")

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            high = np.frombuffer(b"".join(p[:8] for p in batch.column("print").to_pylist()), np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("print"), batch.column("id"), pa.array(range_of(high, ranges), pa.int64())], names=["print", "id", "range"])

    def write(group: pa.Table) -> pa.Table:
        prints = np.frombuffer(b"".join(group.column("print").to_pylist()), np.uint64).reshape(-1, 2)
        order = np.argsort(prints[:, 0])
        ids = group.column("id").combine_chunks()
        shared.put(folder, f"copies-{group.column('range')[0].as_py():07d}", prints[order, 0], prints[order, 1], ids.fill_null(0).to_numpy(zero_copy_only=False)[order], np.asarray(ids.is_valid()).astype(np.uint8)[order])
        return pa.table({"done": pa.array([group.num_rows], pa.int64())})

    shared_prints.select("print", "id").mapInArrow(spread, "print binary, id long, range long").groupBy("range").applyInArrow(write, "done long").write.format("noop").mode("overwrite").save()
    return ranges


def is_first(prints: np.ndarray, ids: pa.Array, folder: str, ranges: int) -> np.ndarray:
    """Which rows stand for their set: all but those that share it with a row of a smaller id."""
    out = np.ones(len(prints), bool)
    own, known = ids.fill_null(0).to_numpy(zero_copy_only=False), np.asarray(ids.is_valid())
    at = range_of(prints[:, 0], ranges)
    for r in np.unique(at).tolist():
        rows = np.flatnonzero(at == r)
        try:
            raw = shared.mapped(folder, f"copies-{r:07d}")
        except FileNotFoundError:  # no copies in this range
            continue
        high, low, first, valid = shared.columns(raw, "u8", "u8", "i8", "u1")
        place = np.minimum(np.searchsorted(high, prints[rows, 0]), high.size - 1)
        met = (high[place] == prints[rows, 0]) & (low[place] == prints[rows, 1]) & (valid[place] == 1)
        out[rows[met & ~(known[rows] & (own[rows] == first[place]))]] = False
    return out


def write_frequencies(rows: DataFrame, words: int, folder: str, copies: int, size: int) -> int:
    """Tokens that two sets or more have (their upper 48 bits) with how many do; the number of files."""
    ranges = max(1, -(-size // RANGE_BYTES))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def flush() -> Iterator[pa.RecordBatch]:
            tokens, counts = np.unique(np.concatenate(held) if held else np.zeros(0, np.uint64), return_counts=True)
            held.clear()
            at = range_of(tokens << np.uint64(16), ranges)
            edges = np.flatnonzero(np.diff(at, prepend=-1, append=ranges))
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                steps = np.diff(tokens[a:b], prepend=tokens[a:a + 1])
                kind = np.uint32 if steps.max(initial=0) < 1 << 32 else np.uint64
                body = steps.astype(kind).tobytes() + counts[a:b].astype(np.uint32).tobytes()
                header = np.array([b - a, np.dtype(kind).itemsize, len(body), int(tokens[a])], np.int64).tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([at[a]], pa.int64()), pa.array([header + pa.compress(body, "zstd", asbytes=True)], pa.binary())], names=["range", "package"])

        for batch in batches:
            for part in slices(batch, "text"):
                own = Sets(part.column("text"), words)
                first = is_first(own.prints(), part.column("id"), folder, copies)
                held.append(own.tokens[first[own.owner]] >> np.uint64(16))
                if sum(map(len, held)) >= FLUSH_TOKENS:
                    yield from flush()
        yield from flush()

    def merge(group: pa.Table) -> pa.Table:
        tokens, counts = [], []
        for column in group.column("package").iterchunks():
            for package in column:
                raw = package.as_py()
                n, kind, full, start = np.frombuffer(raw, np.int64, 4).tolist()
                body = pa.decompress(raw[32:], full, "zstd", asbytes=True)
                steps = np.frombuffer(body, np.uint32 if kind == 4 else np.uint64, n)
                tokens.append(np.cumsum(steps, dtype=np.uint64) + np.uint64(start))
                counts.append(np.frombuffer(body, np.uint32, n, n * kind))
        token, number = np.concatenate(tokens), np.concatenate(counts)
        order = np.argsort(token)
        token, number = token[order], number[order].astype(np.int64)
        first = np.flatnonzero(np.append(True, token[1:] != token[:-1]))
        number = np.add.reduceat(number, first)
        often = number > 1
        if often.any():
            shared.put(folder, f"frequencies-{group.column('range')[0].as_py():07d}", token[first][often], number[often].astype(np.uint32))
        return pa.table({"done": pa.array([int(often.sum())], pa.int64())})

    rows.mapInArrow(count, "range long, package binary").groupBy("range").applyInArrow(merge, "done long").write.format("noop").mode("overwrite").save()
    return ranges


def frequencies(tokens: np.ndarray, folder: str, ranges: int) -> np.ndarray:
    """In how many sets each token is: 1, or the stored number."""
    wanted, inverse = np.unique(tokens >> np.uint64(16), return_inverse=True)
    out = np.ones(wanted.size, np.int64)
    at = range_of(wanted << np.uint64(16), ranges)
    edges = np.flatnonzero(np.diff(at, prepend=-1, append=ranges))
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        try:
            raw = shared.mapped(folder, f"frequencies-{at[a]:07d}")
        except FileNotFoundError:  # no token of this range in two sets
            continue
        keys, counts = shared.columns(raw, "u8", "u4")
        place = np.minimum(np.searchsorted(keys, wanted[a:b]), keys.size - 1)
        met = np.flatnonzero(keys[place] == wanted[a:b])
        out[a + met] = counts[place[met]]
    return out[inverse]


# The index.

INDEX = f"kind int, sig long, print binary, n long, alone int, {', '.join(f'{s} long' for s in SKETCH)}, tokens binary"
SET, SINGLE, PAIR = 0, 1, 2


def size_bands(percent: int, upto: int) -> np.ndarray:
    """Lower borders of bands of set sizes; partners are in one band or in neighbouring ones."""
    borders = [1]
    while borders[-1] <= upto:
        # The next band starts above all sizes that a set of this border can pair with.
        borders.append(max(borders[-1] * 100 // percent, borders[-1]) + 1)
    return np.array(borders)


def signatures(tokens: np.ndarray, often: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(single signatures, combination signatures) of one set in order of (frequency, hash)."""
    n = tokens.size
    plain = n - int(ceil_share(np.array(n), percent)) + 1
    borders = size_bands(percent, n)
    band = int(np.searchsorted(borders, n, "right")) - 1
    singles, pairs = [], []
    for border in {band - 1, band}:
        base = int(borders[max(border, 0)])
        classes = max(1, (base - int(ceil_share(np.array(base), percent)) + 1) // TOKENS_A_CLASS)
        # Sets of both bands share more tokens than that, or there are fewer tokens than classes to share them.
        reach = min(n, plain + classes)
        rare = (often[:reach] > 1) & (often[:reach] <= RARE)
        singles.append(tokens[:reach][rare])
        common = tokens[:reach][often[:reach] > RARE]
        group = (mix(common ^ np.uint64(base)) % np.uint64(classes)).astype(np.int64)
        order = np.argsort(group, kind="stable")
        common, group = common[order], group[order]
        for step in range(1, int(np.bincount(group).max(initial=0))):
            same = group[step:] == group[:-step]
            low, high = np.minimum(common[:-step][same], common[step:][same]), np.maximum(common[:-step][same], common[step:][same])
            pairs.append(fold(fold(low, high), np.full(low.size, base, np.uint64)))
    none = np.zeros(0, np.uint64)
    return np.unique(np.concatenate(singles)) if singles else none, np.concatenate(pairs) if pairs else none


def write_index(rows: DataFrame, words: int, percent: int, folder: str, copies: int, ranges: int) -> str:
    """Stored rows of ``INDEX``: signatures of every set that can have a partner, and its tokens."""
    least = -(-percent // (100 - percent)) if percent < 100 else 1 << 62

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                own = Sets(part.column("text"), words)
                prints = own.prints()
                often = frequencies(own.tokens, folder, ranges)
                prefix = own.sizes - ceil_share(own.sizes, percent) + 1
                alone = np.append(0, np.cumsum(often == 1))
                alone = alone[own.first + own.sizes] - alone[own.first]
                # Smaller sets only pair with equal ones. A prefix of tokens that no other set has can't be shared.
                open_sets = is_first(prints, part.column("id"), folder, copies) & (own.sizes >= least) & (alone < prefix)
                sketch = own.sketches(often > 1)
                kind, sig, whose, sets = [], [], [], []
                for i in np.flatnonzero(open_sets).tolist():
                    at = slice(own.first[i], own.first[i] + own.sizes[i])
                    order = np.lexsort((own.tokens[at], often[at]))
                    singles, pairs = signatures(own.tokens[at][order], often[at][order], percent)
                    if not singles.size and not pairs.size:
                        continue
                    kind += [np.full(1, SET), np.full(singles.size, SINGLE), np.full(pairs.size, PAIR)]
                    sig += [np.zeros(1, np.uint64), singles, pairs]
                    whose.append(np.full(1 + singles.size + pairs.size, i))
                    sets += [own.tokens[at].tobytes()] + [None] * (singles.size + pairs.size)
                if whose:
                    who = np.concatenate(whose)
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.concatenate(kind), pa.int32()), pa.array(np.concatenate(sig).view(np.int64), pa.int64()), print_column(prints).take(pa.array(who)),
                        pa.array(own.sizes[who], pa.int64()), pa.array(alone[who], pa.int32()), *(pa.array(sketch[who, k], pa.int64()) for k in range(SKETCH_WORDS)), pa.array(sets, pa.binary())],
                        names=["kind", "sig", "print", "n", "alone", *SKETCH, "tokens"])

    path = scratch_path(rows.sparkSession, "signatures")
    rows.mapInArrow(run, INDEX).write.partitionBy("kind").parquet(path)
    return path


def read_index(spark: SparkSession, path: str, kind: int) -> DataFrame:
    found = spark.read.schema(INDEX).parquet(path).filter(F.col("kind") == kind)
    return found.select("print", "tokens") if kind == SET else found.select("sig", "print", "n", "alone", *SKETCH).distinct()


# Pairs and groups.

def near(percent: int) -> Column:
    """Whether sizes, own tokens and parity bits of the other tokens of the rows a and b allow the threshold."""
    n, m = F.col("a.n"), F.col("b.n")
    overlap = F.ceil((n + m) * percent / (100 + percent) - 1e-9)
    apart = sum((F.bit_count(F.col(f"a.{s}").bitwiseXOR(F.col(f"b.{s}"))) for s in SKETCH), F.lit(0))
    return (n * 100 >= m * percent) & (m * 100 >= n * percent) & (apart + F.col("a.alone") + F.col("b.alone") <= n + m - 2 * overlap)


def pairs_of(left: DataFrame, right: DataFrame, condition: Column, percent: int) -> DataFrame:
    """Distinct (print, other) of rows that share a signature and may reach the threshold."""
    met = left.alias("a").join(right.alias("b"), (F.col("a.sig") == F.col("b.sig")) & condition & near(percent))
    first, second = F.least("a.print", "b.print"), F.greatest("a.print", "b.print")
    return met.select(first.alias("print"), second.alias("other")).distinct()


def linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The ``pairs`` whose sets reach the threshold."""
    both = pairs.join(sets, "print").join(sets.select(F.col("print").alias("other"), F.col("tokens").alias("others")), "other")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for a, b in zip(batch.column("tokens"), batch.column("others"), strict=True):
                x, y = np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64)
                if x.size > y.size:
                    x, y = y, x
                both_have = int((y[np.minimum(np.searchsorted(y, x), y.size - 1)] == x).sum())
                keep.append(100 * both_have >= percent * (x.size + y.size - both_have))
            yield batch.select(["print", "other"]).filter(pa.array(keep, pa.bool_()))

    return both.select("print", "other", "tokens", "others").mapInArrow(run, "print binary, other binary")


def components(links: DataFrame) -> DataFrame:
    """(print, root) of all linked nodes, by stars: each round hangs greater neighbours, then all smaller ones, on the least."""
    edges = cut_lineage(links.select(F.greatest("print", "other").alias("a"), F.least("print", "other").alias("b")).filter("a <> b").distinct())
    last = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        small = large.groupBy("a").agg(F.min("b").alias("m"))
        hung = large.join(small, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(small.select("a", F.col("m").alias("b")))
        edges = cut_lineage(hung.filter("a <> b").distinct())
        state = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if state == last:
            break
        last = state
    return edges.select(F.col("a").alias("print"), F.col("b").alias("root")).unionByName(edges.select(F.col("b").alias("print"), F.col("b").alias("root")).distinct())


def lists_of_groups(combined: DataFrame, links: DataFrame) -> DataFrame:
    """Stored rows of the lists that hold several groups of linked sets, with their ``root`` and the ``main`` one of their list, its largest."""
    grouped = combined.join(components(links), "print", "left").withColumn("root", F.coalesce("root", "print"))
    sizes = grouped.groupBy("sig", "root").agg(F.count("*").alias("rows"))
    lists = sizes.groupBy("sig").agg(F.max_by("root", F.struct("rows", "root")).alias("main"), F.count("*").alias("groups")).filter("groups > 1")
    return cut_lineage(grouped.join(lists.select("sig", "main"), "sig"))


def links_of(spark: SparkSession, path: str, percent: int) -> DataFrame:
    """(print, other): links that join every group of linked sets. Within a group not all links are listed."""
    sets, singles, combined = (read_index(spark, path, k) for k in (SET, SINGLE, PAIR))
    # Lists of rare tokens hold up to RARE sets.
    short = pairs_of(singles, singles, F.col("a.print") < F.col("b.print"), percent)
    row = F.struct("alone", "print", "n", *SKETCH)
    # A hub of the fewest own tokens, and one picked by its print for lists of several origins.
    ends = combined.groupBy("sig").agg(F.min(row).alias("low"), F.max(F.struct("print", "alone", "n", *SKETCH)).alias("high"), F.count("*").alias("rows")).filter("rows > 1")
    hubs = ends.select("sig", "low.*").unionByName(ends.filter("low.print <> high.print").select("sig", "high.*"))
    stars = pairs_of(combined, hubs, F.col("a.print") != F.col("b.print"), percent)
    found = cut_lineage(linked(short.unionByName(stars).distinct(), sets, percent))
    for share in LIST_SHARES:
        split = lists_of_groups(combined.filter(F.pmod("sig", F.lit(share)) == 0), found)
        rest = pairs_of(split.filter("root <> main"), split, F.col("a.root") != F.col("b.root"), percent)
        found = cut_lineage(found.unionByName(linked(rest, sets, percent)))
    return found


def rows_of_groups(df: DataFrame, id_column: str, text: str, words: int, percent: int) -> DataFrame:
    """(id, key, n, component, first) for each row of ``df``; ``first`` has the id and key of the row that stands for the group."""
    spark = df.sparkSession
    rows = df.select(df[f"`{id_column}`"].cast("long").alias("id"), df[f"`{text}`"].alias("text"))
    folder = shared.new_folder(spark, "jaccard")
    sets = set_table(rows.withColumn("key", F.xxhash64("text")), words)
    number = sets.count()
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    copies = write_copies(sets, folder, number)
    ranges = write_frequencies(rows, words, folder, copies, size)
    roots = cut_lineage(components(links_of(spark, write_index(rows, words, percent, folder, copies, ranges), percent)))
    row = F.struct(F.col("id").isNull().alias("no_id"), "id", "key")
    own = sets.filter("n > 0").groupBy("print").agg(F.min("id").alias("least"), F.min(row).alias("first"))
    joined = own.join(roots, "print", "left").withColumn("root", F.coalesce("root", "print"))
    group = joined.groupBy("root").agg(F.min("least").alias("component"), F.min("first").alias("group_first"), F.count("*").alias("sets"))
    # Sets that neither copies nor links reach are their own component.
    named = joined.join(group.filter("sets > 1"), "root", "left").select(
        "print", F.coalesce("component", "least").alias("component"), F.coalesce("group_first", "first").alias("first"))
    out = sets.join(named, "print", "left")
    return out.select("id", "key", "n", F.when(F.col("n") == 0, F.col("id")).otherwise(F.col("component")).alias("component"), "first")


def groups(df: DataFrame, id_column: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(id, key, n, component) for each row of ``df``; ``key`` is a hash of the text, for joining back."""
    return rows_of_groups(df, id_column, text, words, percent).drop("first")


def keep_first(df: DataFrame, id_column: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``df`` with one row of each group, one of the smallest id; all columns are kept.

    Of several texts under that id, and of a group without ids, the text of the smallest hash stays; of repeated rows one
    stays. Rows without words are in no group and all stay.
    """
    found = cut_lineage(rows_of_groups(df, id_column, text, words, percent).filter("n > 0").select(
        F.col("id").alias("_id"), F.col("key").alias("_key"), (F.col("id").eqNullSafe(F.col("first.id")) & (F.col("key") == F.col("first.key"))).alias("_first")))
    gone = found.filter("NOT _first").select("_id", "_key").distinct()
    repeated = cut_lineage(found.filter("_first").groupBy("_id", "_key").agg(F.count("*").alias("rows")).filter("rows > 1").select("_id", "_key"))

    def same(keys: DataFrame) -> Column:
        return df[f"`{id_column}`"].cast("long").eqNullSafe(keys["_id"]) & (F.xxhash64(df[f"`{text}`"]) == keys["_key"])

    once = gone.unionByName(repeated)
    # Repeated rows meet by id and text in an aggregation that combines them before the shuffle.
    row, order = F.struct(*(df[f"`{c}`"] for c in df.columns)), F.to_json(F.struct(*(df[f"`{c}`"] for c in df.columns)))
    one = df.join(repeated, same(repeated), "left_semi").groupBy(
        df[f"`{id_column}`"].cast("long").alias("_id"), F.xxhash64(df[f"`{text}`"]).alias("_key")).agg(F.min_by(row, F.xxhash64(order)).alias("_row"))
    return df.join(once, same(once), "left_anti").unionByName(one.select("_row.*"))


@query("op7_jaccard_join")
def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = groups(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))
