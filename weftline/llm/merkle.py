"""Merkle tree over the rows of a table, with a proof for each row.

Rows are ranked inside their group by id. The octal digits of the rank are grouped away one after another inside blocks
of 512 ranks: each step collects up to eight child structs, hashes their hashes in order and nests them, so a block ends as
one row that holds its whole subtree. Blocks are the leaves of the next round, 512 times smaller, until every group
has one node, its subroot; subroots in order of their group are rolled up alike and give the root. A tree of n leaves has as many
levels as it takes to get from n to one node by eights, so every leaf of a group is equally deep and a group of one row is its own subroot.

Proofs go the other way: a block's children are transformed into their hashes with what stands left and right of
them, and exploded, digit by digit, down to the rows. Inside a block nothing is joined; one row for 512 leaves brings the path above the block.

Only ids, groups and hashes are shuffled, never texts. A group of any size is dealt into sorted ranges for ranking (see
``ranking.py``) and into blocks afterwards; rows that are equal in all fields stay one row up to their block.

Fields are hashed as text, null as ``-``; integers in decimal. Null ids come first, a null group is a group of its own and comes
first; rows with equal ids stand in the order of their leaf hashes. Repeated rows are leaves of their own. An empty table has no rows, hence no root. Long
texts are hashed whole in the JVM. Only the named columns are read; others, whatever their names, don't matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.llm.ranking import counted, ranked
from weftline.llm.registry import query, table
from weftline.session import cut_lineage

#: Digits of the rank that one round groups away; a block has 8 ** DIGITS leaves.
DIGITS = 3
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
PATH = "array<struct<left:string,right:string>>"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def encoded(field: Column) -> Column:
    """A field as text that can't run into the next one: its length in bytes, a colon and itself; null is ``-``."""
    said = field.cast("string")
    return F.coalesce(F.concat(F.octet_length(said).cast("string"), F.lit(":"), said), F.lit("-"))


def leaf_of(fields: list[Column]) -> Column:
    return F.sha2(F.concat(*map(encoded, fields)), 256)


def height(leaves: Column) -> Column:
    """Levels above ``leaves`` leaves: how often eights of them are taken until one node is left."""
    return F.when(leaves <= 1, 0).otherwise(((F.length(F.bin(leaves - 1)) + 2) / 3).cast("int"))


def _hash_of(kids: str, reached: Column) -> Column:
    """Hash of a run, or of the only node where the tree has ended below."""
    return F.when(reached, F.sha2(F.array_join(F.col(f"{kids}.hash"), ""), 256)).otherwise(F.col(kids)[0]["hash"])


def blocks(nodes: DataFrame, keys: list[str]) -> DataFrame:
    """Stored rows (keys, block, height, hash, kids), one for each 8 ** DIGITS ranks of ``nodes``.

    ``nodes`` has keys, rank, copies, height (of the tree above these nodes), hash and item. ``kids`` nests (at, hash, kids) down to (at, hash, item).
    """
    bits = 3 * DIGITS
    span = F.explode(F.sequence(F.shiftright("rank", bits), F.shiftright(F.col("rank") + F.col("copies") - 1, bits))).alias("block")
    # Copies of a row are pieces of blocks up to the shuffle and rows after it.
    dealt = nodes.select(*keys, span, "rank", "copies", "height", "hash", "item").repartition(*keys, "block")
    low, high = F.greatest("rank", F.shiftleft("block", bits)), F.least(F.col("rank") + F.col("copies"), F.shiftleft(F.col("block") + 1, bits)) - 1
    level = dealt.select(*keys, "block", "height", "hash", "item", F.explode(F.sequence(low, high)).alias("at"))
    carried = "item"
    for digit in range(DIGITS):
        child = F.struct("at", "hash", carried)
        group = level.groupBy(*keys, "block", F.shiftright("at", 3).alias("up")).agg(
            F.first("height").alias("height"), F.sort_array(F.collect_list(child)).alias("kids"))
        level = group.select(*keys, "block", "height", _hash_of("kids", F.col("height") > digit).alias("hash"), "kids", F.col("up").alias("at"))
        carried = "kids"
    return cut_lineage(level.drop("at"))


def _beside(kids: Column, reached: Column) -> Column:
    """``kids`` with a ``step``: the hashes left and right of each, or no step where the tree has ended below."""
    def joined(found: Column) -> Column:
        return F.array_join(F.transform(found, lambda k: k["hash"]), "")

    def with_step(kid: Column) -> Column:
        step = F.struct(joined(F.filter(kids, lambda k: k["at"] < kid["at"])).alias("left"), joined(F.filter(kids, lambda k: k["at"] > kid["at"])).alias("right"))
        return F.struct(kid.alias("kid"), F.when(reached, F.array(step)).otherwise(F.array().cast(PATH)).alias("step"))

    return F.transform(kids, with_step)


def unrolled(found: DataFrame, above: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, at, hash, item, path, ends) of every leaf of the blocks ``found``; ``above`` has (keys, block, path, ends) for each block.

    ``path`` has the siblings of each level from the leaf upwards; ``ends`` is passed on.
    """
    same = F.col("b.block") == F.col("u.block")
    for k in keys:
        same &= F.col(f"b.{k}").eqNullSafe(F.col(f"u.{k}"))
    rows = found.alias("b").join(above.alias("u"), same).select(*[F.col(f"b.{k}") for k in keys], "b.height", "b.kids", "u.path", "u.ends")
    for digit in reversed(range(DIGITS)):
        rows = rows.select(*keys, "height", "path", "ends", F.explode(_beside(F.col("kids"), F.col("height") > digit)).alias("one"))
        rows = rows.select(*keys, "height", F.concat("one.step", "path").alias("path"), "ends", *([F.col("one.kid.kids").alias("kids")] if digit else ["one.kid.at", "one.kid.hash", "one.kid.item"]))
    return rows.drop("height")


def rollup(nodes: DataFrame, keys: list[str]) -> list[DataFrame]:
    """Rounds of ``blocks`` from the leaves up to one block for each tree."""
    rounds = [blocks(nodes, keys)]
    while rounds[-1].filter(F.col("height") > DIGITS).limit(1).count():
        above = rounds[-1].select(
            *keys, F.col("block").alias("rank"), F.lit(1).cast("long").alias("copies"), F.greatest(F.col("height") - DIGITS, F.lit(0)).alias("height"), "hash", F.lit(None).cast("string").alias("item"))
        rounds.append(blocks(above, keys))
    return rounds


def descend(rounds: list[DataFrame], tops: DataFrame, keys: list[str]) -> DataFrame:
    """Leaves of the lowest round with their paths; ``tops`` has (keys, path, ends) for each tree."""
    above = tops.withColumn("block", F.lit(0).cast("long"))
    for found in reversed(rounds[1:]):
        above = unrolled(found, above, keys).select(*keys, F.col("at").alias("block"), "path", "ends")
    return unrolled(rounds[0], above, keys)


def folded(start: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, start, lambda h, step: F.sha2(F.concat(step["left"], h, step["right"]), 256))


def proof_digest(path: Column) -> Column:
    return F.sha2(F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), ""), 256)


def manifest(df: DataFrame, fields: list[str], id_column: str, group: str, claimed: Column | None = None) -> DataFrame:
    """(id, group, leaf, claimed, path, subroot, root) for each row of ``df``.

    ``path`` has the hashes left and right of the row's node on each level, subroots included. ``claimed`` is another
    leaf hash that is carried along, such as one computed from a copy of the row; null where none is given.
    """
    leaf, claimed = leaf_of([df[f"`{f}`"] for f in fields]), F.lit(None).cast("string") if claimed is None else claimed
    rows = counted(df.select(df[f"`{group}`"].alias("grp"), df[f"`{id_column}`"].alias("id"), leaf.alias("leaf"), claimed.alias("claimed")))
    places = ranked(rows, ["grp"], ["id", "leaf", "claimed"])
    nodes = places.select("grp", "rank", "copies", height(F.col("rows")).alias("height"), F.col("leaf").alias("hash"), F.struct("id", "claimed").alias("item"))
    trees = rollup(nodes, ["grp"])
    subroots = counted(trees[-1].select("grp", "hash"))
    order = ranked(subroots, [], ["grp", "hash"]).select(
        F.lit(0).alias("all"), "rank", "copies", height(F.col("rows")).alias("height"), "hash", F.col("grp").alias("item"))
    tops = rollup(order, ["all"])
    roots = tops[-1].select("all", F.array().cast(PATH).alias("path"), F.col("hash").alias("ends"))
    named = descend(tops, roots, ["all"]).select(F.col("item").alias("grp"), "path", F.struct(F.col("hash").alias("subroot"), F.col("ends").alias("root")).alias("ends"))
    return descend(trees, cut_lineage(named), ["grp"]).select(
        F.col("item.id").alias("id"), F.col("grp").alias("group"), F.col("hash").alias("leaf"), "item.claimed", "path", "ends.subroot", "ends.root")


def _oracle(levels: int = 12) -> str:
    """Level by level in SQL; enough levels for 8 ** levels rows of a language and 8 ** 4 languages."""
    def said(c: str, value: str | None = None) -> str:
        value = value or f"CAST({c} AS VARCHAR)"
        return f"CASE WHEN {c} IS NULL THEN '-' ELSE CAST(strlen({value}) AS VARCHAR) || ':' || {value} END"

    def leaf(text: str | None = None) -> str:
        return "sha256(" + " || ".join(said(c, text if c == "text" else None) for c in FIELDS) + ")"

    lowered = f"translate(text, '{UPPER}', '{UPPER.lower()}')"
    crc = ("list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),"
           " lambda h, b: list_reduce(list_prepend(xor(h, b), range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1))))")
    ctes = [
        f"leaves AS (SELECT doc_id, lang, {leaf()} AS leaf, CASE WHEN xor({crc}, 4294967295) % 3 = 0 THEN {leaf(lowered)} ELSE {leaf()} END AS claimed FROM documents)",
        "placed AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf, claimed) - 1 AS pos FROM leaves)",
        "a0 AS (SELECT lang AS tree, pos, leaf AS hash, count(*) OVER (PARTITION BY lang) AS n FROM placed)"]

    def climb(name: str, count: int) -> None:
        for k in range(count):
            ctes.append(
                f"{name}{k}r AS (SELECT tree, pos // 8 AS pos, list(hash ORDER BY pos) AS run, any_value(n) AS n FROM {name}{k} GROUP BY tree, pos // 8)")
            ctes.append(
                f"{name}{k + 1} AS (SELECT tree, pos, CASE WHEN n > 1 THEN sha256(array_to_string(run, '')) ELSE run[1] END AS hash, (n + 7) // 8 AS n FROM {name}{k}r)")

    climb("a", levels)
    ctes.append(f"b0 AS (SELECT 0 AS tree, row_number() OVER (ORDER BY tree NULLS FIRST) - 1 AS pos, hash, count(*) OVER () AS n, tree AS lang FROM a{levels})")
    climb("b", 4)
    walk = "SELECT p.doc_id, p.lang, p.pos, p.leaf, p.claimed AS folded, '' AS proof, s.pos AS sub, s.hash AS subroot FROM placed p JOIN b0 s ON s.lang IS NOT DISTINCT FROM p.lang"
    ctes.append(f"w0 AS ({walk})")
    step = 0
    for name, count, at in (("a", levels, "pos"), ("b", 4, "sub")):
        for k in range(count):
            place = f"(w.{at} // {8 ** k}) % 8"
            same = "r.tree IS NOT DISTINCT FROM w.lang AND " if name == "a" else ""
            left, right = f"array_to_string(r.run[1:{place}], '')", f"array_to_string(r.run[{place} + 2:], '')"
            ctes.append(
                f"w{step + 1} AS (SELECT w.* REPLACE (CASE WHEN r.n > 1 THEN sha256({left} || w.folded || {right}) ELSE w.folded END AS folded,"
                f" CASE WHEN r.n > 1 THEN w.proof || {left} || {right} ELSE w.proof END AS proof) FROM w{step} w JOIN {name}{k}r r ON {same}r.pos = w.{at} // {8 ** (k + 1)})")
            step += 1
    return (f"WITH {', '.join(ctes)} SELECT w.doc_id, w.leaf, w.subroot, t.hash AS root, sha256(w.proof) AS proof_sha256, w.folded AS folded_root,"
            f" w.folded = t.hash AS verified FROM w{step} w, b4 t")


@query("op12_merkle", _oracle())
def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Claimed leaves are those of the tampered rows: where 3 divides the checksum of the id, the text is in lower case."""
    docs = table(spark, sf_dir, "documents")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    lowered = leaf_of([*map(F.col, FIELDS[:-1]), F.translate("text", UPPER, UPPER.lower())])
    found = manifest(docs, FIELDS, "doc_id", "lang", F.when(tampered, lowered))
    again = folded(F.coalesce("claimed", "leaf"), F.col("path"))
    return found.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"), again.alias("folded_root")).withColumn(
        "verified", F.col("folded_root") == F.col("root"))
