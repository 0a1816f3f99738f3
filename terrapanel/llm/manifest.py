"""Merkle manifest of a table: one tree a source, one tree over the sources, a proof for every row.

Nested-struct rollup.  A row's rank in its tree is written in base RUN.  The last DIGITS digits are
columns of their own and are grouped away one after the other: each grouping sorts the children of
one node by their digit, nests them in a struct and hashes them.  What shares the rest of the rank is a
block of at most RUN ** DIGITS rows; all groupings of a block use one exchange, and no struct
grows beyond a block.  Blocks are the rows of the next round, until one node a tree is left.

On the way back each block meets the siblings above it (a union and a regrouping, no join),
and one transform over its nested children gives every child its siblings, level by level; the last
one is exploded into the proofs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrapanel.llm.common import materialise
from terrapanel.llm.sharding import global_prefix

RUN = 16
#: Rank digits that one round groups away: blocks of 256 rows.
DIGITS = 2
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: One of so many documents is tampered with to test the proofs.
TAMPER_EVERY = 5
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LEVELS = "array<struct<left:string,right:string>>"


def digest(*columns: Column) -> Column:
    return F.sha2(F.concat(*columns), 256)


def encoded(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value."""
    value = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf(values: list[Column]) -> Column:
    return digest(*[encoded(v) for v in values])


def ranked(rows: DataFrame, tree: str, order: list[str]) -> DataFrame:
    """Add ``tree``, ``rank`` (from 0) and ``n`` (rows) within equal values of the column ``tree``."""
    placed = materialise(global_prefix(rows.withColumn("_one", F.lit(1)), [tree, *order], "_one").drop("_one", "_before", "_total"))
    sizes = placed.groupBy(tree).agg(F.min("_position").alias("_first"), F.count("*").alias("n"))
    sizes = sizes.withColumnRenamed(tree, "tree")
    return placed.join(sizes, F.col(tree).eqNullSafe(F.col("tree"))).withColumn("rank", F.col("_position") - F.col("_first")).drop("_position", "_first")


def _nodes(n: str, level: int) -> Column:
    """Nodes that are left of ``n`` after ``level`` groupings."""
    return F.ceil(F.col(n) / F.lit(RUN**level)) if level else F.col(n)


def rolled(items: DataFrame) -> DataFrame:
    """tree, rank, n, hash, children, below: one row a block of ``items`` (tree, rank, n, hash, load), written.

    ``below`` is the number of items in the tree, ``n`` that of blocks.  A node whose level has no
    other node in its tree is not hashed again.
    """
    digits = [F.pmod(F.floor(F.col("rank") / F.lit(RUN**k)), F.lit(RUN)).cast("int").alias(f"d{k}") for k in range(DIGITS)]
    block = F.floor(F.col("rank") / F.lit(RUN**DIGITS)).cast("long").alias("block")
    nodes = items.select("tree", block, "n", *digits, "hash", "load").repartition("tree", "block")
    nodes = nodes.withColumn("node", F.struct(F.col("d0").alias("digit"), "hash", "load"))
    for level in range(DIGITS):
        rest = [f"d{k}" for k in range(level + 1, DIGITS)]
        grouped = nodes.groupBy("tree", "block", "n", *rest).agg(F.array_sort(F.collect_list("node")).alias("children"))
        joined = digest(F.array_join(F.transform("children", lambda c: c["hash"]), ""))
        nodes = grouped.withColumn("hash", F.when(_nodes("n", level) > 1, joined).otherwise(F.col("children")[0]["hash"]))
        if rest:
            nodes = nodes.withColumn("node", F.struct(F.col(rest[0]).alias("digit"), "hash", "children"))
    return materialise(nodes.select("tree", F.col("block").alias("rank"), _nodes("n", DIGITS).cast("long").alias("n"),
                                    "hash", "children", F.col("n").alias("below")))


def rounds(items: DataFrame) -> list[DataFrame]:
    """Blocks of the rows, blocks of these blocks and so on, until every tree is one node."""
    out = [rolled(items)]
    while (out[-1].agg(F.max("n")).first()[0] or 0) > 1:
        out.append(rolled(out[-1].select("tree", "rank", "n", "hash", F.struct("rank").alias("load"))))
    return out


def _met(blocks: DataFrame, above: DataFrame) -> DataFrame:
    """Each block with what ``above`` (tree, rank, levels, subroot, root) says of it: regrouped, not joined."""
    kinds = {f.name: f.dataType for f in [*blocks.schema, *above.schema]}
    names = ["tree", "rank", "children", "below", "levels", "subroot", "root"]
    sides = [side.select(*[F.col(c) if c in side.columns else F.lit(None).cast(kinds[c]).alias(c) for c in names])
             for side in (blocks, above)]
    firsts = [F.first(c, ignorenulls=True).alias(c) for c in names[2:]]
    return sides[0].unionByName(sides[1]).groupBy("tree", "rank").agg(*firsts).where(F.col("children").isNotNull())


def _emitted(children: Column, level: int, levels: Column, emit) -> Column:
    """``emit(child, levels)`` of every row of a block; ``levels``: the siblings above it, nearest first."""
    hashes = F.transform(children, lambda c: c["hash"])

    def one(child: Column, at: Column) -> Column:
        run = F.struct(F.array_join(F.slice(hashes, F.lit(1), at), "").alias("left"),
                       F.array_join(F.slice(hashes, at + 2, F.lit(RUN)), "").alias("right"))
        own = F.concat(F.when(_nodes("below", level) > 1, F.array(run)).otherwise(F.array().cast(_LEVELS)), levels)
        return emit(child, own) if level == 0 else _emitted(child["children"], level - 1, own, emit)

    found = F.transform(children, one)
    return found if level == 0 else F.flatten(found)


def _unfolded(blocks: DataFrame, above: DataFrame, emit) -> DataFrame:
    """The rows of a round's blocks, by one transform and one explode."""
    met = _met(blocks, above)
    found = _emitted(F.col("children"), DIGITS - 1, F.col("levels"), emit)
    return met.select("tree", "subroot", "root", F.explode(found).alias("row"))


def _descended(rolls: list[DataFrame], above: DataFrame, emit) -> DataFrame:
    """Rows of the first round, from what stands above the last one."""
    for blocks in reversed(rolls[1:]):
        rows = _unfolded(blocks, above, lambda child, levels: F.struct(child["load"]["rank"].alias("rank"), levels.alias("levels")))
        above = rows.select("tree", "row.rank", "row.levels", "subroot", "root")
    return _unfolded(rolls[0], above, emit)


def fold(leaf_hash: Column, levels: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(levels, leaf_hash, lambda h, x: digest(x["left"], h, x["right"]))


def manifest(rows: DataFrame, tree: str, order: list[str], key: str = "key", claimed: str = "claimed") -> DataFrame:
    """key, leaf, subroot, root, proof_sha256, folded_root, verified: one row a row of ``rows``.

    ``rows`` has ``leaf`` (hex digest), ``claimed`` (the leaf that is to be proved), ``key``, the
    ``tree`` column and the ``order`` columns; leaves ascend by them, null first, then by the leaf itself, so
    rows that tie have one order.  Trees are ordered by their name, null first.
    """
    columns = list(dict.fromkeys([tree, *order, key, "leaf", claimed]))
    placed = ranked(rows.select(*columns), tree, [*order, "leaf"])
    load = F.struct(F.col(key).alias("key"), F.col(claimed).alias("claimed"))
    trees = rounds(placed.select("tree", "rank", "n", F.col("leaf").alias("hash"), load.alias("load")))

    # The same over the trees' roots; the second tree has no name.
    tops = trees[-1].select(F.lit(0).alias("all"), F.col("tree").alias("name"), F.col("hash").alias("subroot"))
    tops = ranked(tops, "all", ["name"]).withColumn("tree", F.lit(""))
    forest = rounds(tops.select("tree", "rank", "n", F.col("subroot").alias("hash"), F.struct("name", "subroot").alias("load")))
    top = forest[-1].select("tree", "rank", F.array().cast(_LEVELS).alias("levels"), F.lit("").alias("subroot"), F.col("hash").alias("root"))
    named = _descended(forest, top, lambda child, levels: F.struct(child["load"].alias("load"), levels.alias("levels")))
    above = materialise(named.select(F.col("row.load.name").alias("tree"), F.lit(0).cast("long").alias("rank"), "row.levels",
                                     F.col("row.load.subroot").alias("subroot"), "root"))

    def proved(child: Column, levels: Column) -> Column:
        siblings = F.array_join(F.transform(levels, lambda x: F.concat(x["left"], x["right"])), "")
        return F.struct(child["load"]["key"].alias("key"), child["hash"].alias("leaf"), F.sha2(siblings, 256).alias("proof_sha256"),
                        fold(child["load"]["claimed"], levels).alias("folded_root"))

    found = _descended(trees, above, proved)
    return found.select("row.key", "row.leaf", "subroot", "root", "row.proof_sha256", "row.folded_root",
                        (F.col("row.folded_root") == F.col("root")).alias("verified"))


def document_manifest(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified: one row a row of documents.

    A null field is ``-``, an empty one ``0:``.  Null sources are a tree of their own, before all others; null
    doc_ids come first in theirs and are not tampered with; rows that tie are ordered by their
    leaf, so repeated rows are alike in any order.  An empty table gives an empty manifest.  Where TAMPER_EVERY
    divides the crc32 of the doc_id, the claimed leaf is that of the text with A-Z in lower case.
    """
    columns = {c: F.col(c) for c in FIELDS}
    touched = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % TAMPER_EVERY == 0, F.lit(False))
    lowered = leaf([*list(columns.values())[:-1], F.translate("text", _UPPER, _LOWER)])
    rows = docs.select("doc_id", "source", leaf(list(columns.values())).alias("leaf"), F.when(touched, lowered).alias("other"))
    rows = rows.withColumn("claimed", F.coalesce("other", "leaf"))
    return manifest(rows, "source", ["doc_id"], key="doc_id").withColumnRenamed("key", "doc_id")
