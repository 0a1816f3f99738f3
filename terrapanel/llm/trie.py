"""Prefix trie of conversations by truncation peeling.

A node is a distinct sequence of first turns.  Its key is a chained 128-bit digest of these turns, so
equal keys are equal prefixes and texts themselves never move.  Conversations enter at their
last turn.  From the greatest depth on, those that end at a depth are merged with the nodes that survive
there, every node of that depth is finished and emitted, its last turn is stripped, and what is left is
regrouped by the shorter prefix.  Work grows with the nodes, not with turns times members.

Depths are cut into stretches, 1 to FIRST and then ever twice as long, so that a very long
conversation costs a logarithmic number of shuffles.  A stretch first merges all conversations with the same
turns in it (map-side).  In a deep stretch the paths below one prefix come sorted, and the deepest open
node is stripped as soon as a path leaves it: the task holds one path, however many there
are.  In the first stretch, where prefixes are shared by very many, each depth is one aggregate of its own,
with partial sums before the shuffle.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterable, Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrapanel.llm.common import map_batches, materialise, shuffle_partitions

#: Depths of the first stretch, in which each depth is an aggregate of its own.
FIRST = 16
#: Bytes of a key.
KEY = 16
ROOT = bytes(KEY)
#: Conversations of a family take over their head from its first one.
FAMILY = 5
HEAD_MOD = 9


def digests(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, digest, size: one narrow row a turn; null roles and texts are empty.

    Rows with a null conv_id are no conversation's and are left out.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    both = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.unhex(F.sha2(both, 256)).alias("digest"), F.octet_length(text).cast("long").alias("size"))


def _turns(frames: Iterable[pd.DataFrame]) -> Iterator[tuple]:
    for frame in frames:
        yield from zip(frame["conv_id"], frame["digest"], frame["size"], strict=True)


def _conversations(rows: Iterable[tuple]) -> Iterator[tuple[int, list]]:
    """Each conversation with its turns, as they are."""
    conv, turns = None, []
    for c, digest, size in rows:
        if c != conv:
            if conv is not None:
                yield conv, turns
            conv, turns = c, []
        turns.append((digest, size))
    if conv is not None:
        yield conv, turns


def _rebuilt(rows: Iterable[tuple]) -> Iterator[tuple[int, list]]:
    """Each conversation with its first h turns replaced by those of its family's first conversation.

    That one comes first in its family, so its head of at most HEAD_MOD - 1 turns is at hand.
    """
    base, head = None, []
    for conv, turns in _conversations(rows):
        first = conv - conv % FAMILY
        if first != base:
            base, head = first, turns[: HEAD_MOD - 1] if conv == first else []
        h = zlib.crc32(str(conv).encode()) % HEAD_MOD
        yield conv, head[:h] + turns[h:]


def _stretch(number: int) -> tuple[int, int]:
    """The depths (from, to] of a stretch."""
    return (0, FIRST) if number == 0 else (FIRST << (number - 1), FIRST << number)


_PATHS = "conv_id long, stretch int, top binary, path binary, sizes array<long>, depth long, ends boolean"


def paths(conversations: DataFrame, rebuild: bool = False) -> DataFrame:
    """One row a conversation and stretch: the key above it, its keys and text sizes there, where it ends.

    Turns go by ``turn`` (null first), ties by digest.  A conversation without turns left ends at the root.
    ``rebuild``: each conversation's first h turns come from the first one of its family, see :func:`_rebuilt`.
    Rows are dealt by family and streamed; a task holds one conversation's digests.
    """
    rows = digests(conversations)
    family = F.col("conv_id") - F.pmod("conv_id", F.lit(FAMILY)) if rebuild else F.col("conv_id")
    n = shuffle_partitions(conversations.sparkSession)
    dealt = rows.withColumn("family", family).repartition(n, "family").sortWithinPartitions(
        "family", "conv_id", "turn", "digest").drop("turn", "family")
    order = _rebuilt if rebuild else _conversations

    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out = []
        for conv, turns in order(_turns(frames)):
            keys, key = [], ROOT
            for digest, _ in turns:
                key = hashlib.blake2b(key + digest, digest_size=KEY).digest()
                keys.append(key)
            sizes = [size for _, size in turns]
            number, (a, b) = 0, _stretch(0)
            while number == 0 or a < len(keys):
                out.append((conv, number, keys[a - 1] if a else ROOT, b"".join(keys[a:b]), sizes[a:b], a, len(keys) <= b))
                number += 1
                a, b = _stretch(number)
            if len(out) >= 2000:
                yield pd.DataFrame(out, columns=_NAMES)
                out = []
        yield pd.DataFrame(out, columns=_NAMES)

    return materialise(map_batches(dealt, run, _PATHS))


_NAMES = [c.split()[0] for c in _PATHS.split(", ")]

def _end() -> Column:
    """The key that a path ends at; an empty one ends where it begins."""
    return F.when(F.length("path") > 0, F.expr(f"substring(path, length(path) - {KEY - 1}, {KEY})")).otherwise(F.col("top"))



#: What is known of a node while its subtree is merged: members, the smallest one, children, childless nodes and saved bytes below.
_STATE = {"n": F.sum, "least": F.min, "children": F.sum, "leaves": F.sum, "saved": F.sum}
_NODE = ["key", "parent", "depth", "size", *_STATE]
_PEELED = "node boolean, key binary, parent binary, depth long, size long, n long, least long, children long, leaves long, saved long"


def _merged(rows: DataFrame, *firsts: str) -> DataFrame:
    states = [f(c).alias(c) for c, f in _STATE.items()]
    return rows.groupBy("key").agg(*states, *[F.first(c, ignorenulls=True).alias(c) for c in firsts])


def _entered(stretch: DataFrame, below: DataFrame | None) -> DataFrame:
    """One row a distinct path of a stretch: the members that end there and what survived from below its end."""
    zero = F.lit(0).cast("long")
    rows = stretch.select(_end().alias("key"), "top", "path", "sizes", "depth", F.col("ends").cast("long").alias("n"),
                          F.when(F.col("ends"), F.col("conv_id")).alias("least"),
                          zero.alias("children"), zero.alias("leaves"), zero.alias("saved"))
    if below is not None:
        rows = rows.unionByName(below.select("key", *_STATE), allowMissingColumns=True)
    return _merged(rows, "top", "path", "sizes", "depth")


def _peeled_by_depth(entered: DataFrame) -> list[DataFrame]:
    """The nodes of the first stretch, one aggregate and one written table a depth, from the deepest on; the last is the root."""
    entered = materialise(entered)
    longest = entered.agg(F.max(F.length("path"))).first()[0]
    out: list[DataFrame] = []
    survivors = None
    for depth in range(-1 if longest is None else longest // KEY, -1, -1):
        rows = entered.where(F.length("path") == depth * KEY).select("key", *_STATE, "path", "sizes")
        if survivors is not None:
            rows = rows.unionByName(survivors)
        merged = _merged(rows, "path", "sizes")
        parent = F.expr(f"substring(path, {(depth - 2) * KEY + 1}, {KEY})") if depth > 1 else F.lit(ROOT if depth else None).cast("binary")
        size = F.element_at("sizes", -1) if depth else F.lit(0).cast("long")
        merged = merged.withColumn("parent", parent).withColumn("depth", F.lit(depth).cast("long")).withColumn("size", size)
        nodes = materialise(merged.select(
            "key", "parent", "depth", "size", "n", "least", "children",
            F.when(F.col("children") > 0, F.col("leaves")).otherwise(1).cast("long").alias("leaves"),
            (F.col("saved") + (F.col("n") - 1) * F.col("size")).alias("saved"), "path", "sizes"))
        out.append(nodes.select(*_NODE))
        survivors = nodes.select(F.col("parent").alias("key"), "n", "least", F.lit(1).cast("long").alias("children"), "leaves", "saved",
                                 F.expr(f"substring(path, 1, {(depth - 1) * KEY})").alias("path"), F.slice("sizes", 1, max(depth - 1, 0)).alias("sizes"))
    return out


class _Open:
    """A node whose subtree is still being read."""

    __slots__ = ("children", "key", "least", "leaves", "n", "saved", "size")

    def __init__(self, key: bytes, size: int = 0):
        self.key, self.size = key, size
        self.n, self.least, self.children, self.leaves, self.saved = 0, None, 0, 0, 0

    def add(self, n: int, least: int | None, children: int, leaves: int, saved: int) -> None:
        self.n += n
        if least is not None and (self.least is None or least < self.least):
            self.least = least
        self.children += children
        self.leaves += leaves
        self.saved += saved


def _peeled(entered: DataFrame) -> DataFrame:
    """Nodes (``node``) of a deep stretch and, a row for each prefix above it, what survives there."""
    n = shuffle_partitions(entered.sparkSession)
    dealt = entered.repartition(n, "top").sortWithinPartitions("top", "path")
    names = [c.split()[0] for c in _PEELED.split(", ")]

    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out: list[tuple] = []
        open_: list[_Open] = []  # open_[0] stands for the prefix above the stretch
        above = 0

        def strip_to(length: int) -> None:
            while len(open_) > length:
                x = open_.pop()
                if not open_:
                    out.append((False, x.key, None, above, 0, x.n, x.least, x.children, x.leaves, x.saved))
                    return
                if not x.children:
                    x.leaves = 1
                x.saved += (x.n - 1) * x.size
                out.append((True, x.key, open_[-1].key, above + len(open_), x.size, x.n, x.least, x.children, x.leaves, x.saved))
                open_[-1].add(x.n, x.least, 1, x.leaves, x.saved)

        for frame in frames:
            columns = ("top", "path", "sizes", "depth", "n", "children", "leaves", "saved")
            leasts = [None if pd.isna(x) else int(x) for x in frame["least"]]
            for least, top, path, sizes, depth, n, children, leaves, saved in zip(leasts, *(frame[c] for c in columns), strict=True):
                if not open_ or open_[0].key != top:
                    strip_to(0)
                    open_.append(_Open(top))
                    above = depth
                same = 1
                while same < len(open_) and open_[same].key == path[(same - 1) * KEY : same * KEY]:
                    same += 1
                strip_to(same)
                for k in range(same - 1, len(path) // KEY):
                    open_.append(_Open(path[k * KEY : (k + 1) * KEY], int(sizes[k])))
                open_[-1].add(n, least, children, leaves, saved)
                if len(out) >= 5000:
                    yield pd.DataFrame(out, columns=names).astype({"least": "Int64"})
                    out.clear()
        strip_to(0)
        yield pd.DataFrame(out, columns=names).astype({"least": "Int64"})

    return materialise(map_batches(dealt, run, _PEELED))


def _end_digests(found: DataFrame) -> DataFrame:
    """key, ends_sha256: the digest of the ids that end at each node, ascending; streamed, nothing is held."""
    n = shuffle_partitions(found.sparkSession)
    ended = found.where("ends").select(_end().alias("key"), "conv_id")
    dealt = ended.repartition(n, "key").sortWithinPartitions("key", "conv_id")

    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, state = None, None
        for frame in frames:
            out = []
            for k, conv in zip(frame["key"], frame["conv_id"], strict=True):
                if k != key:
                    if state:
                        out.append((key, state.hexdigest()))
                    key, state = k, hashlib.sha256(str(conv).encode())
                else:
                    state.update(b",%d" % conv)
            yield pd.DataFrame(out, columns=["key", "ends_sha256"])
        if state:
            yield pd.DataFrame([(key, state.hexdigest())], columns=["key", "ends_sha256"])

    return map_batches(dealt, run, "key binary, ends_sha256 string")


def nodes(found: DataFrame) -> DataFrame:
    """key, parent, depth, size, n, least, children, leaves, saved of every node of ``found`` (:func:`paths`)."""
    below, out = None, []
    for number in range(found.agg(F.max("stretch")).first()[0] or 0, 0, -1):
        peeled = _peeled(_entered(found.where(F.col("stretch") == number), below))
        out.append(peeled.where("node").select(*_NODE))
        below = peeled.where("NOT node")
    out += _peeled_by_depth(_entered(found.where("stretch = 0"), below))
    empty = found.sparkSession.createDataFrame([], _PEELED).select(*_NODE)
    return reduce(DataFrame.unionByName, out or [empty])


def prefix_trie(conversations: DataFrame, rebuild: bool = False) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256: one row a node.

    ``conversations`` has conv_id, turn, role, text; more columns are left out.  Null roles and texts
    are empty, a null turn comes first, turns that tie go by their digest.  Rows with a null conv_id belong to no
    conversation.  conv_id and depth name a node: its smallest member, and the turns that it takes.
    A table without conversations has no node, not even a root.
    """
    found = paths(conversations, rebuild)
    tree = nodes(found)
    parents = tree.select(F.col("key").alias("parent"), F.col("least").alias("parent_conv_id"))
    whole = tree.join(parents, "parent", "left").join(_end_digests(found), "key", "left")
    return whole.select(
        F.col("least").alias("conv_id"), "depth", "parent_conv_id", F.col("n").alias("n_convs"), F.col("children").alias("n_children"),
        F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"))
