"""Best-fit packing of token sequences in bulk-synchronous rounds.

Each round range-sorts the unplaced pieces and the open gaps together by size and sweeps every
range on its own: a piece waits on a stack, a gap takes the largest waiting piece, which makes
the gap the piece's successor, and goes on while the next one fits.  What stays over in a range is
matched between ranges by rank: one count of waiting pieces and untouched gaps a range decides it.
Then gaps are updated and the next round begins.

Long pieces go first: halving bands of length down to an eighth of the capacity, each until
it is placed.  A round opens as many new sequences as the band's tokens need beyond the gaps.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrapanel.llm.bpe import SPLIT_PATTERN, Encoder, MergeTable
from terrapanel.llm.common import TEXT_BATCH_ROWS, batches, map_batches, materialise, row_id, whole_text, worker_cache

CAPACITY = 2048
BANDS = (2, 4, 8)
#: Pieces and gaps that one task sweeps.
RANGE_ROWS = 200_000
_STATE = "part int, piece boolean, id long, size int, bin long, offset int, left int, rank long"


def token_ids(tokenizer: str) -> Callable[[str], np.ndarray]:
    """Encoder of texts by the vocabulary of a byte-level tokenizer file's JSON; special tokens are read as such."""
    import tiktoken

    table = MergeTable(tokenizer)
    plain = {t: i for i, t in enumerate(table.token) if t and i not in set(table.special.values())}
    fast = tiktoken.Encoding("vocabulary", pat_str=SPLIT_PATTERN, mergeable_ranks=plain, special_tokens=table.special)

    def encode(text: str) -> np.ndarray:
        try:
            return fast.encode_to_numpy(text, allowed_special="all").astype("<u4", copy=False)
        except BaseException:  # noqa: BLE001 - its pattern engine gives up on some very long runs
            encoder = Encoder(table)
            return np.array(list(encoder.feed(text)) + list(encoder.finish()), "<u4")

    return encode


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens: all full but the first."""
    first = n % capacity or min(n, capacity)
    return [(0, first)] + [(at, capacity) for at in range(first, n, capacity)]


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """item, doc_id, piece, start, length, ids_crc32 of each text's tokens and a closing 0; written to the shared folder.

    The vocabulary file is read on the driver and broadcast (a few MB, whatever the corpus).
    """
    with open(tokenizer_path, encoding="utf-8") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())
    rows = docs.select("doc_id", whole_text().alias("_text"))

    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = worker_cache(f"ids-{zlib.crc32(shared.value.encode())}", lambda: token_ids(shared.value))
        for frame in batches(frames, TEXT_BATCH_ROWS):
            out = []
            at = []
            for k, text in enumerate(frame["_text"]):
                ids = np.append(encode(text), np.uint32(0)).astype("<u4", copy=False)
                for piece, (start, n) in enumerate(cut(len(ids), capacity)):
                    out.append((piece, start, n, zlib.crc32(ids[start : start + n].tobytes())))
                    at.append(k)
            found = pd.DataFrame(out, columns=["piece", "start", "length", "ids_crc32"])
            found.insert(0, "doc_id", frame["doc_id"].take(at).reset_index(drop=True))
            yield found

    doc_id = rows.schema["doc_id"].dataType.simpleString()
    cuts = map_batches(rows, run, f"doc_id {doc_id}, piece int, start long, length long, ids_crc32 long")
    return materialise(row_id(cuts, "item"))


def sweep(rows: pd.DataFrame, capacity: int) -> pd.DataFrame:
    """One range: match waiting pieces and gaps in order of size, pieces before gaps of the same size.

    Pieces that wait on have a rank from the smallest up, gaps that nothing waited for one from the
    smallest up; both are matched between ranges afterwards.
    """
    rows = rows.sort_values(["size", "piece", "id"], ascending=[True, False, True], kind="stable", ignore_index=True)
    size, is_piece, ids = rows["size"].tolist(), rows["piece"].tolist(), rows["id"].tolist()
    n = len(rows)
    bins, offset, left, rank = [None] * n, [None] * n, [None] * n, [None] * n
    waiting: list[int] = []
    untouched = 0
    for k in range(n):
        if is_piece[k]:
            waiting.append(k)
        elif not waiting:
            rank[k] = untouched
            untouched += 1
        else:
            gap = size[k]
            while waiting and size[waiting[-1]] <= gap:
                j = waiting.pop()
                bins[j], offset[j] = ids[k], capacity - gap
                gap -= size[j]
            left[k] = gap
    for r, k in enumerate(waiting):
        rank[k] = r
    new = {"bin": (bins, "Int64"), "offset": (offset, "Int32"), "left": (left, "Int32"), "rank": (rank, "Int64")}
    return rows.assign(**{c: pd.array(v, t) for c, (v, t) in new.items()})


def between_ranges(ranges: list[tuple[int, int, int]]) -> tuple[list[tuple], dict[int, int], dict[int, int]]:
    """Match what the ranges have left; ``ranges``: (part, waiting pieces, untouched gaps) in order of size.

    Returns runs (run, piece part, piece ranks from, to, gap part, gap ranks from, to), and by part
    how many pieces still wait and how many gaps were taken.  The gaps of a range stand before its pieces.
    """
    runs, stack, taken = [], [], {}
    for part, waiting, untouched in sorted(ranges):
        used = 0
        while used < untouched and stack:
            source, top = stack.pop()
            n = min(top, untouched - used)
            runs.append((len(runs), source, top - n, top, part, used, used + n))
            used += n
            if top > n:
                stack.append((source, top - n))
        taken[part] = used
        if waiting:
            stack.append((part, waiting))
    return runs, dict(stack), taken


def _round(spark: SparkSession, pool: DataFrame, rows: int, capacity: int, range_rows: int):
    """One round over ``pool`` (piece, id, size): placements, pieces still waiting, gaps."""
    ranges = -(-rows // range_rows)
    dealt = pool.repartitionByRange(ranges, "size", F.col("piece").desc(), "id") if ranges > 1 else pool.repartition(1)

    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = list(frames)
        if held:
            yield sweep(pd.concat(held, ignore_index=True), capacity)

    part = F.spark_partition_id().alias("part")
    state = materialise(map_batches(dealt.select(part, "piece", "id", F.col("size").cast("int").alias("size")), run, _STATE))
    waiting, untouched = state.where("piece and bin is null"), state.where("not piece and left is null")
    placed = state.where("piece and bin is not null").select(F.col("id").alias("item"), F.col("bin").alias("sequence_id"), "offset")
    gaps = state.where("left > 0").select("id", F.col("left").alias("size"))
    if ranges > 1:
        counts = state.where("rank is not null").groupBy("part").agg(
            F.count_if("piece").alias("waiting"), F.count_if(~F.col("piece")).alias("untouched")).collect()  # a row a range
        runs, still, taken = between_ranges([tuple(r) for r in counts])
        if runs:
            # At most two rows for each range.
            table = F.broadcast(spark.createDataFrame(
                runs, "run long, p_part int, p_from long, p_to long, g_part int, g_from long, g_to long"))
            some = waiting.join(table, (F.col("part") == F.col("p_part")) & (F.col("rank") >= F.col("p_from")) & (F.col("rank") < F.col("p_to")))
            some = some.select("run", (F.col("p_to") - 1 - F.col("rank")).alias("nth"), F.col("id").alias("item"), F.col("size").alias("length"))
            open_ = untouched.join(table, (F.col("part") == F.col("g_part")) & (F.col("rank") >= F.col("g_from")) & (F.col("rank") < F.col("g_to")))
            open_ = open_.select("run", (F.col("rank") - F.col("g_from")).alias("nth"), F.col("id").alias("sequence_id"), F.col("size").alias("gap"))
            pairs = materialise(some.join(open_, ["run", "nth"]).select(
                "item", "sequence_id", (F.lit(capacity) - F.col("gap")).cast("int").alias("offset"), (F.col("gap") - F.col("length")).alias("size")))
            placed = placed.unionByName(pairs.select("item", "sequence_id", "offset"))
            gaps = gaps.unionByName(pairs.where("size > 0").select(F.col("sequence_id").alias("id"), "size"))
            rest = F.broadcast(spark.createDataFrame(
                [(p, still.get(p, 0), taken.get(p, 0)) for p in {*still, *taken}], "part int, still long, taken long"))
            waiting = waiting.join(rest, "part").where("rank < still")
            untouched = untouched.join(rest, "part").where("rank >= taken")
    # A new sequence that nothing went into was not needed.
    gaps = gaps.unionByName(untouched.where(F.col("size") < capacity).select("id", "size"))
    return placed, waiting.select("id", "size"), gaps


def _histogram(waiting: DataFrame, gaps: DataFrame) -> tuple[dict[int, int], dict[int, int]]:
    """Number of pieces and of gaps of each size: at most one row each for a size up to the capacity."""
    both = waiting.select(F.lit(True).alias("piece"), "size").unionByName(gaps.select(F.lit(False).alias("piece"), "size"))
    rows = both.groupBy("piece", "size").agg(F.count("*").alias("n")).collect()
    return ({r["size"]: r["n"] for r in rows if r["piece"]}, {r["size"]: r["n"] for r in rows if not r["piece"]})


def place(items: DataFrame, capacity: int = CAPACITY, range_rows: int = RANGE_ROWS) -> DataFrame:
    """item, sequence_id, offset for ``items`` (item, length from 1 to the capacity).

    Pieces over half the capacity open a sequence each, as no two of them share one.  Every round
    places at least one piece, and a round of a band opens no more sequences than its tokens need.
    """
    spark = items.sparkSession
    alone = items.where(F.col("length") > capacity // BANDS[0])
    placed = [alone.select("item", F.col("item").alias("sequence_id"), F.lit(0).alias("offset"))]
    gaps = alone.where(F.col("length") < capacity).select(F.col("item").alias("id"), (capacity - F.col("length")).cast("int").alias("size"))
    opened = 0
    edges = [capacity // b for b in BANDS] + [0]
    for high, low in zip(edges, edges[1:], strict=False):
        band = items.where((F.col("length") <= high) & (F.col("length") > low))
        waiting = band.select(F.col("item").alias("id"), F.col("length").cast("int").alias("size"))
        sizes, open_ = _histogram(waiting, gaps)
        while sizes:
            smallest = min(sizes)
            room = sum(g * n for g, n in open_.items() if g >= smallest)
            need = -(-(sum(s * n for s, n in sizes.items()) - room) // capacity)
            new = max(need, 0 if room else 1)
            fresh = spark.range(opened + 1, opened + 1 + new).select((-F.col("id")).alias("id"), F.lit(capacity).alias("size"))
            opened += new
            pool = waiting.select(F.lit(True).alias("piece"), "id", "size").unionByName(
                gaps.unionByName(fresh).select(F.lit(False).alias("piece"), "id", "size"))
            rows = sum(sizes.values()) + sum(open_.values()) + new
            done, waiting, gaps = _round(spark, pool, rows, capacity, range_rows)
            placed.append(done)
            sizes, open_ = _histogram(waiting, gaps)
    out = placed[0]
    for more in placed[1:]:
        out = out.unionByName(more)
    return out


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, range_rows: int = RANGE_ROWS) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: one row a piece.

    Null texts are empty and have the closing token alone; repeated rows are packed each; null
    doc_ids stay null.  An empty input gives an empty output.
    """
    cuts = pieces(docs, tokenizer_path, capacity)
    placed = place(cuts.select("item", "length"), capacity, range_rows)
    return cuts.join(placed, "item").select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", F.col("offset").cast("long").alias("offset"))
