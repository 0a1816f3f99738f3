"""Substring dedup by level-wise doubling of repeated word windows.

Level by level, the windows of one length that occur in two documents or more are found, and
only these are extended to about twice the length, until the asked length is reached or no
candidate is left.  The first level is thinned without loss: of the short windows inside each
long one it looks only at the one with the smallest hash, which two equal long windows share.

Data moves as blocks: the windows of a block of neighbouring documents are made distinct, so
a passage in any number of documents is one entry a block; entries meet by hash range, and
what is repeated goes back to the blocks that asked.  Texts are dealt to blocks once and that
exchange serves every later level.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrapanel.llm.common import (
    WordCodes,
    covered,
    map_batches,
    materialise,
    ship,
    shuffle_partitions,
    whole_text,
    window_codes,
    worker_cache,
)

WINDOW_WORDS = 13
#: Document ids a block spans.
BLOCK_IDS = 1024
_NO_ID = -(2**63)
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_ENTRIES = "bucket int, block long, hashes binary, first binary"
_ANSWERS = "block long, hashes binary, owner binary"


def _codes(text: str) -> tuple[list[bytes], np.ndarray]:
    words = text.encode().split()
    return words, worker_cache("word-codes", WordCodes).codes(words)


def lowest_inside(codes: np.ndarray, length: int, window: int) -> np.ndarray:
    """For each window of ``window`` words the smallest code of a window of ``length`` words inside it."""
    if len(codes) < window:
        return np.empty(0, np.uint64)
    short = window_codes(codes, length)
    n = len(codes) - window + 1
    low = short[:n].copy()
    for j in range(1, window - length + 1):
        np.minimum(low, short[j : j + n], out=low)
    return low


def is_in(values: np.ndarray, ascending: np.ndarray) -> np.ndarray:
    if not len(ascending):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(ascending, values), len(ascending) - 1)
    return ascending[at] == values


def block_entries(block: int, codes: np.ndarray, ids: np.ndarray, buckets: int) -> Iterator[tuple]:
    """Distinct window codes of a block by hash range, each with its first document.

    ``first`` is that document's offset in the block; its top bit says that the block
    holds the window in a second document as well.
    """
    order = np.lexsort((ids, codes))
    codes, ids = codes[order], ids[order]
    head = np.flatnonzero(np.concatenate(([True], codes[1:] != codes[:-1])))
    last = np.concatenate((head[1:], [len(codes)])) - 1
    first = (ids[head] - block * BLOCK_IDS).astype(np.uint16) | ((ids[last] != ids[head]).astype(np.uint16) << np.uint16(15))
    codes = codes[head]
    bucket = ((codes >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    cuts = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1], [True])))
    for a, b in zip(cuts, cuts[1:], strict=False):
        yield int(bucket[a]), block, codes[a:b].tobytes(), first[a:b].tobytes()


def answer(bucket_rows: pd.DataFrame, for_removal: bool) -> pd.DataFrame:
    """Of one hash range: the windows in two documents or more, for each block that holds them.

    For removal the first document goes along, and only blocks with a later document get an answer.
    """
    hashes = [np.frombuffer(x, np.uint64) for x in bucket_rows["hashes"]]
    firsts = [np.frombuffer(x, np.uint16) for x in bucket_rows["first"]]
    blocks = np.repeat(bucket_rows["block"].to_numpy(np.int64), [len(x) for x in hashes])
    codes, first = np.concatenate(hashes), np.concatenate(firsts)
    twice = (first >> np.uint16(15)).astype(bool)
    ids = blocks * BLOCK_IDS + (first & np.uint16(0x7FFF)).astype(np.int64)
    order = np.lexsort((ids, codes))
    codes, ids, blocks, twice = codes[order], ids[order], blocks[order], twice[order]
    head = np.concatenate(([True], codes[1:] != codes[:-1]))
    group = np.cumsum(head) - 1
    owner = ids[head][group]
    later = (ids > owner) | twice
    if for_removal:
        keep = later
    else:
        keep = np.zeros(int(group[-1]) + 1, bool)
        keep[group[later]] = True
        keep = keep[group]
    codes, owner, blocks = codes[keep], owner[keep], blocks[keep]
    order = np.argsort(blocks, kind="stable")
    codes, owner, blocks = codes[order], owner[order], blocks[order]
    cuts = np.flatnonzero(np.concatenate(([True], blocks[1:] != blocks[:-1], [True]))) if len(blocks) else []
    rows = [(int(blocks[a]), codes[a:b].tobytes(), owner[a:b].tobytes() if for_removal else b"")
            for a, b in zip(cuts, cuts[1:], strict=False)]
    return pd.DataFrame(rows, columns=["block", "hashes", "owner"])


def _entries(parts: Iterable[tuple[int, list, list]], buckets: int) -> Iterator[pd.DataFrame]:
    for block, codes, ids in parts:
        sizes = [len(c) for c in codes]
        if sum(sizes):
            rows = block_entries(block, np.concatenate(codes), np.repeat(np.array(ids, np.int64), sizes), buckets)
            yield pd.DataFrame(list(rows), columns=["bucket", "block", "hashes", "first"])


def _first_level(docs: DataFrame, length: int, window: int, buckets: int) -> DataFrame:
    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for block, rows in frame.groupby("block", sort=False):
                codes = [np.unique(lowest_inside(_codes(t)[1], length, window)) for t in rows["text"]]
                yield from _entries([(int(block), codes, rows["doc_id"].tolist())], buckets)

    return map_batches(docs.select("block", "doc_id", "text"), run, _ENTRIES)


def _meet(docs: DataFrame, answers: DataFrame, function: Callable, schema: str) -> DataFrame:
    ship()
    return docs.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(function, schema)


def _told(answers: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    if not len(answers):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    codes = np.concatenate([np.frombuffer(x, np.uint64) for x in answers["hashes"]])
    owner = np.concatenate([np.frombuffer(x, np.int64) for x in answers["owner"]])
    order = np.argsort(codes)
    return codes[order], owner[order] if len(owner) else owner


def _next_level(docs: DataFrame, answers: DataFrame, shorter: int, length: int, thinned: bool, buckets: int) -> DataFrame:
    """Windows of ``length`` words whose shorter windows are all among the repeated ones."""

    def run(texts: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        repeated, _ = _told(told)
        codes, ids = [], []
        if len(repeated):
            for doc_id, text in zip(texts["doc_id"], texts["text"], strict=True):
                words = _codes(text)[1]
                if len(words) < length:
                    continue
                if thinned:
                    alive = is_in(lowest_inside(words, shorter, length), repeated)
                else:
                    short = is_in(window_codes(words, shorter), repeated)
                    n = len(words) - length + 1
                    alive = short[:n] & short[length - shorter : length - shorter + n]
                if alive.any():
                    codes.append(np.unique(window_codes(words, length)[alive]))
                    ids.append(doc_id)
        found = list(_entries([(int(texts["block"].iloc[0]), codes, ids)], buckets)) if len(texts) else []
        return found[0] if found else pd.DataFrame({"bucket": [], "block": [], "hashes": [], "first": []})

    return _meet(docs, answers, run, _ENTRIES)


def _answers(entries: DataFrame, for_removal: bool) -> DataFrame:
    ship()
    return entries.groupBy("bucket").applyInPandas(lambda rows: answer(rows, for_removal), _ANSWERS)


def _prepared(docs: DataFrame, extra: Iterable[str] = ()) -> DataFrame:
    doc_id = F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID))
    block = F.shiftright(doc_id, BLOCK_IDS.bit_length() - 1)  # rounds down, also below zero
    return docs.select(block.alias("block"), doc_id.alias("doc_id"), F.col("doc_id").isNull().alias("none"),
                       whole_text().alias("text"), *extra)


def _repeated(docs: DataFrame, window: int, first: int, for_removal: bool) -> DataFrame:
    """Answers for the windows of ``window`` words that occur in two documents or more.

    Two levels: thinned windows of ``first`` words, and from the repeated ones those of twice
    that length, cut to ``window``.
    """
    buckets = shuffle_partitions(docs.sparkSession)
    entries = _first_level(docs, first, window, buckets)
    entries = _next_level(docs, _answers(entries, False), first, window, True, buckets)
    return _answers(entries, for_removal)


def _kept(text: str, repeated: np.ndarray, owner: np.ndarray, doc_id: int, window: int) -> tuple[list[bytes], np.ndarray | None]:
    """The words of a text and, if some go, the mask of those that do."""
    words = text.encode().split()
    if len(words) >= window and len(repeated):
        codes = window_codes(worker_cache("word-codes", WordCodes).codes(words), window)
        at = np.minimum(np.searchsorted(repeated, codes), len(repeated) - 1)
        starts = np.flatnonzero((repeated[at] == codes) & (owner[at] < doc_id))
        if len(starts):
            return words, covered(starts, window, len(words))
    return words, None


def _without(text: str, gone: np.ndarray) -> str:
    """The text without these words and the white space behind each; the rest as it was."""
    raw = text.encode()
    starts = [m.start() for m in _WORD.finditer(raw)]
    ends = [*starts[1:], len(raw)]
    kept = b"".join(raw[a:b] for a, b, g in zip(starts, ends, gone.tolist(), strict=True) if not g)
    return (raw[: starts[0]] + kept).decode()


def _removal(docs: DataFrame, window: int, extra: list[str], function: Callable, schema: str) -> DataFrame:
    """``function(doc_ids, texts, repeated, owner)`` makes new columns from the texts of a block; ``extra`` go along as they are."""
    import pyarrow as pa

    prepared = _prepared(docs, extra)
    answers = _repeated(prepared, window, -(-window // 2), True)

    def run(block, told):
        repeated, owner = _told(told.to_pandas())
        new = function(block["doc_id"].to_pylist(), block["text"].to_pylist(), repeated, owner)
        columns = {c: block[c] for c in ["doc_id", "none", *extra]} | {c: pa.array(v, t) for c, (v, t) in new.items()}
        return pa.table(columns)

    ship()
    types = ", ".join(f"`{c}` {prepared.schema[c].dataType.simpleString()}" for c in ["doc_id", "none", *extra])
    met = prepared.groupBy("block").cogroup(answers.groupBy("block"))
    return met.applyInArrow(run, f"{types}, {schema}").withColumn("doc_id", F.when(~F.col("none"), F.col("doc_id"))).drop("none")


def remove_repeats(docs: DataFrame, window: int = WINDOW_WORDS) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 (of the kept words joined by one space): one row a row.

    A word goes if it lies in a window of ``window`` words that also starts in a document with a
    smaller doc_id; all windows are judged on the input.  Null texts have no words, texts shorter
    than the window lose nothing, rows with equal doc_ids don't count against each other, and null
    doc_ids come before all others.  Windows are compared by 64-bit codes.

    The doubling ends at ``window``: longer repeats consist of repeated windows, so they
    remove nothing more (see :func:`longest_repeats` for their lengths).
    """
    import pyarrow as pa

    def digest(ids: list, texts: list, repeated: np.ndarray, owner: np.ndarray) -> dict:
        n_words, n_removed, sha = [], [], []
        for doc_id, text in zip(ids, texts, strict=True):
            words, gone = _kept(text, repeated, owner, doc_id, window)
            n_words.append(len(words))
            n_removed.append(0 if gone is None else int(gone.sum()))
            if gone is not None:
                words = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
            sha.append(hashlib.sha256(b" ".join(words)).hexdigest())
        return {"n_words": (n_words, pa.int64()), "n_removed": (n_removed, pa.int64()), "kept_sha256": (sha, pa.string())}

    return _removal(docs, window, [], digest, "n_words long, n_removed long, kept_sha256 string")


def without_repeats(docs: DataFrame, window: int = WINDOW_WORDS) -> DataFrame:
    """The rows of ``docs`` with the words that :func:`remove_repeats` names taken out of ``text``.

    Each removed word goes with the white space behind it; other texts and all other columns stay.
    """
    import pyarrow as pa

    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    named = {f"_c{i}": c for i, c in enumerate(others)}
    renamed = docs.select("doc_id", "text", *[F.col(f"`{c}`").alias(n) for n, c in named.items()])
    renamed = renamed.withColumn("_null", F.col("text").isNull())

    def texts(ids: list, texts: list, repeated: np.ndarray, owner: np.ndarray) -> dict:
        out = []
        for doc_id, text in zip(ids, texts, strict=True):
            _, gone = _kept(text, repeated, owner, doc_id, window)
            out.append(text if gone is None else _without(text, gone))
        return {"kept_text": (out, pa.string())}

    kept = _removal(renamed, window, [*named, "_null"], texts, "kept_text string")
    doc_type = docs.schema["doc_id"].dataType
    of = {c: F.col(n).alias(c) for n, c in named.items()}
    of |= {"doc_id": F.col("doc_id").cast(doc_type), "text": F.when(~F.col("_null"), F.col("kept_text")).alias("text")}
    return kept.select(*[of[c] for c in docs.columns])


def _holders(length: int) -> Callable:
    def run(texts: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        repeated, _ = _told(told)
        held = [(i, length) for i, none, t in zip(texts["doc_id"], texts["none"], texts["text"], strict=True)
                if not none and is_in(window_codes(_codes(t)[1], length), repeated).any()]
        return pd.DataFrame(held, columns=["doc_id", "longest"])

    return run


def longest_repeats(docs: DataFrame, window: int = WINDOW_WORDS) -> DataFrame:
    """doc_id, longest: the greatest of window, 2 window, 4 window, ... that a window shared with another document has.

    Doubles until no candidate survives; one written table a level.  Documents without a shared window are left out.
    """
    prepared = _prepared(docs)
    buckets = shuffle_partitions(docs.sparkSession)
    length, found = window, None
    answers = materialise(_repeated(prepared, window, -(-window // 2), False))
    while answers.limit(1).count():
        here = _meet(prepared, answers, _holders(length), "doc_id long, longest long")
        found = here if found is None else found.unionByName(here)
        entries = _next_level(prepared, answers, length, 2 * length, False, buckets)
        answers = materialise(_answers(entries, False))
        length *= 2
    if found is None:
        return docs.sparkSession.createDataFrame([], "doc_id long, longest long")
    return found.groupBy("doc_id").agg(F.max("longest").alias("longest"))
