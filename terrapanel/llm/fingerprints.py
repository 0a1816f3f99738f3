"""Document fingerprints: every shingle hash below a fixed fraction of the hash range.

The sketch of a text grows with the text, so containment between very unequal documents can be
estimated, and the sketch of a union is the union of the sketches.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrapanel.llm.common import (
    TEXT_BATCH_ROWS,
    WordCodes,
    batches,
    map_batches,
    materialise,
    shingle_codes,
    shuffle_partitions,
    whole_text,
    worker_cache,
)

#: One shingle in so many is kept.
SCALE = 8
_NO_ID = -(2**63)
_NAMES = ["doc_id", "none", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def thin(codes: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """The codes below 2**64 / scale; if there are none, the smallest code alone."""
    kept = codes[codes < np.uint64(2**64 // scale)] if scale > 1 else codes
    return kept if len(kept) or not len(codes) else codes[:1]


def sketch(text: str, scale: int = SCALE) -> np.ndarray:
    """Ascending kept codes of the 5-word shingles of the text, A-Z lowered; empty without words."""
    words = text.encode().lower().split()
    return thin(shingle_codes(worker_cache("word-codes", WordCodes).codes(words)), scale)


def merge(a: np.ndarray, b: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """The sketch of two documents taken together."""
    return thin(np.union1d(a, b), scale)


def containment(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated share of the smaller document's shingles that the other holds; two empty ones are alike."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    return len(np.intersect1d(a, b, assume_unique=True)) / min(len(a), len(b))


def to_text(codes: np.ndarray) -> str:
    return base64.b64encode(codes.astype("<u8").tobytes()).decode()


def from_text(text: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(text), "<u8")


def changes(codes: np.ndarray, other: np.ndarray) -> bytes:
    """``other`` as a bit for each of ``codes`` that it keeps, followed by its own codes."""
    kept = np.isin(codes, other, assume_unique=True)
    return np.packbits(kept).tobytes() + np.setdiff1d(other, codes, assume_unique=True).astype("<u8").tobytes()


def changed(codes: np.ndarray, change: bytes) -> np.ndarray:
    """The codes from which :func:`changes` made ``change``."""
    bits = -(-len(codes) // 8)
    kept = np.unpackbits(np.frombuffer(change[:bits], np.uint8), count=len(codes)).astype(bool)
    return np.sort(np.concatenate((codes[kept], np.frombuffer(change[bits:], "<u8"))))


def fingerprints(docs: DataFrame, columns: list[str], scale: int = SCALE) -> DataFrame:
    """``columns`` and ``fingerprint`` of each row's whole text (null: empty); one pass, no shuffle."""
    kept = [c for c in columns if c != "fingerprint"]
    rows = docs.select(*kept, whole_text().alias("_text"))

    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches(frames, TEXT_BATCH_ROWS):
            yield frame[kept].assign(fingerprint=[to_text(sketch(t, scale)) for t in frame["_text"]])

    types = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in kept)
    return map_batches(rows, run, f"{types}, fingerprint string")


#: The rows as the walk writes them: digests as bytes, the edited text's codes as what they change of its own.
_DRAFT = "doc_id long, none boolean, n_chars long, edited_sha256 binary, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"
_ROW = "doc_id long, none boolean, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"

#: The ends of a range: its first document and its last one.
_RANGE = "first_id long, first_none boolean, first_hash long, first_text string, last_id long, last_none boolean, last_text string"
_ENDS = [c.split()[0] for c in _RANGE.split(", ")]


class _Edits:
    """Draft rows of documents that come in order, each made when the one after it is there."""

    def __init__(self, scale: int):
        self.scale, self.last = scale, None

    def feed(self, doc_id: int, none: bool, text: str) -> tuple | None:
        own = sketch(text, self.scale)
        done = None
        if self.last is not None:
            i, was_none, before, codes = self.last
            k = len(before) // 3
            edited = before[: len(before) - k] + text[:k]
            other = sketch(edited, self.scale)
            done = (i, was_none, len(before), hashlib.sha256(edited.encode()).digest(), codes.astype("<u8").tobytes(), changes(codes, other),
                    containment(codes, other), containment(codes, own))
        self.last = doc_id, none, text, own
        return done


def _spelled_out(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Result rows of draft rows."""
    for frame in frames:
        own = [np.frombuffer(x, "<u8") for x in frame["fingerprint"]]
        other = [to_text(changed(codes, x)) for codes, x in zip(own, frame["edited_fingerprint"], strict=True)]
        yield frame.assign(edited_sha256=[x.hex() for x in frame["edited_sha256"]], fingerprint=list(map(to_text, own)),
                           edited_fingerprint=other)


def with_edited(docs: DataFrame, scale: int = SCALE) -> DataFrame:
    """Fingerprint of each text and of its edited form, with likenesses; one row a row.

    Edited: the last third of the code points gives way to the start of the next document's text, in
    descending doc_id order, the first after the last.  Rows that repeat a doc_id follow each other in
    the order of their texts' hashes, null doc_ids come last, a single row follows itself.

    Texts move once, into ranges of doc_ids that are walked in order with one document in hand.  The
    walk gives a row a document, and one a range with its first and its last document; only these meet again.
    All of it comes from one job that is written, so that no second sampling of ranges can disagree with it; what is
    written is short (bytes, and of the edited text's fingerprint only what differs) and spelled out when it is read.
    """
    n = shuffle_partitions(docs.sparkSession)
    text = whole_text()
    ranged = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("id"), F.col("doc_id").isNull().alias("none"),
        F.xxhash64(text).alias("hash"), text.alias("text"))
    order = [F.col("id").desc(), F.col("none").asc(), F.col("hash").asc()]
    ranged = ranged.repartitionByRange(n, *order).sortWithinPartitions(*order)

    def walk(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        edits, first, last = _Edits(scale), None, None
        for frame in batches(frames, TEXT_BATCH_ROWS):
            rows = []
            for i, none, key, t in zip(frame["id"], frame["none"], frame["hash"], frame["text"], strict=True):
                first, last = first or (i, none, key, t), (i, none, t)
                rows.append(edits.feed(i, none, t))
            yield pd.DataFrame([r for r in rows if r], columns=_NAMES).assign(**dict.fromkeys(_ENDS))
        if first:
            ends = dict(zip(_ENDS, (*first, *last), strict=True))
            yield pd.DataFrame([ends]).assign(**dict.fromkeys(_NAMES))

    walked = materialise(map_batches(ranged, walk, f"{_DRAFT}, {_RANGE}"))
    inside = walked.where("first_id IS NULL").select(*_NAMES)
    ends = walked.where("first_id IS NOT NULL").select(*_ENDS)
    parts = Window.orderBy(F.col("first_id").desc(), F.col("first_none").asc(), F.col("first_hash").asc())  # one row a range
    everywhere = parts.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    following = F.coalesce(F.lead("first_text").over(parts), F.first("first_text").over(everywhere))
    tails = ends.select("last_id", "last_none", "last_text", following.alias("next_text"))

    def close(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for i, none, own, following in zip(frame["last_id"], frame["last_none"], frame["last_text"], frame["next_text"], strict=True):
                edits = _Edits(scale)
                edits.feed(i, none, own)
                out.append(edits.feed(0, False, following))
            yield pd.DataFrame(out, columns=_NAMES)

    done = map_batches(inside.unionByName(map_batches(tails, close, _DRAFT)), _spelled_out, _ROW)
    return done.withColumn("doc_id", F.when(~F.col("none"), F.col("doc_id"))).drop("none")
