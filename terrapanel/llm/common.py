"""Helpers shared by the corpus operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrapanel.session import checkpoint_dir

#: Words of every contract: runs of anything but space and \t \n \v \f \r.
#: ``bytes.split()`` cuts at exactly these six bytes.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"

#: Shingle length and similarity of the near-duplicate operators.
SHINGLE_WORDS = 5
SIMILARITY_PERCENT = 75

#: Arrow batches of texts stay small: a batch holds whole texts.
TEXT_BATCH_ROWS = 500


#: Rows an Arrow batch brings to Python at most; Spark's own bound is 10,000.
ARROW_BATCH_ROWS = 2000


def short_batches(spark: SparkSession) -> None:
    """Lower the session's bound on the rows of an Arrow batch to ``ARROW_BATCH_ROWS``; a lower one stays.

    A batch of texts is held several times at once, by the executor and by its worker.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= ARROW_BATCH_ROWS:
        spark.conf.set(name, str(ARROW_BATCH_ROWS))


def ship() -> None:
    """Pickle this package by value, so that workers need not be able to import it."""
    import terrapanel

    cloudpickle.register_pickle_by_value(terrapanel)


def map_batches(df: DataFrame, function: Callable, schema: str) -> DataFrame:
    """``mapInPandas`` with the package's code shipped inside the function, over batches of bounded length."""
    ship()
    short_batches(df.sparkSession)
    return df.mapInPandas(function, schema)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back.

    Cuts the lineage like ``checkpoint()``, in compressed columns: a lost
    executor costs a re-read, not a recomputation.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def row_id(df: DataFrame, name: str) -> DataFrame:
    """Give each row its own number; call :func:`materialise` before relying on it twice."""
    return df.withColumn(name, F.monotonically_increasing_id())


def whole_text(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


class WordCodes(dict):
    """word (bytes) -> 64-bit code; the same word has the same code in every task.

    A bounded cache: ``codes`` empties it when it has grown past ``limit``
    words, so its memory does not grow with the corpus.
    """

    def __init__(self, limit: int = 400_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        import xxhash

        code = self[word] = xxhash.xxh3_64_intdigest(word)
        return code

    def codes(self, words: list[bytes]) -> np.ndarray:
        if len(self) > self.limit:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(values: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (published splitmix64 constants), element by element."""
    with np.errstate(over="ignore"):
        z = values.astype(np.uint64, copy=True)
        z ^= z >> np.uint64(30)
        z *= np.uint64(0xBF58476D1CE4E5B9)
        z ^= z >> np.uint64(27)
        z *= np.uint64(0x94D049BB133111EB)
        z ^= z >> np.uint64(31)
    return z


_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def window_codes(codes: np.ndarray, length: int) -> np.ndarray:
    """64-bit code of every run of ``length`` consecutive word codes."""
    n = len(codes) - length + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = codes[:n].copy()
    for j in range(1, length):
        out *= _FACTOR
        out += codes[j : j + n]
    return mix(out)


def shingle_codes(codes: np.ndarray, length: int = SHINGLE_WORDS) -> np.ndarray:
    """Distinct shingle codes, ascending; a shorter text is one shingle, an empty one has none."""
    if len(codes) == 0:
        return np.empty(0, np.uint64)
    return np.unique(window_codes(codes, min(length, len(codes))))


def exact_windows(ids: np.ndarray, length: int) -> np.ndarray:
    """Exact labels of windows: equal labels if and only if the words are equal.

    ``ids`` are small word numbers of one text.  Pairs are renumbered after
    each joined word, so nothing overflows and nothing collides.
    """
    n = len(ids) - length + 1
    if n <= 0:
        return np.empty(0, np.int64)
    size = int(ids.max()) + 1
    label = ids[:n].astype(np.int64)
    span = size
    for j in range(1, length):
        if span * size >= 2**62:
            label = np.unique(label, return_inverse=True)[1].astype(np.int64)
            span = int(label.max()) + 1
        label = label * size + ids[j : j + n]
        span *= size
    return label


def covered(starts: np.ndarray, length: int, n: int) -> np.ndarray:
    """Mask of the positions in [0, n) that a window starting in ``starts`` covers."""
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, starts, 1)
    np.add.at(step, np.minimum(starts + length, n), -1)
    return np.cumsum(step[:n]) > 0


def batches(frames: Iterable, size: int) -> Iterator:
    """Cut pandas frames into frames of at most ``size`` rows."""
    for frame in frames:
        for at in range(0, len(frame), size):
            yield frame.iloc[at : at + size]


def worker_cache(key: str, build: Callable):
    """Keep what ``build`` returns for the later tasks of this Python worker.

    Functions arrive by value, so their module globals are new in every task; the interpreter's
    ``sys`` module outlives them.  Only tables of a fixed size belong here.
    """
    import sys

    kept = sys.__dict__.setdefault("_terrapanel_worker_cache", {})
    if key not in kept:
        kept[key] = build()
    return kept[key]
