"""Quality rules with the line frequency of a host's documents.

Lines are normalised and hashed; a line that too many distinct documents of one host hold is
removed, and a document that loses too much of itself that way is rejected.  Base statistics
of each text come from the same single pass over the texts.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrapanel.llm.common import (
    TEXT_BATCH_ROWS,
    batches,
    covered,
    exact_windows,
    map_batches,
    materialise,
    row_id,
    whole_text,
)

WORD_SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
REPEAT_WORDS = 5
#: A line is common when it is in more documents of a host than both of these.
MIN_DOCUMENTS = 10
MAX_SHARE = 0.01
#: A document is depleted when less than this share of its words is left.
MIN_LEFT_PERCENT = 50
_SALTS = 16
_DIGITS = re.compile(r"[0-9]+")


def normalised_line(line: str) -> str:
    """Lower case, white space as one space, digit runs as 0; empty for a line without words."""
    return _DIGITS.sub("0", " ".join(line.lower().split()))


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a 5-word window found twice or more in the text."""
    if len(words) <= REPEAT_WORDS:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    if len(number) == len(words):
        return 0
    _, inverse, counts = np.unique(exact_windows(ids, REPEAT_WORDS), return_inverse=True, return_counts=True)
    starts = np.flatnonzero(counts[inverse] > 1)
    return int(covered(starts, REPEAT_WORDS, len(words)).sum()) if len(starts) else 0


def base_statistics(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of one text."""
    words = text.encode().split()
    chars = len(text) - sum(map(text.count, WORD_SPACE))
    lines = [x for x in text.split("\n") if x.strip(WORD_SPACE)]
    return len(words), chars, sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeated_words(words)


def line_words(text: str) -> dict[int, int]:
    """Signed 64-bit hash of each distinct normalised line -> its words, all occurrences together."""
    import xxhash

    found: dict[int, int] = {}
    for line in text.split("\n"):
        n = len(line.encode().split())
        if n:
            h = xxhash.xxh3_64_intdigest(normalised_line(line))
            h -= (h >> 63) << 64
            found[h] = found.get(h, 0) + n
    return found


def text_statistics(docs: DataFrame, host: str = "source") -> DataFrame:
    """One pass over the texts: base statistics and the hashes of the lines, written to the shared folder."""
    rows = docs.select("doc_id", F.coalesce(F.col(host).cast("string"), F.lit("")).alias("host"), whole_text().alias("text"))

    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches(frames, TEXT_BATCH_ROWS):
            out = pd.DataFrame(
                [base_statistics(t) for t in frame["text"]],
                columns=["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"], index=frame.index)
            lines = [line_words(t) for t in frame["text"]]
            out["line"] = [list(x) for x in lines]
            out["line_words"] = [list(x.values()) for x in lines]
            yield pd.concat([frame[["doc_id", "host"]], out], axis=1)

    doc_id = rows.schema["doc_id"].dataType.simpleString()
    schema = (f"doc_id {doc_id}, host string, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
              "n_repeat_words long, line array<long>, line_words array<long>")
    return materialise(row_id(map_batches(rows, run, schema), "row"))


def common_lines(statistics: DataFrame, min_documents: int = MIN_DOCUMENTS, max_share: float = MAX_SHARE) -> DataFrame:
    """host, line of the lines in more than min_documents and more than max_share of a host's distinct documents.

    Counts are exact and pre-aggregated before each shuffle, so a line of any number of documents is a
    row from each task.
    """
    lines = statistics.select("host", "doc_id", F.explode("line").alias("line"))
    held = lines.groupBy("host", "line").agg(F.count_distinct("doc_id").alias("in_documents"))
    hosts = statistics.groupBy("host").agg(F.count_distinct("doc_id").alias("host_documents"))
    often = held.where(F.col("in_documents") > min_documents)
    return often.join(hosts, "host").where(F.col("in_documents") > max_share * F.col("host_documents")).select("host", "line")


def removed_words(statistics: DataFrame, common: DataFrame) -> DataFrame:
    """row, n_lines_removed, n_words_removed of the documents that hold common lines.

    The key of a very common line is salted: each common line is there once for every salt.
    """
    salt = F.pmod(F.col("row"), F.lit(_SALTS)).cast("int")
    lines = statistics.select("row", "host", salt.alias("salt"), F.explode(F.arrays_zip("line", "line_words")).alias("x"))
    lines = lines.select("row", "host", "salt", F.col("x.line").alias("line"), F.col("x.line_words").alias("n"))
    salted = common.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))
    return (lines.join(salted, ["host", "line", "salt"]).groupBy("row")
            .agg(F.count("*").alias("n_lines_removed"), F.sum("n").alias("n_words_removed")))


def quality(docs: DataFrame, host: str = "source", min_documents: int = MIN_DOCUMENTS, max_share: float = MAX_SHARE,
            min_left_percent: int = MIN_LEFT_PERCENT) -> DataFrame:
    """doc_id, the base statistics, base_failed, kept, n_lines_removed, n_words_removed: one row a row.

    ``kept``: the base rules hold and at least ``min_left_percent`` of the words are outside
    the host's common lines.  Null texts are empty and fail the base rules, a null host is a host
    of its own, repeated rows of one doc_id count as one document.
    """
    stats = text_statistics(docs, host)
    removed = removed_words(stats, common_lines(stats, min_documents, max_share))
    joined = stats.drop("line", "line_words", "host").join(removed, "row", "left").fillna(0, ["n_lines_removed", "n_words_removed"])
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    left = 100 * (F.col("n_words") - F.col("n_words_removed")) >= min_left_percent * F.col("n_words")
    return joined.withColumn("base_failed", failed).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & left).alias("kept"), "n_lines_removed", "n_words_removed")


def without_common_lines(docs: DataFrame, host: str = "source", **limits) -> DataFrame:
    """The documents with their common lines taken out of ``text``; null texts stay null.

    Matches by (doc_id, text hash), so all rows of one document get the same text.
    """
    stats = text_statistics(docs, host)
    lines = stats.select("doc_id", "host", F.explode("line").alias("line"))
    gone = lines.join(common_lines(stats, **limits), ["host", "line"]).groupBy("doc_id", "host").agg(F.collect_set("line").alias("_gone"))
    keyed = docs.withColumn("_host", F.coalesce(F.col(host).cast("string"), F.lit("")))
    gone = gone.select(F.col("doc_id").alias("_id"), F.col("host").alias("_of"), "_gone")
    joined = keyed.join(gone, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_host") == F.col("_of")), "left")
    schema = docs.schema

    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import xxhash

        def signed(line: str) -> int:
            h = xxhash.xxh3_64_intdigest(normalised_line(line))
            return h - ((h >> 63) << 64)

        for frame in frames:
            texts = []
            for text, gone_lines in zip(frame["text"], frame["_gone"], strict=True):
                if text is not None and gone_lines is not None and len(gone_lines):
                    out = set(gone_lines)
                    text = "\n".join(x for x in text.split("\n") if not x.encode().split() or signed(x) not in out)
                texts.append(text)
            frame["text"] = texts
            yield frame[[f.name for f in schema]]

    return map_batches(joined.drop("_id", "_of", "_host"), run, schema)
