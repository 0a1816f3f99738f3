"""Language identification by levels: the family first, then one-versus-one linear SVMs within it.

Both levels use linear support vector machines over hashed character n-grams, fitted by
Spark ML on a bounded sample of labelled documents.  Prediction is one pass over whole texts.
How alike a text is to the language told is measured apart from the votes, by its cross-entropy.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import cached_property
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrapanel.llm.common import TEXT_BATCH_ROWS, batches, map_batches, materialise, mix, worker_cache

#: Families of ISO 639-1 codes.  A code outside the table is a family of its own.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca"),
    "slavic": ("pl", "cs", "ru", "uk", "bg", "sk"),
}
UNDETERMINED = "und"
DIMENSIONS = 2048
#: Labelled documents used for fitting, for each language, on average over the hash draw.
SAMPLE_PER_LANGUAGE = 500
#: Weight of even shares in a language's profile, and how steeply the likeness falls around one half.
EVEN, STEEPNESS = 0.1, 20
#: Documents below this score are rejected.  Votes alone hardly ever lie below; texts unlike the language told do.
MIN_SCORE = 0.25
#: Standard errors, for its number of letters, by which a text may fall short of the labelled texts' mean and still
#: reach MIN_SCORE.  Of labelled texts cut to 10 to 40 signs under one in a thousand falls shorter.
DEVIATIONS = 4


def family_of(lang: str) -> str:
    return next((name for name, langs in FAMILIES.items() if lang in langs), lang)


def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def features(text: str) -> np.ndarray | None:
    """Square roots of the shares of hashed 1- to 3-letter runs; None without letters.

    Anything but letters counts as one space.  The vector has length 1 for a text of any size.
    """
    return measured(text)[0]


def measured(text: str) -> tuple[np.ndarray | None, int]:
    """:func:`features` and the number of letters."""
    if not text:
        return None, 0
    letters = worker_cache("letters", _letters)
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = np.where(letters[codes], codes, np.uint32(32))
    codes = np.concatenate(([np.uint32(32)], codes, [np.uint32(32)]))
    keep = np.ones(len(codes), bool)
    keep[1:] = (codes[1:] != 32) | (codes[:-1] != 32)
    c = codes[keep].astype(np.uint64)
    if len(c) < 3:
        return None, 0
    pairs = (c[:-1] << np.uint64(21)) | c[1:]
    triples = (pairs[:-1] << np.uint64(21)) | c[2:]
    one = c[c != 32]
    slots = np.concatenate([mix(x + np.uint64(k)) for k, x in ((1, one), (1 << 62, pairs), (1 << 63, triples))])
    counts = np.bincount((slots & np.uint64(DIMENSIONS - 1)).astype(np.int64), minlength=DIMENSIONS)
    return np.sqrt(counts / counts.sum()), len(one)


@dataclass(frozen=True)
class Separator:
    """One binary SVM: positive margin for ``a``, negative for ``b``."""

    a: str
    b: str
    weights: np.ndarray
    intercept: float

    def margin(self, x: np.ndarray) -> float:
        return float(x @ self.weights) + self.intercept


@dataclass(frozen=True)
class Profile:
    """Mean shares of a language's labelled texts, smoothed, as logarithms, and their own mean cross-entropy."""

    logs: np.ndarray
    own: float

    @staticmethod
    def of(shares: np.ndarray) -> Profile:
        logs = np.log((shares + EVEN / DIMENSIONS) / (1 + EVEN))
        return Profile(logs, -float(shares @ logs))

    @cached_property
    def spread(self) -> float:
        """Standard deviation of one run's logarithm under the profile."""
        shares = np.exp(self.logs)
        mean = shares @ self.logs / shares.sum()
        return float(np.sqrt(shares @ (self.logs - mean) ** 2 / shares.sum()))

    def likeness(self, x: np.ndarray, letters: int | None = None) -> float:
        """Near 1 for a cross-entropy as the labelled texts have it, near 0 for that of even shares, 0.5 halfway.

        A text of few letters has a wide spread: with ``letters`` given it counts as alike up to ``DEVIATIONS``
        standard errors under the labelled texts' mean, as long as it is nearer to them than even shares
        are.  The runs of a letter overlap, so letters are counted, not runs.
        """
        none = np.log(DIMENSIONS)
        span = max(none - self.own, 1e-9)
        part = (none + float((x * x) @ self.logs)) / span
        if letters and part > 0:
            enough = 0.5 + np.log(MIN_SCORE / (1 - MIN_SCORE)) / STEEPNESS
            part = max(part, enough + part - 1 + DEVIATIONS * self.spread / np.sqrt(letters) / span)
        return float(1 / (1 + np.exp(-STEEPNESS * np.clip(part - 0.5, -1, 1))))


@dataclass(frozen=True)
class Model:
    """Separators between families, and between the languages of each family; profiles by language."""

    langs: dict
    between: list
    within: dict
    profiles: dict = field(default_factory=dict)

    @staticmethod
    def vote(x: np.ndarray, names: list[str], separators: list[Separator]) -> tuple[str, float]:
        """The name with most pairwise wins (ties: larger margins, then the name), and a score."""
        if len(names) == 1:
            return names[0], 1.0
        wins, sums = dict.fromkeys(names, 0), dict.fromkeys(names, 0.0)
        margins = []
        for s in separators:
            m = s.margin(x)
            wins[s.a if m > 0 else s.b] += 1
            sums[s.a] += m
            sums[s.b] -= m
            margins.append((s, m))
        best = max(names, key=lambda n: (wins[n], sums[n], n))
        own = [m if s.a == best else -m for s, m in margins if best in (s.a, s.b)]
        return best, float(1 / (1 + np.exp(-2 * np.clip(min(own), -30, 30))))

    def predict(self, x: np.ndarray | None, letters: int | None = None) -> tuple[str, float]:
        if x is None or not self.langs:
            return UNDETERMINED, 0.0
        family, sure = self.vote(x, sorted(self.langs), self.between)
        lang, within = self.vote(x, self.langs[family], self.within[family])
        likeness = self.profiles[lang].likeness(x, letters) if lang in self.profiles else 1.0
        return lang, min(sure * within, likeness)


def _separators(rows: DataFrame, label: str, names: list[str]) -> list[Separator]:
    from pyspark.ml.classification import LinearSVC

    found = []
    for a, b in combinations(names, 2):
        pair = rows.where(F.col(label).isin(a, b)).select((F.col(label) == a).cast("double").alias("label"), "features")
        fitted = LinearSVC(maxIter=40, tol=1e-4, regParam=1e-4, standardization=False).fit(pair)
        found.append(Separator(a, b, fitted.coefficients.toArray(), float(fitted.intercept)))
    return found


def _profiles(drawn: DataFrame) -> dict[str, Profile]:
    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.stat import Summarizer

    shares = drawn.select("lang", array_to_vector(F.transform("x", lambda v: v * v)).alias("shares"))
    means = shares.groupBy("lang").agg(Summarizer.mean(F.col("shares")).alias("mean")).collect()  # a row a language
    return {r["lang"]: Profile.of(r["mean"].toArray()) for r in means}


def fit(labelled: DataFrame, sample_per_language: int = SAMPLE_PER_LANGUAGE) -> Model:
    """Fit both levels on text and lang of ``labelled`` rows with neither null.

    The sample is drawn by the texts' hashes, at a rate that gives ``sample_per_language`` rows of each
    language on average whatever the input size and its files; whole texts are used.  No labelled rows give a model that answers ``und``.
    """
    from pyspark.ml.functions import array_to_vector

    rows = labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text")
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # a row a language
    if not counts:
        return Model({}, [], {})
    rate = F.create_map(*[F.lit(x) for k, n in sorted(counts.items()) for x in (k, min(1.0, sample_per_language / n))])
    # A text with n rows is drawn n times the rate often, rounded by its hash: neither the layout of the
    # table nor copies that all share one hash decide.
    keyed = rows.select("lang", F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(1), "text").alias("h2"), "text")
    rated = keyed.groupBy("lang", "h1", "h2").agg(F.count("*").alias("n")).withColumn("often", F.col("n") * rate[F.col("lang")])
    part = F.pmod("h1", F.lit(1_000_000)) / 1_000_000
    wanted = rated.withColumn("often", (F.floor("often") + (part < F.col("often") - F.floor("often")).cast("long"))).where("often > 0")
    # About sample_per_language texts of a language: counted, so that rows of one text meet their draw where they are read
    # and are merged there.
    wanted = materialise(wanted.drop("n"))
    small = wanted.count() <= 4 * sample_per_language * len(counts)
    sample = keyed.join(F.broadcast(wanted) if small else wanted, ["lang", "h1", "h2"]).groupBy("lang", "h1", "h2").agg(F.first("text").alias("text"), F.first("often").alias("often"))

    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches(frames, TEXT_BATCH_ROWS):
            vectors = [features(t) for t in frame["text"]]
            ok = [v is not None for v in vectors]
            yield frame.loc[ok, ["lang", "h1", "h2", "often"]].assign(x=[v for v in vectors if v is not None])

    drawn = map_batches(sample, run, "lang string, h1 long, h2 long, often long, x array<double>")
    drawn = materialise(drawn.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("often").cast("int")))))
    present = sorted(r["lang"] for r in drawn.select("lang").distinct().collect())
    family = F.create_map(*[F.lit(x) for k in present for x in (k, family_of(k))]) if present else F.lit(None)
    if not present:
        return Model({}, [], {})
    # A few MB in all, in one order: sums and fits are the same whatever the files were.
    drawn = drawn.coalesce(1).sortWithinPartitions("lang", "h1", "h2", "copy")
    ready = drawn.select("lang", family[F.col("lang")].alias("family"), array_to_vector("x").alias("features"))
    langs: dict[str, list[str]] = {}
    for lang in present:
        langs.setdefault(family_of(lang), []).append(lang)
    between = _separators(ready, "family", sorted(langs))
    within = {name: _separators(ready, "lang", members) for name, members in langs.items()}
    return Model(langs, between, within, _profiles(drawn))


def predict(docs: DataFrame, model: Model, columns: list[str]) -> DataFrame:
    """``columns`` of each row with lang_pred and score (0 to 1) from its whole text; one pass, no shuffle.

    The score is the smaller of the votes' and the likeness to the language told, judged by the text's number of letters.  A null text or one
    without letters is ``und`` with score 0.  Columns named lang_pred or score are replaced.
    """
    kept = [c for c in columns if c not in ("lang_pred", "score")]
    rows = docs.select(*kept, F.col("text").alias("_text"))

    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches(frames, TEXT_BATCH_ROWS):
            told = [model.predict(*measured(t)) for t in frame["_text"]]
            out = frame[kept].copy()
            out["lang_pred"], out["score"] = [x for x, _ in told], [s for _, s in told]
            yield out

    types = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in kept)
    return map_batches(rows, run, f"{types}, lang_pred string, score double")


def held_out(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 3, is 1 (a null id counts as an empty text)."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 3 == 1


def identify(docs: DataFrame) -> DataFrame:
    """Fit on the documents that are not held out and predict all: doc_id, held_out, lang_pred, score."""
    model = fit(docs.where(~held_out()))
    return predict(docs.select("doc_id", "text", held_out().alias("held_out")), model, ["doc_id", "held_out"])


def accepted(docs: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """The rows of ``docs`` whose language is known: not ``und``, and with a score of at least ``min_score``.

    A short text is rejected only where its few letters can tell: see :meth:`Profile.likeness`.
    Without a single labelled row no language can be told; then the rows with letters are returned.
    """
    model = fit(docs.where(~held_out()))
    if not model.langs:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    named = {f"_c{i}": c for i, c in enumerate(docs.columns)}
    renamed = docs.select("text", *[F.col(f"`{c}`").alias(n) for n, c in named.items()])
    told = predict(renamed, model, list(named))
    known = told.where((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= min_score))
    return known.select(*[F.col(n).alias(c) for n, c in named.items()])
