"""Near-duplicate vectors by product quantisation.

Vectors of unit length go to the nearest of a set of coarse centroids (inverted lists); what is left of
them is coded by the nearest codeword in each of SUBSPACES subspaces.  The model is fitted on a bounded sample, every
vector is indexed.

Probes are sufficient, not a fixed number: a vector y of list j lies on j's side of the bisector of i and j, so
a vector x of list i within the radius of y is at most the radius away from that bisector.  x probes just
the lists for which that holds, and no pair under the radius is missed.  In a list, distances from x to the
coded vectors are sums of table entries; as every code comes with its own error, a pair can be left out
only if distance minus error is over the radius.  What remains is compared by the exact cosine.

Equal vectors are one class.  A list's coded vectors are cut into tiles, other vectors stream past
each tile, and a task gives a count and one edge a vector, never the pairs themselves.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrapanel.llm.common import batches, map_batches, materialise, row_id, shuffle_partitions
from terrapanel.llm.graph import components

THRESHOLD = 0.98
#: Rows and numbers of the sample that the model is fitted on: at most these, drawn by a hash of the vectors.
SAMPLE_ROWS, SAMPLE_VALUES = 16_384, 2**22
SUBSPACES, CODEWORDS, STEPS = 8, 64, 8
#: Sample vectors for each list, at least.
PER_LIST = 32
#: Coded vectors that a task holds, and vectors that it compares with them at a time.
TILE, BATCH = 2048, 256
#: Bounds are widened by this much, so that rounding loses no pair.
SLACK = 1e-6


def _packed(x: np.ndarray) -> bytes | None:
    """A vector's bytes, of 4 or 8 a number, whichever holds it exactly; None if it has no direction."""
    if not len(x) or not np.isfinite(x).all() or not x.any():
        return None
    x = x + 0.0  # no negative zeros
    with np.errstate(over="ignore"):
        short = x.astype("<f4")
    return (short if (short == x).all() else x.astype("<f8")).tobytes()


def _unit(vectors: Iterable[bytes], dims: np.ndarray) -> list[np.ndarray]:
    out = []
    for v, d in zip(vectors, dims, strict=True):
        x = np.frombuffer(v, "<f4" if len(v) == 4 * d else "<f8").astype(np.float64)
        x = x / np.abs(x).max()  # neither over- nor underflow in the squares
        out.append(x / np.sqrt(x @ x))
    return out


def _first(units: list[np.ndarray], width: int) -> np.ndarray:
    """The first ``width`` components, shorter vectors filled up: no distance grows by it."""
    out = np.zeros((len(units), width))
    for k, x in enumerate(units):
        out[k, : len(x)] = x[:width]
    return out


def _squares(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] - 2 * x @ c.T + (c * c).sum(1), 0)


def _centres(x: np.ndarray, k: int) -> np.ndarray:
    """Lloyd's steps from the first k rows; a centre without rows stays where it is."""
    centres = x[:k].copy()
    for _ in range(STEPS):
        own = np.concatenate([_squares(x[a : a + 4096], centres).argmin(1) for a in range(0, len(x), 4096)])
        count = np.bincount(own, minlength=k)
        total = np.zeros_like(centres)
        np.add.at(total, own, x)
        centres[count > 0] = total[count > 0] / count[count > 0, None]
    return centres


class Model:
    """Coarse centroids and the codewords of each subspace of the residuals."""

    def __init__(self, sample: np.ndarray, lists: int):
        self.width = sample.shape[1]
        self.coarse = _centres(sample, lists)
        left = sample - self.coarse[_squares(sample, self.coarse).argmin(1)]
        edges = np.linspace(0, self.width, min(SUBSPACES, self.width) + 1).astype(int)
        self.cuts = list(zip(edges, edges[1:], strict=False))
        k = max(1, min(CODEWORDS, len(sample) // 4))
        self.words = [_centres(left[:, a:b], k) for a, b in self.cuts]

    def code(self, x: np.ndarray, home: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes (a byte a subspace) and the distance from each vector to what its code stands for."""
        left = x - self.coarse[home]
        codes, error = np.empty((len(x), len(self.cuts)), np.uint8), np.zeros(len(x))
        for m, (a, b) in enumerate(self.cuts):
            d = _squares(left[:, a:b], self.words[m])
            codes[:, m] = d.argmin(1)
            error += ((left[:, a:b] - self.words[m][codes[:, m]]) ** 2).sum(1)
        return codes, np.sqrt(error)

    def probes(self, x: np.ndarray, squares: np.ndarray, home: np.ndarray, radius: float) -> np.ndarray:
        """Mask of the later lists that may hold a vector within the radius."""
        apart = np.sqrt(_squares(self.coarse, self.coarse))[home]
        away = squares - squares[np.arange(len(x)), home][:, None]
        return (away <= 2 * apart * (radius + SLACK) + SLACK) & (np.arange(len(self.coarse)) > home[:, None])

    def distances(self, x: np.ndarray, lists: int, codes: np.ndarray) -> np.ndarray:
        """Distances from whole vectors to coded ones of one list, from a table a vector."""
        left = x - self.coarse[lists]
        total = np.zeros((len(x), len(codes)))
        for m, (a, b) in enumerate(self.cuts):
            total += _squares(left[:, a:b], self.words[m])[:, codes[:, m]]
        return np.sqrt(total)


def fitted(classes: DataFrame) -> Model | None:
    """The model of a bounded sample, the same however the table is cut into files; None without vectors."""
    n, dims = classes.agg(F.count("*"), F.max("dims")).first()
    if not n:
        return None
    rows = max(1, min(SAMPLE_ROWS, SAMPLE_VALUES // dims))
    drawn = classes.select(F.xxhash64("same").alias("draw"), "same", "dims", "vec").orderBy("draw", "same").limit(rows).toPandas()
    sample = _first(_unit(drawn["vec"], drawn["dims"].to_numpy()), int(drawn["dims"].max()))
    return Model(sample, max(1, min(round(n**0.5 / 4), len(sample) // PER_LIST)))


_KEY = ["label", "dims", "list"]
_PLACED = "label string, dims int, list int, other boolean, rep long, n long, vec binary, code binary, error double"


def placed(classes: DataFrame, model: Model, radius: float) -> DataFrame:
    """A row for each class in its own list, coded, and one (``other``) in each later list that it probes."""
    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches(frames, 1024):
            x = _first(_unit(frame["vec"], frame["dims"].to_numpy()), model.width)
            squares = _squares(x, model.coarse)
            home = squares.argmin(1)
            codes, error = model.code(x, home)
            yield frame[["label", "dims", "rep", "n", "vec"]].assign(list=home, other=False, code=[c.tobytes() for c in codes], error=error)
            who, where = np.nonzero(model.probes(x, squares, home, radius))
            yield frame[["label", "dims", "rep", "n", "vec"]].iloc[who].assign(list=where, other=True, code=None, error=None)

    return materialise(map_batches(classes.select("label", "dims", "rep", "n", "vec"), run, _PLACED))


class _Tile:
    """Coded vectors of a list, their counts and how they hang together."""

    def __init__(self, rows: pd.DataFrame, model: Model, threshold: float, radius: float):
        self.model, self.threshold, self.radius = model, threshold, radius
        self.list = int(rows["list"].iloc[0])
        self.reps, self.n = rows["rep"].to_numpy(np.int64), rows["n"].to_numpy(np.int64)
        self.units = np.vstack(_unit(rows["vec"], rows["dims"].to_numpy()))
        self.codes = np.vstack([np.frombuffer(c, np.uint8) for c in rows["code"]])
        self.reach = rows["error"].to_numpy() + radius + SLACK
        self.links, self.root = np.zeros(len(rows), np.int64), np.arange(len(rows))
        for at in range(0, len(rows), BATCH):
            end = min(at + BATCH, len(rows))
            linked = self.linked(self.units[at:end])
            linked &= np.arange(len(rows)) > np.arange(at, end)[:, None]
            self.count(linked, self.n[at:end])
            self.links[at:end] += linked @ self.n
            for k in np.flatnonzero(linked.any(1)):
                self.join(np.append(np.flatnonzero(linked[k]), at + k))

    def linked(self, units: np.ndarray) -> np.ndarray:
        """Which coded vectors each of ``units`` is linked with: table look-ups, then exact cosines."""
        near = self.model.distances(_first(list(units), self.model.width), self.list, self.codes) <= self.reach
        some = np.flatnonzero(near.any(0))
        near[:, some] &= units @ self.units[some].T >= self.threshold
        return near

    def count(self, linked: np.ndarray, n: np.ndarray) -> None:
        self.links += n @ linked

    def join(self, members: np.ndarray) -> None:
        roots = np.unique(self.root[members])
        if len(roots) > 1:
            self.root[np.isin(self.root, roots)] = roots[0]

    def meet(self, rows: pd.DataFrame) -> pd.DataFrame:
        units = np.vstack(_unit(rows["vec"], rows["dims"].to_numpy()))
        linked = self.linked(units)
        self.count(linked, rows["n"].to_numpy(np.int64))
        some = np.flatnonzero(linked.any(1))
        for k in some:
            self.join(np.flatnonzero(linked[k]))
        return pd.DataFrame({"rep": rows["rep"].to_numpy(np.int64)[some], "links": (linked @ self.n)[some],
                             "to": self.reps[linked[some].argmax(1)]})

    def result(self) -> pd.DataFrame:
        some = np.flatnonzero(self.links)
        return pd.DataFrame({"rep": self.reps[some], "links": self.links[some], "to": self.reps[self.root[some]]})


def met(places: DataFrame, model: Model, threshold: float, radius: float) -> DataFrame:
    """rep, links, to: partial counts of links, and an edge that keeps what is linked in one component; written."""
    tiles = places.where("NOT other").groupBy(*_KEY).agg(F.ceil(F.count("*") / TILE).cast("int").alias("tiles"))
    dealt = places.join(tiles, _KEY).withColumn("own", F.pmod(F.xxhash64("rep"), "tiles").cast("int"))
    # A coded vector meets its own tile as one of it and streams past the earlier ones; the others stream past all.
    before = F.when(F.col("other"), F.sequence(F.lit(0), F.col("tiles") - 1)).otherwise(F.sequence(F.lit(0), "own"))
    dealt = dealt.withColumn("tile", F.explode(before)).withColumn("other", F.col("other") | (F.col("tile") < F.col("own")))
    keys = [*_KEY, "tile"]
    n = shuffle_partitions(places.sparkSession)
    dealt = dealt.drop("own", "tiles").repartition(n, *keys).sortWithinPartitions(*keys, "other")

    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, held, tile = None, [], None
        for frame in frames:
            edges = (frame[[*keys, "other"]] != frame[[*keys, "other"]].shift()).any(axis=1)
            for _, rows in frame.groupby(edges.cumsum(), sort=False):
                now = tuple(rows[keys].iloc[0])
                if now != key:
                    if key is not None:
                        yield (tile or _Tile(pd.concat(held), model, threshold, radius)).result()
                    key, held, tile = now, [], None
                if not rows["other"].iloc[0]:
                    held.append(rows)
                    continue
                if tile is None:
                    if not held:
                        raise ValueError("a tile without coded vectors")
                    tile, held = _Tile(pd.concat(held), model, threshold, radius), []
                for part in batches([rows], BATCH):
                    yield tile.meet(part)
        if key is not None:
            yield (tile or _Tile(pd.concat(held), model, threshold, radius)).result()

    return materialise(map_batches(dealt, run, "rep long, links long, to long"))


def near_vectors(rows: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row a row of ``rows`` (vec_id, embedding, label).

    Rows are linked when their labels are equal and not null and the cosine of their embeddings is at
    least ``threshold`` (over 0).  An embedding that is null, empty or zero, or holds a null, NaN or infinite
    component links with nothing, nor do embeddings of different lengths.  Repeated rows are rows of their own and are linked
    with each other.  ``component_id`` is the smallest vec_id reachable; null vec_ids don't count, a component of
    such rows alone has a null id and keeps them all.  More columns are left out.
    """
    radius = float(np.sqrt(2 - 2 * threshold))
    some = rows.select("vec_id", F.col("label").cast("string").alias("label"), F.col("embedding").cast("array<double>").alias("embedding"))

    def described(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import xxhash

        for frame in frames:
            vecs = [None if x is None else _packed(np.asarray(x, np.float64)) for x in frame["embedding"]]
            dims = [0 if x is None else len(x) for x in frame["embedding"]]
            same = [None if v is None else xxhash.xxh3_128_digest(v) for v in vecs]
            yield frame[["row", "vec_id", "label"]].assign(dims=dims, vec=vecs, same=same)

    kind = rows.schema["vec_id"].dataType.simpleString()
    base = materialise(map_batches(row_id(some, "row").withColumn("vec_id", F.col("vec_id").cast("string")), described,
                                   "row long, vec_id string, label string, dims int, vec binary, same binary"))
    base = base.withColumn("vec_id", F.col("vec_id").cast(kind))
    classes = materialise(base.where("same IS NOT NULL AND label IS NOT NULL").groupBy("label", "dims", "same").agg(
        F.min("row").alias("rep"), F.count("*").alias("n"), F.first("vec").alias("vec")))
    model = fitted(classes)
    if model is None:
        found = rows.sparkSession.createDataFrame([], "rep long, links long, to long")
    else:
        found = met(placed(classes, model, radius), model, threshold, radius)
    parts = components(found.select(F.col("rep").alias("a"), F.col("to").alias("b")))
    counts = found.groupBy("rep").agg(F.sum("links").alias("links"))
    known = classes.select("label", "dims", "same", "rep", "n").join(counts, "rep", "left").join(parts, F.col("rep") == F.col("node"), "left")
    known = known.select("label", "dims", "same", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
                         F.coalesce("component", "rep").alias("component"))
    whole = base.select("row", "vec_id", "label", "dims", "same").join(known, ["label", "dims", "same"], "left")
    whole = materialise(whole.select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component", "row").alias("component")))
    least = whole.groupBy("component").agg(F.min("vec_id").alias("component_id"))
    return whole.join(least, "component").select("vec_id", "n_links", "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))
