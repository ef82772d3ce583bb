"""Near-duplicate embeddings by product quantisation.

1. Equal vectors of one label are one class with a weight.
2. An index is fitted on a bounded sample (``SAMPLE`` classes, by hash): coarse centroids
   by k-means, one residual codebook per subspace. Every class is indexed.
3. A class lies in the inverted list of its nearest centroid as residual codes and the
   length of what the codes miss. It probes each list whose cell is within ``slack`` of
   it, measured along the line between the two centroids. Within distance r of a vector
   the other one leaves the cell that far only if most of r lies along that one line,
   which in many dimensions nearly none does; ``slack=None`` takes r itself and so is
   exact. (The tests measure recall against brute force.)
4. In a list, distances come from tables, query residual subspace against codeword
   (asymmetric), summed over the codes. By the triangle inequality a pair stays if
   that distance is at most r plus what the codes miss; so this step loses nothing.
   What stays is ranked by its cosine in double precision.

Pairs are met once: a class probes lists from its own number on. A list and its
visitors are dealt in square tiles of about ``TILE`` rows a side, so a label, a list or
a group of near copies that holds a third of all rows is many tasks of one size. A
tile returns, for each class, the weight of its partners and one member of its group
there: no pairs leave it.

Vectors that are null, empty or zero, or hold null or non-finite components, and rows
without label or id link with nothing, nor do vectors of different lengths. Repeated
rows are vectors of their own. Extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm.common import map_batches, source
from tidelog.llm.groups import components
from tidelog.session import settle

SAMPLE = 20_000
TILE = 1024
PER_LIST = 500
SLACK = 0.15
SUBSPACES, WORDS = 8, 32


def _near(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return ((x**2).sum(1)[:, None] - 2 * x @ c.T + (c**2).sum(1)[None]).clip(0)


def _kmeans(x: np.ndarray, k: int, rounds: int = 10) -> np.ndarray:
    """Lloyd's algorithm from evenly spaced rows."""
    c = x[np.linspace(0, len(x) - 1, min(k, len(x))).astype(int)].copy()
    for _ in range(rounds):
        own = _near(x, c).argmin(1)
        n = np.bincount(own, minlength=len(c))
        sums = np.zeros_like(c)
        np.add.at(sums, own, x)
        c = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], c)
    return c


class Index:
    """Coarse centroids and residual codebooks for unit vectors of one length."""

    def __init__(self, x: np.ndarray, lists: int):
        self.centroids = _kmeans(x, lists)
        d = x.shape[1]
        self.parts = np.array_split(np.arange(d), min(SUBSPACES, d))
        rest = x - self.centroids[_near(x, self.centroids).argmin(1)]
        self.books = [_kmeans(rest[:, p], WORDS) for p in self.parts]

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """List, codes, what the codes miss, and squared distances to all centroids."""
        far = _near(x, self.centroids)
        own = far.argmin(1)
        rest = x - self.centroids[own]
        codes = np.stack([_near(rest[:, p], b).argmin(1) for p, b in zip(self.parts, self.books, strict=True)], 1)
        back = np.concatenate([b[codes[:, j]] for j, b in enumerate(self.books)], 1)
        return own, codes.astype(np.uint8), np.sqrt(((rest - back) ** 2).sum(1)), far

    def probes(self, own: np.ndarray, far: np.ndarray, slack: float) -> np.ndarray:
        """Whether each row probes each list: its own, and later ones within ``slack``."""
        apart = np.sqrt(_near(self.centroids, self.centroids))[own]
        beyond = far - far[np.arange(len(own)), own][:, None]
        reach = beyond <= 2 * slack * np.maximum(apart, 1e-9)
        later = np.arange(len(self.centroids))[None] > own[:, None]
        reach &= later
        reach[np.arange(len(own)), own] = True
        return reach

    def distances(self, x: np.ndarray, at: int, codes: np.ndarray) -> np.ndarray:
        """Approximate squared distances by table look-up: queries by rows of one list."""
        rest = x - self.centroids[at]
        out = np.zeros((len(x), len(codes)))
        for j, (p, book) in enumerate(zip(self.parts, self.books, strict=True)):
            out += _near(rest[:, p], book)[:, codes[:, j]]
        return out


def _unit(data: list[bytes]) -> np.ndarray:
    x = np.frombuffer(b"".join(data), np.float64).reshape(len(data), -1)
    x = x / np.abs(x).max(1, keepdims=True)  # so that squares neither vanish nor overflow
    return x / np.sqrt((x**2).sum(1, keepdims=True))


ROWS = "vec_id long, label long, dim int, key binary, vec binary"


def vectors(df: DataFrame) -> DataFrame:
    """Rows with the vector as bytes; its key is null if it links with nothing."""

    def run(batch: pa.RecordBatch):
        ids, labels, items = (c.to_pylist() for c in batch.columns)
        dims, keys, vecs = [], [], []
        for i, label, v in zip(ids, labels, items, strict=True):
            ok = bool(v) and i is not None and label is not None and None not in v
            x = np.array(v, np.float64) + 0.0 if ok else None
            ok = ok and bool(np.isfinite(x).all()) and bool(x.any())
            data = x.tobytes() if ok else None
            dims.append(len(v) if ok else None)
            keys.append(xxhash.xxh3_128_digest(data) if ok else None)
            vecs.append(data)
        return [batch.column(0), batch.column(1), dims, keys, vecs]

    picked = df.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("long").alias("label"),
        F.col("embedding").cast("array<double>").alias("embedding"),
    )
    return map_batches(picked, run, ROWS)


def fit(classes: DataFrame, total: int) -> dict[int, Index]:
    """An index per vector length from a bounded sample. ``total``: classes."""
    rows = classes.select("dim", "vec", F.xxhash64("cls").alias("h")).orderBy("h").limit(SAMPLE).collect()
    lists = max(8, min(1024, math.ceil(total / PER_LIST)))
    by: dict[int, list[bytes]] = {}
    for r in rows:
        by.setdefault(r["dim"], []).append(bytes(r["vec"]))
    return {dim: Index(_unit(data), lists) for dim, data in by.items()}


def _groups(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest member of each one's group among n, for links i - j."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def near_links(classes: DataFrame, indexes: dict[int, Index], cosine: float, slack: float | None, tile: int) -> DataFrame:
    """(cls, weight, root) per tile and class with partners there."""
    r = math.sqrt(max(0.0, 2 - 2 * cosine)) + 1e-9
    reach = r if slack is None else min(slack, r)

    def listed(batch: pa.RecordBatch):
        cls, label, dim, vec, weight = (c.to_pylist() for c in batch.columns)
        out = []
        for d in set(dim):
            at = [k for k, x in enumerate(dim) if x == d]
            x = _unit([vec[k] for k in at])
            index = indexes.get(d)
            if index is None:  # a length that the sample has not: one list
                rows = [(0, b"", 2.0, [0])] * len(at)
            else:
                own, codes, missed, far = index.encode(x)
                probes = index.probes(own, far, reach)
                rows = [
                    (int(own[k]), codes[k].tobytes(), float(missed[k]), np.flatnonzero(probes[k]).tolist())
                    for k in range(len(at))
                ]
            out += [(cls[k], label[k], d, vec[k], weight[k], *row) for k, row in zip(at, rows, strict=True)]
        return list(zip(*out, strict=True)) if out else None

    ddl = "cls long, label long, dim int, vec binary, weight long, list int, codes binary, missed double, probes array<int>"
    rows = settle(map_batches(classes.select("cls", "label", "dim", "vec", "weight"), listed, ddl), "lists")
    place = ["label", "dim", "list"]
    base = rows.drop("probes").withColumn("home", F.col("list"))
    visit = rows.withColumnRenamed("list", "home").withColumn("list", F.explode("probes")).drop("probes")
    sides = (
        base.groupBy(place).agg(F.count(F.lit(1)).alias("nb"))
        .join(visit.groupBy(place).agg(F.count(F.lit(1)).alias("nv")), place)
        .withColumn("nb", F.ceil(F.col("nb") / tile).cast("int"))
        .withColumn("nv", F.ceil(F.col("nv") / tile).cast("int"))
    )

    def dealt(side: DataFrame, own: str, other: str, role: int) -> DataFrame:
        met = side.join(sides, place)
        mine = F.pmod(F.xxhash64("cls"), F.col(own)).cast("int")
        each = F.explode(F.sequence(F.lit(0), F.col(other) - 1))
        met = met.withColumn("_mine", mine).withColumn("_other", each).withColumn("role", F.lit(role))
        b, v = ("_mine", "_other") if role == 0 else ("_other", "_mine")
        return met.select(
            *place, F.col(b).alias("tb"), F.col(v).alias("tv"), "role", "cls", "vec", "weight", "codes", "missed", "home"
        )

    def solve(table):
        t = table.to_pydict()
        dim, at = t["dim"][0], t["list"][0]
        role = np.array(t["role"])
        b, v = np.flatnonzero(role == 0), np.flatnonzero(role == 1)
        none = pa.table({c: pa.array([], pa.int64()) for c in ("cls", "weight", "root")})
        if not len(b) or not len(v):
            return none
        cls, weight, home = np.array(t["cls"]), np.array(t["weight"]), np.array(t["home"])
        xb, xv = _unit([t["vec"][k] for k in b]), _unit([t["vec"][k] for k in v])
        # Both ends in this list: take the pair from the smaller class.
        once = (home[v][:, None] != at) | (cls[v][:, None] < cls[b][None])
        index = indexes.get(dim)
        if index is not None:
            codes = np.frombuffer(b"".join(t["codes"][k] for k in b), np.uint8).reshape(len(b), -1)
            missed = np.array([t["missed"][k] for k in b])
            once &= index.distances(xv, at, codes) <= (r + missed[None]) ** 2 + 1e-9
        i, j = np.nonzero(once)
        ok = np.einsum("ij,ij->i", xv[i], xb[j]) >= cosine if len(i) <= 1 << 20 else (xv @ xb.T)[i, j] >= cosine
        i, j = i[ok], j[ok]
        if not len(i):
            return none
        # A class may stand on both sides; number classes, not rows.
        own, number = np.unique(cls, return_inverse=True)
        ni, nj = number[v[i]], number[b[j]]
        links = np.bincount(ni, weight[b[j]], len(own)) + np.bincount(nj, weight[v[i]], len(own))
        root = own[_groups(len(own), ni, nj)]
        has = np.flatnonzero(links)
        return pa.table({"cls": own[has], "weight": links[has].astype(np.int64), "root": root[has]})

    tiles = dealt(base, "nb", "nv", 0).unionByName(dealt(visit, "nv", "nb", 1))
    return tiles.groupBy(*place, "tb", "tv").applyInArrow(solve, "cls long, weight long, root long")


def near_duplicates(df: DataFrame, cosine: float = 0.93, slack: float | None = SLACK, tile: int = TILE) -> DataFrame:
    """Per row: vec_id, n_links, component_id, kept."""
    rows = settle(vectors(df), "vectors")
    classes = (
        rows.filter("key is not null")
        .groupBy("label", "dim", "key")
        .agg(F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("weight"), F.first("vec").alias("vec"))
        .withColumn("cls", F.monotonically_increasing_id())
    )
    classes = settle(classes, "classes")
    found = settle(near_links(classes, fit(classes, classes.count()), cosine, slack, tile), "found")
    grouped = components(found.select(F.col("cls").alias("a"), F.col("root").alias("b"))).withColumnRenamed("id", "cls")
    first = grouped.join(classes.select("cls", "first"), "cls").groupBy("component").agg(F.min("first").alias("low"))
    named = grouped.join(first, "component").select("cls", "low")
    links = found.groupBy("cls").agg(F.sum("weight").alias("partners"))
    known = (
        classes.drop("vec").join(links, "cls", "left").join(named, "cls", "left")
        .select("label", "dim", "key", (F.col("weight") - 1 + F.coalesce("partners", F.lit(0))).alias("n"),
                F.coalesce("low", "first").alias("low"))
    )
    component = F.coalesce("low", "vec_id")
    return rows.drop("vec").join(known, ["label", "dim", "key"], "left").select(
        "vec_id",
        F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        component.eqNullSafe(F.col("vec_id")).alias("kept"),
    )


def op9_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(source(spark, sf_dir, "embeddings"))
