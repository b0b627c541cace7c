"""Embedding near-duplicates: exact metric range join over pivot cells.

Unit vectors with cosine >= t lie within the Euclidean distance r = sqrt(2 - 2 t). A bounded set of pivots
cuts the space into cells (nearest pivot). A pair is compared in the lower-numbered of its two home cells, so a
vector x with home cell p is replicated to a cell q < p only if a vector y with home q could be within r:

* triangle inequality: d(x, q) <= d(x, y) + d(y, q) <= r + radius(q), the largest distance in cell q;
* y is nearer to q than to p, so x must be within r of their bisector: (d(x, q)^2 - d(x, p)^2) / 2 d(p, q) <= r.

Both are necessary conditions: the join misses nothing. Cells join independently. A cell with more than
``BLOCK`` home vectors is split into home blocks, and what it is compared with streams by, so a task holds one
block and one batch whatever the cell. Equal vectors are one class with a count before the join; a task returns
link counts and a spanning set of links, never all pairs of a group.

Vectors whose pivots cannot tell them apart (independent random directions) replicate widely: then the join
approaches comparing everything, in blocks, which is what exactness costs there.

Defined results: NULL, empty, zero vectors and vectors with NULL or non-finite components link with nothing and
form components of their own; so do vectors of another length than each other. Repeated rows are vectors of
their own that link by cosine 1. NULL ids take part; the component id is the smallest non-NULL id.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newslake.llm.common import connected_components, roots, union_pairs, unlinked_labels
from newslake.session import materialize

MIN_COSINE = 0.95
BLOCK = 2048  # home vectors of a task
MAX_PIVOTS = 1024  # bound of what every task carries
_STEP = 512  # vectors compared with a block at a time
_SLACK = 1e-9


def unit(vector) -> np.ndarray | None:
    """The vector in double precision at length 1, or None if it has no direction."""
    if vector is None or not len(vector) or any(v is None for v in vector):
        return None
    x = np.asarray(vector, dtype=np.float64)
    if not np.isfinite(x).all():
        return None
    top = np.abs(x).max()
    if top == 0.0:
        return None
    x = x / top
    return x / np.sqrt(x @ x)


def _classify(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for f in frames:
        keys, packed, dims = [], [], []
        for v in f["embedding"]:
            x = unit(v)
            raw = None if x is None else np.asarray(v, np.float64).tobytes()
            keys.append(None if x is None else hashlib.md5(raw).hexdigest())
            packed.append(None if x is None else x.tobytes())
            dims.append(0 if x is None else len(x))
        yield pd.DataFrame({"vec_id": f["vec_id"].astype("Int64"), "key": keys, "dim": dims, "v": packed})


def _matrix(packed: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(packed), np.float64).reshape(len(packed), -1) if len(packed) else np.zeros((0, 1))


def _homes(x: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared distances to all pivots and the nearest pivot."""
    d2 = np.maximum(0.0, 2.0 - 2.0 * (x @ pivots.T))
    return d2, d2.argmin(axis=1)


def _cell_sizes(pivots: np.ndarray):
    def sizes(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count, far = np.zeros(len(pivots), np.int64), np.zeros(len(pivots))
        for f in frames:
            for at in range(0, len(f), _STEP):
                d2, home = _homes(_matrix(f["v"].iloc[at:at + _STEP]), pivots)
                count += np.bincount(home, minlength=len(pivots))
                np.maximum.at(far, home, np.sqrt(d2[np.arange(len(home)), home]))
        yield pd.DataFrame({"cell": np.arange(len(pivots)), "n": count, "radius": far})

    return sizes


def _deal(pivots: np.ndarray, blocks: np.ndarray, radius: np.ndarray, r: float):
    """Send every class to its home block and to all blocks it must be compared with."""
    between = np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (pivots @ pivots.T)))

    def deal(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for at in range(0, len(f), _STEP):
                g = f.iloc[at:at + _STEP]
                d2, home = _homes(_matrix(g["v"]), pivots)
                own2 = d2[np.arange(len(home)), home]
                near = np.arange(len(pivots))[None, :] < home[:, None]
                near &= np.sqrt(d2) <= radius[None, :] + r + _SLACK
                near &= (d2 - own2[:, None]) <= 2.0 * between[home] * (r + _SLACK) + _SLACK
                near &= blocks[None, :] > 0
                own_block = np.array([int(k[:8], 16) for k in g["key"]]) % blocks[home]
                i, q = np.nonzero(near)
                row = [np.arange(len(home))]
                cell, block, other = [home], [own_block], [np.zeros(len(home), bool)]
                for b in range(int(blocks.max())):
                    for idx, c in ((np.flatnonzero(own_block > b), None), (i[blocks[q] > b], q[blocks[q] > b])):
                        row.append(idx)
                        cell.append(home[idx] if c is None else c)
                        block.append(np.full(len(idx), b))
                        other.append(np.ones(len(idx), bool))
                row = np.concatenate(row)
                out = g.iloc[row][["key", "n", "v"]].assign(
                    cell=np.concatenate(cell), block=np.concatenate(block), other=np.concatenate(other))
                yield out[["cell", "block", "other", "key", "n", "v"]]

    return deal


class _Block:
    """A home block and what the vectors streamed past it have linked."""

    def __init__(self, t: float):
        self.t, self.keys, self.n, self.x = t, np.zeros(0, object), np.zeros(0, np.int64), None

    def add_home(self, g: pd.DataFrame) -> None:
        x = _matrix(g["v"])
        self.x = x if self.x is None else np.concatenate((self.x, x))
        self.keys = np.concatenate((self.keys, g["key"].to_numpy(object)))
        self.n = np.concatenate((self.n, g["n"].to_numpy(np.int64)))

    def close_home(self) -> None:
        self.parent = unlinked_labels(len(self.keys))
        self.links = np.zeros(len(self.keys), np.int64)
        for at in range(0, len(self.keys), _STEP):
            i, j = np.nonzero(self.x[at:at + _STEP] @ self.x.T >= self.t)
            i = i + at
            i, j = i[i != j], j[i != j]
            self.links += np.bincount(i, weights=self.n[j], minlength=len(self.keys)).astype(np.int64)
            union_pairs(self.parent, i[i < j], j[i < j])

    def compare(self, g: pd.DataFrame) -> tuple[list, list]:
        """Counts (key, links) and links (a, b) of vectors that are at home elsewhere."""
        counts, edges = [], []
        keys, n = g["key"].to_numpy(object), g["n"].to_numpy(np.int64)
        for at in range(0, len(g), _STEP):
            x = _matrix(g["v"].iloc[at:at + _STEP])
            j, i = np.nonzero(x @ self.x.T >= self.t)
            if not len(j):
                continue
            k, m = keys[at:at + _STEP], n[at:at + _STEP]
            self.links += np.bincount(i, weights=m[j], minlength=len(self.keys)).astype(np.int64)
            mine = np.bincount(j, weights=self.n[i], minlength=len(k)).astype(np.int64)
            hit, first = np.unique(j, return_index=True)
            counts += zip(k[hit], mine[hit], strict=True)
            edges += zip(k[hit], self.keys[i[first]], strict=True)
            anchor = np.zeros(len(k), np.int64)
            anchor[hit] = i[first]
            union_pairs(self.parent, i, anchor[j])
        return counts, edges

    def finish(self) -> tuple[list, list]:
        top = roots(self.parent, np.arange(len(self.keys)))
        member = np.flatnonzero(top != np.arange(len(self.keys)))
        hit = np.flatnonzero(self.links)
        return (list(zip(self.keys[hit], self.links[hit], strict=True)),
                list(zip(self.keys[member], self.keys[top[member]], strict=True)))


def _join_cells(t: float):
    def rows(counts, edges):
        return pd.DataFrame([(k, None, int(c)) for k, c in counts] + [(a, b, 0) for a, b in edges],
                            columns=["a", "b", "links"])

    def join(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, block, open_home = None, None, False
        for f in frames:  # sorted by cell, block, home first
            for where, g in f.groupby(["cell", "block"], sort=False):
                if where != at:
                    if block is not None:
                        if open_home:
                            block.close_home()
                        yield rows(*block.finish())
                    at, block, open_home = where, _Block(t), True
                home, others = g[~g["other"]], g[g["other"]]
                if len(home):
                    block.add_home(home)
                if len(others) and len(block.keys):
                    if open_home:
                        block.close_home()
                        open_home = False
                    yield rows(*block.compare(others))
        if block is not None and len(block.keys):
            if open_home:
                block.close_home()
            yield rows(*block.finish())

    return join


def _links(classes: DataFrame, dim: int, n: int, min_cosine: float) -> DataFrame:
    """(a, b, links): link counts (b NULL) and spanning links of the classes of one dimension."""
    own = classes.where(F.col("dim") == dim).select("key", "n", "v")
    wanted = min(MAX_PIVOTS, max(1, -(-n // BLOCK)))
    pivots = _matrix(pd.Series([bytes(r["v"]) for r in own.orderBy("key").limit(wanted).collect()]))
    got = (
        own.select("v").mapInPandas(_cell_sizes(pivots), "cell int, n long, radius double")
        .groupBy("cell").agg(F.sum("n").alias("n"), F.max("radius").alias("radius")).collect()
    )
    blocks, radius = np.zeros(len(pivots), np.int64), np.zeros(len(pivots))
    for g in got:
        blocks[g["cell"]], radius[g["cell"]] = -(-g["n"] // BLOCK), g["radius"]
    r = float(np.sqrt(2.0 - 2.0 * min_cosine))
    dealt = own.mapInPandas(
        _deal(pivots, blocks, radius, r), "cell int, block int, other boolean, key string, n long, v binary")
    return (
        dealt.repartition("cell", "block").sortWithinPartitions("cell", "block", "other")
        .mapInPandas(_join_cells(min_cosine), "a string, b string, links long")
    )


def near_duplicates(vectors: DataFrame, min_cosine: float = MIN_COSINE) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row of (vec_id, embedding)."""
    rows = materialize(
        vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
        .mapInPandas(_classify, "vec_id long, key string, dim int, v binary"), "vectors")
    valid = rows.where("key is not null")
    classes = materialize(
        valid.groupBy("key", "dim").agg(F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("first_id"),
                                        F.min("v").alias("v")), "vector-classes")
    found = None
    for d in classes.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).orderBy("dim").collect():
        part = _links(classes, d["dim"], d["n"], min_cosine)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = rows.limit(0).select(F.col("key").alias("a"), F.col("key").alias("b"), F.lit(0).cast("long").alias("links"))
    found = materialize(found, "vector-links")
    counts = found.where("b is null").groupBy("a").agg(F.sum("links").alias("links")).withColumnRenamed("a", "key")
    comp = connected_components(found.where("b is not null")).select(F.col("node").alias("key"), "component")
    named = classes.select("key", "n", "first_id").join(comp, "key", "left")
    first = named.where("component is not null").groupBy("component").agg(F.min("first_id").alias("least"))
    named = named.join(first, "component", "left").join(counts, "key", "left").select(
        "key", F.when(F.col("component").isNull(), F.col("first_id")).otherwise(F.col("least")).alias("component_id"),
        (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    named = materialize(named, "vector-named")
    kept = F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept")
    linked = valid.select("vec_id", "key").join(named, "key").select("vec_id", "n_links", "component_id", kept)
    alone = rows.where("key is null").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    return linked.unionByName(alone)
