"""Helpers shared by the operators: table access, fold keys, connected components, numpy unions."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newslake.session import materialize, prepare


_MEMORY: dict[str, Callable[[], None]] = {}


def worker_belongs_to(owner: str, release: Callable[[], None] | None = None) -> None:
    """Called as a task's Python part starts: frees what another operator's tasks left in this worker.

    Workers outlive tasks, and so do the memos that tokenizers keep in them (``release`` empties the owner's).
    """
    for other in [o for o in _MEMORY if o != owner]:
        _MEMORY.pop(other)()
        gc.collect()
    if release:
        _MEMORY[owner] = release


@contextmanager
def acyclic() -> Iterator[None]:
    """Code that makes many objects and no cycles: the collector's search for cycles waits until it is through.

    With large memos in the worker each search costs more than the work between two of them.
    """
    was = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was:
            gc.enable()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fold(id_col: str, n: int) -> Column:
    """``crc32(id as text) mod n``; NULL for a NULL id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % F.lit(n)


def unlinked_labels(n: int) -> np.ndarray:
    return np.arange(n, dtype=np.int64)


def union_pairs(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Union the index pairs ``(a[i], b[i])`` in place; every root is the smallest index of its set."""
    while len(a):
        ra, rb = roots(parent, a), roots(parent, b)
        differs = ra != rb
        a, b, ra, rb = a[differs], b[differs], ra[differs], rb[differs]
        if not len(a):
            return
        hi, lo = np.maximum(ra, rb), np.minimum(ra, rb)
        np.minimum.at(parent, hi, lo)


def roots(parent: np.ndarray, i: np.ndarray) -> np.ndarray:
    r = parent[i]
    while True:
        rr = parent[r]
        if np.array_equal(rr, r):
            return r
        r = rr


def sorted_groups(frames: Iterator, keys: list[str]) -> Iterator:
    """Regroup a stream of sorted pandas frames so that no run of equal ``keys`` spans two frames.

    What is held back is one batch plus the run that is still open.
    """
    import pandas as pd

    held = []
    for f in frames:
        if not len(f):
            continue
        if held and any(held[-1][k].iloc[-1] != f[k].iloc[0] for k in keys):
            yield pd.concat(held, ignore_index=True)
            held = []
        other = np.zeros(len(f), bool)
        for k in keys:
            v = f[k].to_numpy()
            other |= v != v[-1]
        last = int(np.flatnonzero(other)[-1]) + 1 if other.any() else 0
        if last:
            held.append(f.iloc[:last])
            yield pd.concat(held, ignore_index=True)
            held = []
        held.append(f.iloc[last:])
    if held:
        yield pd.concat(held, ignore_index=True)


def _edge_state(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h"),
    ).first()
    return row["n"], row["h"]


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Smallest reachable node of every node that has an edge: ``(node, component)``.

    Alternates the large-star and small-star steps of the published MapReduce algorithm
    ("Connected Components in MapReduce and Beyond") until the edge set stops changing.
    Every step is a hash aggregate and an equi-join. Minima and edges are written tables
    in the shared folder, so lineage stays short, a lost executor repeats one step, and
    the joins read two plain shuffles, which AQE can split at a hub node. Self loops and
    NULL ends are ignored; an empty edge table gives an empty result.
    """
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    e = materialize(e, "cc-edges")
    state = _edge_state(e)
    while state[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = materialize(
            both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "cc-min"
        )
        large = materialize(
            both.where("v > u").join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct(),
            "cc-large",
        )
        low = materialize(large.groupBy("u").agg(F.min("v").alias("m")), "cc-min")
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = materialize(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "cc-edges")
        before, state = state, _edge_state(e)
        if before == state:
            break
    members = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return members.unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
