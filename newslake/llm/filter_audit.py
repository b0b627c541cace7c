"""Filter interaction audit: what every order of a set of filters keeps, removes and loses.

A document fails a subset of the filters; documents with the same failures share a cell (one of ``2 ** k``
masks for ``k`` filters). Per part of the table only the cells' counts are kept, so an audit is one pass over
the texts, narrow hash aggregates, and a walk over at most ``2 ** k`` counters a part.

The walk visits all subsets of active filters in Gray-code order, toggling one filter at a time: each cell
keeps the number of active filters it fails, and the running survivors change only by the cells whose counter
leaves or returns to zero. The survivors of every subset are stored (32 states for five filters); what a
filter removes after others is the difference of two states, so all orders are read off without a recount.

Duplicates (the one filter that is not a property of a row) fail where the same text stands at a smaller id
anywhere in the table. Texts are compared by SHA-256; a text's smallest id meets its rows again on (digest,
id), which spreads a text that a third of the rows share.

Defined results: a NULL text counts as empty, a NULL part as the empty string. A row without an id has no
label, makes no other row a duplicate and is none itself. Repeated rows (same id and text) all count; the
first id's repeats are not duplicates. Labels that occur several times for an id count if any of them is 1.
An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newslake.session import materialize

SPACE = r"[\x20\x09-\x0D]+"
MAX_FILTERS = 8  # 40,320 orders and 256 states a part
_PARTS_AT_ONCE = 64
MEASURES = ["n", "good", "toxic"]

#: name -> failure condition over (text, words); the order of the names gives the bits of a mask.
TextFilters = dict[str, Callable[[Column, Column], Column]]


def words_of(text: Column) -> Column:
    """The words of a text: what stands between ASCII white space."""
    return F.array_remove(F.split(text, SPACE), "")


def too_short(least: int):
    return lambda text, words: F.size(words) < least


def too_repetitive(least_percent: int):
    """Fewer distinct words than this share of all words."""
    return lambda text, words: F.lit(100) * F.size(F.array_distinct(words)) < F.lit(least_percent) * F.size(words)


def too_many(characters: str, most_percent: int):
    """More characters of a class (inside of square brackets) than this share of all code points."""
    return lambda text, words: (
        F.lit(100) * F.length(F.regexp_replace(text, f"[^{characters}]+", "")) > F.lit(most_percent) * F.length(text))


def holds_any(characters: str):
    return lambda text, words: text.rlike(f"[{characters}]")


def filter_cells(
    docs: DataFrame, labels: DataFrame, filters: TextFilters, id_col: str = "doc_id", text_col: str = "text",
    part_col: str = "source",
) -> DataFrame:
    """(part, mask, n, good, toxic): documents per part and set of failed filters, and how many are labelled.

    Bit i of ``mask`` is the i-th filter; the bit after the last one says that the document is a duplicate.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    ).withColumn("words", words_of(F.col("text")))
    mask = sum((F.when(fails(F.col("text"), F.col("words")), 1 << i).otherwise(0)
                for i, fails in enumerate(filters.values())), F.lit(0))
    flagged = rows.select("id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), mask.alias("mask"))
    # One row for the repeats of a row: from here on nothing depends on the length of texts or on a hot id.
    groups = materialize(
        flagged.groupBy("digest", "id", "part", "mask").agg(F.count(F.lit(1)).alias("n")), "audit-groups")
    first = groups.where("id IS NOT NULL").groupBy("digest").agg(F.min("id").alias("id")).withColumn("first", F.lit(True))
    judged = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("id")).agg(
        F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    repeats = F.col("id").isNotNull() & F.col("first").isNull()
    found = groups.join(first, ["digest", "id"], "left").join(judged, "id", "left").withColumn(
        "mask", F.col("mask") + F.when(repeats, 1 << len(filters)).otherwise(0))
    return found.groupBy("part", "mask").agg(
        F.sum("n").alias("n"), *[F.sum(F.when(F.col(x), F.col("n")).otherwise(0)).alias(x) for x in ("good", "toxic")])


def survivors_by_subset(cells: np.ndarray) -> np.ndarray:
    """Survivors of every subset of active filters, by the Gray-code walk.

    ``cells`` is (parts, masks, measures); the result is (subsets, parts, measures).
    """
    n_masks = cells.shape[1]
    masks = np.arange(n_masks)
    failing = np.zeros(n_masks, np.int64)  # active filters that a cell fails
    running = cells.sum(axis=1)
    states = np.empty((n_masks, *running.shape), np.int64)
    active = 0
    states[active] = running
    for step in range(1, n_masks):
        toggled = (step & -step).bit_length() - 1
        active ^= 1 << toggled
        touched = masks[masks >> toggled & 1 == 1]
        if active >> toggled & 1:
            leaving = touched[failing[touched] == 0]
            failing[touched] += 1
            running = running - cells[:, leaving].sum(axis=1)
        else:
            failing[touched] -= 1
            returning = touched[failing[touched] == 0]
            running = running + cells[:, returning].sum(axis=1)
        states[active] = running
    return states


class Orders:
    """All orders of k filters as flat arrays: (order, step) rows with the toggled filter and the subset before it."""

    def __init__(self, names: list[str]):
        k = len(names)
        orders = list(permutations(range(k)))
        self.k, self.n = k, len(orders) * k
        self.filter = np.array(orders).ravel()
        bits = 1 << np.array(orders)
        self.before = (np.cumsum(bits, axis=1) - bits).ravel()
        self.after = self.before | bits.ravel()
        self.step = np.tile(np.arange(1, k + 1), len(orders))
        self.name = np.repeat(["".join(names[i] for i in o) for o in orders], k)


def _audit(names: list[str]):
    orders = Orders(names)
    k, every = orders.k, (1 << orders.k) - 1

    def table(parts: list[str], cells: np.ndarray) -> pd.DataFrame:
        states = survivors_by_subset(cells)
        n = states[:, :, 0]
        bit = 1 << np.arange(k)
        failing = n[0] - n[bit]  # (k, parts)
        alone = n[every & ~bit] - n[every]
        shapley = np.zeros_like(failing)
        for subset in range(every + 1):
            for f in range(k):
                if not subset >> f & 1:
                    size = subset.bit_count()
                    shapley[f] += factorial(size) * factorial(k - 1 - size) * (n[subset] - n[subset | 1 << f])
        lost = states[orders.before] - states[orders.after]  # (rows, parts, measures)
        by_part = lambda a: a.T.ravel()
        return pd.DataFrame({
            "part": np.repeat(np.array(parts, object), orders.n), "filter_order": np.tile(orders.name, len(parts)),
            "step": np.tile(orders.step, len(parts)), "kept": by_part(n[orders.after]), "removed": by_part(lost[:, :, 0]),
            "redundant": by_part(failing[orders.filter] - lost[:, :, 0]), "unique_fails": by_part(alone[orders.filter]),
            "good_lost": by_part(lost[:, :, 1]), "toxic_lost": by_part(lost[:, :, 2]),
            "shapley": by_part(shapley[orders.filter]),
        })

    def audit(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for at in range(0, len(f), _PARTS_AT_ONCE):
                rows = f.iloc[at:at + _PARTS_AT_ONCE]
                cells = np.zeros((len(rows), every + 1, len(MEASURES)), np.int64)
                for i, r in enumerate(rows.itertuples(index=False)):
                    for j, measure in enumerate(MEASURES):
                        cells[i, r.mask, j] = getattr(r, measure)
                yield table(rows["part"].tolist(), cells)

    return audit


AUDIT = ("part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
         "good_lost long, toxic_lost long, shapley long")


def interactions(cells: DataFrame, names: list[str]) -> DataFrame:
    """One row per part, order of the filters and step, zeros included, from the counts of ``filter_cells``."""
    if len(names) > MAX_FILTERS:
        raise ValueError(f"at most {MAX_FILTERS} filters")
    entry = F.collect_list(F.struct("mask", *MEASURES))  # at most 2 ** k entries a part
    by_part = cells.groupBy("part").agg(entry.alias("c")).select("part", *[F.col(f"c.{x}").alias(x) for x in ["mask", *MEASURES]])
    return by_part.mapInPandas(_audit(names), AUDIT)


def audit_filters(
    docs: DataFrame, labels: DataFrame, filters: TextFilters, duplicates: str, id_col: str = "doc_id",
    text_col: str = "text", part_col: str = "source",
) -> DataFrame:
    """The interactions of text filters, and of the duplicate filter named ``duplicates`` as the last letter."""
    return interactions(filter_cells(docs, labels, filters, id_col, text_col, part_col), [*filters, duplicates])
