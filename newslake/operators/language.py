"""Language identification by character n-gram profiles (LNG1).

Training is a hash aggregate ``groupBy(lang, gram).count()`` over the gram occurrences
of labelled text (partial aggregation per task keeps the hash tables vocabulary-sized).
Scoring joins the grams of each text, one row an occurrence, with the profile, one row a
gram with its weight in every language, and sums them per text in the same task. The profile
is broadcast, in blocks of bounded measured bytes with a pass over the texts each, so only
one row of sums per text is ever shuffled:

    score(lang) = sum_g c_g * ln(n_{g,lang} + 1) - T * ln(N_lang + V)

which equals ``sum_g c_g * ln((n_{g,lang} + 1) / (N_lang + V))`` (add-one smoothing; ``T``
grams in the document, ``N_lang`` grams of the language, ``V`` distinct grams). The
highest score wins, ties by language code; a document without grams gets ``en``. Texts are
keyed by id and digest: different texts that share an id are scored by themselves. Grams are
taken by code point. Only one number per language comes to the driver.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newslake.functions.arrays import explode_with_pos
from newslake.functions.text import as_col
from newslake.session import BROADCAST_BYTES, materialize

FALLBACK = "en"


def char_windows(text: Column | str, n_max: int = 3) -> Column:
    """The up-to-``n_max``-character window starting at every code point of the lowercased text.

    One linear regex pass (a zero-width lookahead capture per position; the second half of a
    surrogate pair starts no window). The prefixes of the windows are exactly the text's
    1..n_max-grams (see ``window_grams``).
    """
    t = F.lower(F.coalesce(as_col(text), F.lit("")))
    return F.regexp_extract_all(t, F.lit(f"(?s)(?=([^\\uDC00-\\uDFFF].{{0,{n_max - 1}}}))"), 1)


def window_grams(window: Column | str, n_max: int = 3) -> Column:
    """The prefixes of one window (length 1..len(window)) -- short strings, O(1) each."""
    w = as_col(window)
    return F.slice(F.array(*[F.substring(w, 1, k) for k in range(1, n_max + 1)]), 1, F.length(w))


def explode_grams(df: DataFrame, keep: list[str], text: Column | str, n_max: int = 3) -> DataFrame:
    """One row per gram occurrence: ``keep`` columns + ``gram`` (windows, then prefixes)."""
    wins = explode_with_pos(df, keep, char_windows(text, n_max), "_wp", "_w")
    return explode_with_pos(wins, keep, window_grams("_w", n_max), "_gp", "gram").drop("_gp")


def gram_total(text: Column | str, n_max: int = 3) -> Column:
    """Number of grams of the text, computed without exploding."""
    length = F.length(F.lower(F.coalesce(as_col(text), F.lit(""))))
    total = F.lit(0)
    for k in range(1, n_max + 1):
        total = total + F.greatest(length - k + 1, F.lit(0))
    return total.cast("long")


def train_profile(labelled: DataFrame, *, lang: str = "lang", text: str = "text") -> DataFrame:
    """``(lang, gram, n)``: gram counts per language over the labelled rows."""
    return (
        explode_grams(labelled.filter(F.col(lang).isNotNull()).select(F.col(lang).alias("lang"), F.col(text)), ["lang"], text)
        .groupBy("lang", "gram")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def identify_language(df: DataFrame, profile: DataFrame, *, id_col: str = "id", text: str = "content", out: str = "lang_pred") -> DataFrame:
    """``(id, lang_pred)`` for every row of ``df``.

    The profile (bounded by vocabulary x languages) is written once as a table in the
    session's checkpoint folder, so the per-language totals and the scoring join read
    it instead of recomputing the training explode.
    """
    profile = materialize(profile, "language-profile")
    stats = profile.groupBy("lang").agg(
        F.sum("n").alias("n_lang"), F.sum(F.octet_length("gram") + F.octet_length("lang") + 8).alias("size")).collect()
    if not stats:
        return df.select(F.col(id_col), F.lit(FALLBACK).alias(out))
    vocab = profile.select("gram").distinct().count()
    stats = sorted(stats, key=lambda r: r["lang"])
    weight = F.log(F.col("n") + F.lit(1.0))
    side = profile.groupBy("gram").agg(*[
        F.coalesce(F.max(F.when(F.col("lang") == r["lang"], weight)), F.lit(0.0)).alias(f"_w{i}") for i, r in enumerate(stats)])
    docs = df.select(
        F.col(id_col).alias("_id"), F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("_k"),
        gram_total(text).alias("_T"), char_windows(text).alias("_ws"))
    # A text without grams keeps one row.
    wins = docs.select("_id", "_k", "_T", F.explode_outer("_ws").alias("_w"))
    grams = wins.select("_id", "_k", "_T", F.explode_outer(window_grams("_w")).alias("gram"))
    sums = [f"_s{i}" for i in range(len(stats))]
    by = ["_id", "_k", "_T"]

    def summed(rows: DataFrame, weights: DataFrame) -> DataFrame:
        return rows.join(F.broadcast(weights), "gram", "left").groupBy(*by).agg(
            F.count(F.lit(1)).alias("_n"),
            *[F.coalesce(F.sum(f"_w{i}"), F.lit(0.0)).alias(c) for i, c in enumerate(sums)])

    blocks = -(-4 * sum(r["size"] for r in stats) // BROADCAST_BYTES)
    if blocks <= 1:
        found = summed(grams, side)
    else:
        # A pass over the texts for every block of the profile: no gram of a text is ever shuffled.
        block = F.pmod(F.xxhash64("gram"), F.lit(blocks))
        parts = [materialize(summed(grams.where(block == b), side.where(block == b)), "language-sums") for b in range(blocks)]
        found = reduce(DataFrame.unionByName, parts).groupBy(*by).agg(*[F.sum(c).alias(c) for c in ["_n", *sums]])
    # Rows of one id and text were counted together: their grams add up, and each of them is a row again.
    # (-score, lang) pairs; the smallest is the best language (ties by language code).
    best = F.array_min(F.array(*[
        F.struct((F.col("_n") * F.lit(math.log(r["n_lang"] + vocab)) - F.col(c)).alias("neg"), F.lit(r["lang"]).alias("lang"))
        for r, c in zip(stats, sums, strict=True)]))["lang"]
    pred = F.when(F.col("_T") > 0, best).otherwise(F.lit(FALLBACK))
    copies = (F.col("_n") / F.greatest("_T", F.lit(1))).cast("int")
    return found.select(F.col("_id").alias(id_col), F.explode(F.array_repeat(pred, copies)).alias(out))


__all__ = ["char_windows", "explode_grams", "gram_total", "identify_language", "train_profile", "window_grams"]
