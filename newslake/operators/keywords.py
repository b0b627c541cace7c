"""Keyword extraction: simple split keywords (KEY1) and statistical ranking (KEY2, TOP1).

KEY2 follows the single-word feature set of the YAKE paper (Campos et al., 2020), built
from joins-free column work, one hash aggregate and per-document windows:

* sentences: ``split(text, '[.!?\\n]+')`` with their index; tokens ``[\\p{L}\\p{N}]+`` with
  their position; left/right neighbours come from shifted token arrays (no window);
* per (doc, lowercased term), stopwords excluded: ``tf``, ``tf_upper`` (capitalised, not
  sentence-initial), ``tf_acronym`` (all capitals), median sentence index, number of
  sentences with the term, distinct/total left and right neighbours;
* per doc: mean, population stddev and max of ``tf`` over candidate terms, sentences;
* ``case = max(tf_upper, tf_acronym) / (1 + ln tf)``, ``pos = ln(ln(3 + median))``,
  ``norm = tf / (mean + std)``, ``rel = 1 + (DL + DR) * tf / max_tf``,
  ``spread = sentences_with_term / sentences``,
  ``H = rel * pos / (case + norm / rel + spread / rel)``, ``score = H / (tf * (1 + H))``;
* lowest score first, ties by term, top ``k`` per document.

A document is ranked within its row by array work over its sorted occurrences, so nothing is
shuffled and a task holds one text at a time. Rows that share an id count as one document:
they alone go through hash aggregates and per-document windows over their occurrences, so
any number of rows may share an id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newslake.functions.arrays import explode_with_pos
from newslake.functions.text import SENTENCE_SPLIT, TOKEN_PATTERN, as_col, whitespace_split
from newslake.session import BROADCAST_BYTES, materialize

TOKEN_CHAR = r"[\p{L}\p{N}]"

# Our stopword lists (a parameter of the ranking; not reference values).
DEFAULT_STOPWORDS = {
    "en": "a an and are as at be by for from has have in is it its of on or that the this to was were will with".split(),
    "de": "aber als am an auch auf aus bei das dem den der des die ein eine einer es für ist im in mit nicht oder sich und von zu".split(),
    "fr": "au aux avec ce ces dans de des du elle en est et il la le les leur ne par pas pour qui que sur un une".split(),
    "es": "al con de del el en es la las los para por que se su un una y".split(),
}


def simple_keywords(text: Column | str) -> Column:
    """KEY1: lowercase, commas to spaces, whitespace split, keep length > 3, distinct (sorted)."""
    low = F.replace(F.lower(F.coalesce(as_col(text), F.lit(""))), F.lit(","), F.lit(" "))
    return F.sort_array(F.array_distinct(F.filter(whitespace_split(low), lambda t: F.length(t) > 3)))


def all_stopwords() -> list[str]:
    return sorted({w for ws in DEFAULT_STOPWORDS.values() for w in ws})


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once: a lambda variable is never copied into its uses."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _capitals(tok: Column, t_pos: Column) -> tuple[Column, Column]:
    """Whether a token is capitalised within its sentence, and whether it is an acronym."""
    return (F.substring(tok, 1, 1).rlike(r"\p{Lu}") & (t_pos > 0),
            (tok == F.upper(tok)) & (tok != F.lower(tok)) & (F.length(tok) > 1))


def _lang(lang_col: str | None) -> Column:
    return F.coalesce(F.col(lang_col), F.lit("")) if lang_col else F.lit("")


def _is_stop(term: Column, lang: Column, stop: list[str], by_lang: bool) -> Column:
    if by_lang:
        # (language, word) pairs as one literal hash set: a per-row lookup, no join.
        pairs = sorted(f"{lg}|{w}" for lg, ws in DEFAULT_STOPWORDS.items() for w in ws)
        return F.concat(lang, F.lit("|"), term).isin(*pairs)
    return term.isin(*stop) if stop else F.lit(False)


def _occurrences(sentences: Column, lang: Column, stop: list[str], by_lang: bool) -> Column:
    """The candidate occurrences in the tokens of every sentence: (term, s_idx, left, right, up, ac)."""
    def of_token(toks: Column, tok: Column, s: Column, t: Column) -> Column:
        up, ac = _capitals(tok, t)
        return F.struct(
            F.lower(tok).alias("term"), s.alias("s_idx"), F.lower(F.get(toks, t - 1)).alias("left"),
            F.lower(F.get(toks, t + 1)).alias("right"), up.alias("up"), ac.alias("ac"))

    every = F.flatten(F.transform(sentences, lambda toks, s: F.transform(toks, lambda tok, t: of_token(toks, tok, s, t))))
    return F.filter(every, lambda o: ~_is_stop(o["term"], lang, stop, by_lang))


def _term_counts(occurrences: Column) -> Column:
    """The counts of every term of a text, from its sorted occurrences: an array of structs."""
    def of_term(g: Column) -> Column:
        left, right, n = F.array_compact(g["left"]), F.array_compact(g["right"]), F.size(g)
        yes = lambda flags: F.size(F.filter(flags, lambda x: x)).cast("long")
        many = lambda xs: F.size(xs).cast("long")
        return F.struct(
            F.get(g, F.lit(0))["term"].alias("term"), many(g).alias("tf"), yes(g["up"]).alias("tf_upper"),
            yes(g["ac"]).alias("tf_acronym"), many(F.array_distinct(g["s_idx"])).alias("sf"),
            F.get(g, F.floor((n - 1) / 2).cast("int"))["s_idx"].alias("lo"),
            F.get(g, F.floor(n / 2).cast("int"))["s_idx"].alias("hi"),
            many(left).alias("left_n"), many(F.array_distinct(left)).alias("left_d"),
            many(right).alias("right_n"), many(F.array_distinct(right)).alias("right_d"))

    def within(o: Column, first: Column, last: Column) -> Column:
        return F.transform(F.sequence(first, last), lambda i: F.get(o, i))  # ``slice`` copies the whole array each time

    def of_sorted(o: Column) -> Column:
        first = F.array_compact(F.transform(o, lambda x, i: F.when((i == 0) | (x["term"] != F.get(o, i - 1)["term"]), i)))
        return _let(first, lambda at: F.transform(
            at, lambda p, k: _let(within(o, p, F.coalesce(F.get(at, k + 1), F.size(o)) - 1), of_term)))

    return _let(F.sort_array(occurrences), of_sorted)


def _h(f, mean_tf: Column, std_tf: Column, max_tf: Column, n_sent: Column, let=_let) -> Column:
    """``H`` of a term; ``f`` gives its counts by name."""
    dl = F.when(f("left_n") > 0, f("left_d") / f("left_n")).otherwise(F.lit(0.0))
    dr = F.when(f("right_n") > 0, f("right_d") / f("right_n")).otherwise(F.lit(0.0))
    tf = f("tf").cast("double")
    case = F.greatest(f("tf_upper"), f("tf_acronym")) / (F.lit(1.0) + F.log(tf))
    pos = F.log(F.log(F.lit(3.0) + (f("lo") + f("hi")) / F.lit(2.0)))
    norm = tf / (mean_tf + std_tf)
    spread = f("sf") / n_sent
    return let(F.lit(1.0) + (dl + dr) * tf / max_tf, lambda rel: rel * pos / (case + norm / rel + spread / rel))


def _score(h: Column, tf: Column) -> Column:
    return h / (tf.cast("double") * (F.lit(1.0) + h))


def _top_terms(counts: Column, n_sent: Column, top_k: int) -> Column:
    """The ``top_k`` best terms of a text from the counts of its terms."""
    def of_counts(c: Column) -> Column:
        tfs = F.transform(c["tf"], lambda x: x.cast("double"))
        total = lambda xs: F.aggregate(xs, F.lit(0.0), lambda a, x: a + x)
        mean = lambda xs: total(xs) / F.greatest(F.size(xs), F.lit(1))
        return _let(mean(tfs), lambda m: _let(
            F.struct(F.sqrt(mean(F.transform(tfs, lambda x: (x - m) * (x - m)))).alias("std"), F.array_max(tfs).alias("max")),
            lambda d: F.transform(c, lambda f: F.struct(
                _let(_h(lambda k: f[k], m, d["std"], d["max"], n_sent), lambda h: _score(h, f["tf"])).alias("score"),
                f["term"].alias("term")))))

    return F.slice(F.sort_array(_let(counts, of_counts)), 1, top_k)["term"]


def row_keywords(text: Column | str, top_k: int, stop: list[str], lang: Column, by_lang: bool) -> Column:
    """The ``top_k`` best terms of one row's text, best first, by array work alone: no state beyond the row."""
    sentences = F.transform(
        F.split(F.coalesce(as_col(text), F.lit("")), SENTENCE_SPLIT), lambda x: F.regexp_extract_all(x, F.lit(TOKEN_PATTERN), 0))

    def of_sentences(s: Column) -> Column:
        return _top_terms(_term_counts(_occurrences(s, lang, stop, by_lang)), F.size(F.filter(s, lambda x: F.size(x) > 0)), top_k)

    return _let(sentences, of_sentences)


def keyword_features(
    df: DataFrame, *, id_col: str = "id", text: Column | str = "content", stopwords: list[str] | None = None,
    lang_col: str | None = None,
) -> DataFrame:
    """Per (doc, term) features and the doc-level statistics, with the ranking score.

    With ``lang_col`` (e.g. the output of language identification) each document drops
    the stopwords of its own language; otherwise the union of all lists is used.
    """
    stop = all_stopwords() if stopwords is None else stopwords
    t = F.coalesce(as_col(text), F.lit(""))
    # Sentences holding at least one token, counted per document without a join.
    n_sent = F.size(F.filter(F.split(t, SENTENCE_SPLIT), lambda x: x.rlike(TOKEN_CHAR)))
    lang = _lang(lang_col)
    src = df.select(F.col(id_col).alias("_id"), t.alias("_t"), n_sent.alias("n_sent"), lang.alias("_lang"))
    sents = explode_with_pos(src, ["_id", "n_sent", "_lang"], F.split(F.col("_t"), SENTENCE_SPLIT), "s_idx", "sentence")
    toks = sents.select(
        "_id", "n_sent", "_lang", "s_idx", F.regexp_extract_all("sentence", F.lit(TOKEN_PATTERN), 0).alias("toks")
    )
    n = F.greatest(F.size("toks"), F.lit(1))  # sentences without tokens explode to nothing
    null_arr = F.array(F.lit(None).cast("string"))
    zipped = F.arrays_zip(
        F.col("toks").alias("tok"),
        F.concat(null_arr, F.slice("toks", 1, n - 1)).alias("left"),
        F.concat(F.slice("toks", 2, n - 1), null_arr).alias("right"),
    )
    occ = explode_with_pos(toks, ["_id", "n_sent", "_lang", "s_idx"], zipped, "t_pos", "o").select(
        "_id", "n_sent", "_lang", "s_idx", "t_pos", F.col("o.tok").alias("tok"), F.lower("o.tok").alias("term"),
        F.lower("o.left").alias("left"), F.lower("o.right").alias("right"),
    )
    cand = occ.filter(~_is_stop(F.col("term"), F.col("_lang"), stop, bool(lang_col) and stopwords is None))
    up, ac = _capitals(F.col("tok"), F.col("t_pos"))
    cand = cand.withColumn("up", up.cast("int")).withColumn("ac", ac.cast("int"))
    # An occurrence counts for its sentence, its left and its right neighbour: one row each, so that sentences and
    # distinct neighbours are what a first hash aggregate leaves, and a second one counts them.
    parts = F.expr(
        "stack(3, 0, s_idx, cast(null as string), up, ac, 1, cast(null as int), left, 0, 0, "
        "2, cast(null as int), right, 0, 0) as (part, s_idx, near, up, ac)")
    each = cand.select("_id", "n_sent", "term", parts).filter((F.col("part") == 0) | F.col("near").isNotNull())
    each = each.groupBy("_id", "n_sent", "term", "part", "s_idx", "near").agg(
        F.count(F.lit(1)).alias("c"), F.sum("up").alias("up"), F.sum("ac").alias("ac"))
    # Exact median of the sentence index by weighted selection: the sentence in which the running count reaches it.
    same = Window.partitionBy("_id", "n_sent", "term", "part")
    upto = same.orderBy("s_idx").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    each = each.withColumn("n", F.sum("c").over(same)).withColumn("upto", F.sum("c").over(upto))

    def reached(place: Column) -> Column:
        here = (F.col("part") == 0) & (F.col("upto") >= place) & (F.col("upto") - F.col("c") < place)
        return F.max(F.when(here, F.col("s_idx")))

    def of(part: int, value: Column) -> Column:
        return F.sum(F.when(F.col("part") == part, value).otherwise(0))

    one = F.lit(1)
    feats = each.groupBy("_id", "n_sent", "term").agg(
        of(0, F.col("c")).alias("tf"), F.sum("up").alias("tf_upper"), F.sum("ac").alias("tf_acronym"), of(0, one).alias("sf"),
        reached(F.floor((F.col("n") + 1) / 2)).alias("lo"), reached(F.floor(F.col("n") / 2) + 1).alias("hi"),
        of(1, F.col("c")).alias("left_n"), of(1, one).alias("left_d"), of(2, F.col("c")).alias("right_n"), of(2, one).alias("right_d"),
    )
    w = Window.partitionBy("_id")
    feats = (
        feats.withColumn("mean_tf", F.avg("tf").over(w))
        .withColumn("std_tf", F.stddev_pop("tf").over(w))
        .withColumn("max_tf", F.max("tf").over(w))
    )
    h = _h(F.col, F.col("mean_tf"), F.col("std_tf"), F.col("max_tf"), F.col("n_sent"), lambda value, use: use(value))
    return feats.withColumn("h", h).withColumn("score", _score(F.col("h"), F.col("tf")))


def _merged_keywords(
    df: DataFrame, id_col: str, text: Column | str, top_k: int, stopwords: list[str] | None, lang_col: str | None,
) -> DataFrame:
    """``ranked_keywords`` by aggregates over all occurrences of an id, however many rows share it."""
    feats = keyword_features(df, id_col=id_col, text=text, stopwords=stopwords, lang_col=lang_col)
    w = Window.partitionBy("_id").orderBy(F.col("score").asc(), F.col("term").asc())
    top = feats.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= top_k)
    # One aggregate a rank over rows that the window left sorted by document: nothing is collected.
    ranks = [F.max(F.when(F.col("rank") == i, F.col("term"))) for i in range(1, top_k + 1)]
    per_doc = top.groupBy("_id").agg(F.array_compact(F.array(*ranks)).alias("keywords"))
    return per_doc.withColumnRenamed("_id", id_col)


def _split_by_id(df: DataFrame, id_col: str) -> tuple[DataFrame, DataFrame | None]:
    """The rows whose id no other row has, and the others (None if there are none)."""
    again = materialize(
        df.groupBy(F.col(id_col).alias("_rid")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("_rid"), "repeated-ids")
    seen = again.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(F.col("_rid").cast("string")) + 16).alias("size")).first()
    if not seen["n"]:
        return df, None
    side = F.broadcast(again) if 4 * (seen["size"] or 0) <= BROADCAST_BYTES else again
    same = F.col(id_col).eqNullSafe(F.col("_rid"))
    return df.join(side, same, "left_anti"), df.join(side, same, "left_semi")


def ranked_keywords(
    df: DataFrame, *, id_col: str = "id", text: Column | str = "content", top_k: int = 10,
    stopwords: list[str] | None = None, lang_col: str | None = None,
) -> DataFrame:
    """``(id, keywords)``: the ``top_k`` best terms per document, best first (TOP1), of documents with any."""
    stop = all_stopwords() if stopwords is None else stopwords
    once, again = _split_by_id(df, id_col)
    own = row_keywords(text, top_k, stop, _lang(lang_col), bool(lang_col) and stopwords is None)
    found = once.select(id_col, own.alias("keywords")).where(F.size("keywords") > 0)
    return found if again is None else found.unionByName(_merged_keywords(again, id_col, text, top_k, stopwords, lang_col))


def with_ranked_keywords(
    df: DataFrame, *, id_col: str = "id", text: Column | str = "content", top_k: int = 10, lang_col: str | None = None,
) -> DataFrame:
    """Add ``keywords`` (``[]`` for empty text); rows that share an id have those of all of them, a NULL id has none."""
    none = F.array().cast("array<string>")
    once, again = _split_by_id(df, id_col)
    own = row_keywords(text, top_k, all_stopwords(), _lang(lang_col), bool(lang_col))
    rows = once.withColumn("keywords", F.when(F.col(id_col).isNotNull(), own).otherwise(none))
    if again is None:
        return rows
    kw = _merged_keywords(again, id_col, text, top_k, None, lang_col)
    return rows.unionByName(again.join(kw, id_col, "left").withColumn("keywords", F.coalesce(F.col("keywords"), none)).select(rows.columns))


__all__ = ["DEFAULT_STOPWORDS", "keyword_features", "ranked_keywords", "simple_keywords", "with_ranked_keywords"]
