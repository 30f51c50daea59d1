"""Quality rules: plain features of a text, and a hashed n-gram log-likelihood ratio.

The n-grams of a text are its words, and the pairs of a word's head and tail and of a word's
tail and the next word's head (two characters each), so that rare words count by their shape.
They are hashed into buckets. A trusted-target multinomial (documents labelled good) and a
raw-corpus multinomial (all documents) give each bucket the log of its likelihood ratio; a
document's score is the mean over its n-grams, so its length does not matter. Every document
is held against one threshold, a low quantile of the scores of good documents that the target
was not fitted on.

A few toxic words in a long text hardly move a mean. So words that mark documents labelled
toxic, by the log of their ratio of document shares to the good ones, fail a text as well; the
ratio from which a word counts is set by toxic and good documents held back from these counts.
"""

from __future__ import annotations

import math
import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickforge.llm.common import SEPARATORS, let, materialise, saved

#: Words of a window, and the windows' share of all words (in percent) that fails a text.
WINDOW, MOST_REPEATED, LEAST_WORDS = 5, 20, 10
BUCKETS = 1 << 16
#: What separates words.
BLANKS = " \t\n\x0b\x0c\r"
#: One in so many labelled documents is held back from the fit, for the threshold and the cut.
HELD_OUT = 4
#: Toxic documents that hold a marker and its log ratio, at least; and how many times the share
#: of good documents lost counts against that of toxic ones caught.
MARKER_DOCS, MARKER_RATIO, GOOD_COST = 4, 3.0, 5.0


def _words(text: Column) -> Column:
    """Words of a text in order; null and blank texts have none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SEPARATORS), "")


def _hashed(rows: DataFrame, text: Column) -> DataFrame:
    """Adds ``w``, the words, and the hashes of them (``h``), their heads and their tails."""
    rows = materialise(rows, "w", _words(text))
    for name, part in (("h", lambda w: w), ("head", _head), ("tail", _tail)):
        rows = materialise(rows, name, F.transform("w", lambda w: F.xxhash64(part(w))))
    return rows


def _head(word: Column) -> Column:
    return F.substring(word, 1, 2)


def _tail(word: Column) -> Column:
    return F.substring(word, -2, 2)


def _grams() -> list[Column]:
    """Arrays of the hashes of a text's n-grams, from the columns of :func:`_hashed`; empty
    arrays for a text without words."""
    across = F.transform(F.slice("tail", 1, F.greatest(F.size("tail") - 1, F.lit(0))),
                         lambda t, i: F.xxhash64(t, F.get("head", i + 1)))
    return [F.col("h"), across, F.transform("head", lambda x, i: F.xxhash64(x, F.get("tail", i), F.lit(1)))]


def _gram_rows(rows: DataFrame, text: Column, buckets: int) -> DataFrame:
    """The other columns and ``b``, the bucket, of every n-gram: the n-grams of :func:`_grams`,
    a row each, from generated code alone."""
    rows = materialise(rows, "w", _words(text)).select(
        "*", F.explode(F.arrays_zip(F.col("w").alias("w"), F.slice("w", 2, F.greatest(F.size("w"), F.lit(1))).alias("n"))).alias("z"))
    head, tail = F.xxhash64(_head(F.col("z.w"))), F.xxhash64(_tail(F.col("z.w")))
    after = F.xxhash64(_head(F.col("z.n")))
    across = F.when(F.col("z.n").isNotNull(), F.xxhash64(tail, after))
    rows = rows.select("*", F.explode(F.array(F.xxhash64("z.w"), across, F.xxhash64(head, tail, F.lit(1)))).alias("x"))
    return rows.where("x is not null").withColumn("b", F.pmod("x", F.lit(buckets))).drop("w", "z", "x")


def windows(hashes: Column, n: int = WINDOW) -> Column:
    """Hashes of a text's ``n``-word windows in order, from the hashes of its words (a column)."""
    whole = F.slice(hashes, 1, F.greatest(F.size(hashes) - n + 1, F.lit(0)))
    return F.transform(whole, lambda x, i: F.xxhash64(x, *[F.get(hashes, i + j) for j in range(1, n)]))


def repeated_words(g: Column, n: int = WINDOW) -> Column:
    """Words in ``n``-word windows that occur twice or more, the first included, from the
    windows' hashes (a column). Windows are sorted with their places, so a text
    of many repeats costs no more than its sorting."""
    def covered(at: Column) -> Column:  # places of repeated windows, ascending
        return F.aggregate(F.sequence(F.lit(0), F.size(at) - 1), F.lit(0), lambda done, k: done + F.least(
            F.lit(n), F.coalesce(F.get(at, k + 1) - F.get(at, k), F.lit(n))))

    def places(placed: Column) -> Column:  # sorted (window, place)
        return F.sort_array(F.transform(F.filter(placed, lambda x, k: (
            x["g"] == F.get(placed, k + 1)["g"]) | ((k > 0) & (
                x["g"] == F.get(placed, F.greatest(k - 1, F.lit(0)))["g"]))), lambda x: x["i"]))

    return F.when(F.size(F.array_distinct(g)) == F.size(g), 0).otherwise(
        let(F.sort_array(F.arrays_zip(g.alias("g"), F.sequence(F.lit(0), F.size(g) - 1).alias("i"))),
            lambda placed: let(places(placed), covered)))


def features(text: Column) -> list[Column]:
    """Base features of a text, with its words and its windows in columns ``w`` and ``g``."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"),
                     lambda x: F.ltrim(x, F.lit(BLANKS)) != "")
    marks = F.regexp_replace(F.coalesce(text, F.lit("")), r"[^#*$%&|<>]+", "")
    return [F.size("w").cast("long").alias("n_words"),
            F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
            F.length(marks).cast("long").alias("n_symbols"),
            let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
            repeated_words(F.col("g")).cast("long").alias("n_repeat_words")]


def trusted_ids(labels: DataFrame, id_col: str, sample: int | None = None) -> DataFrame:
    """Ids that are labelled good (quality 1, not toxic) throughout, written once; all of them,
    unless a caller bounds them by ``sample``. One in ``HELD_OUT`` is ``held`` back from the
    fit, for the threshold."""
    good = labels.where(F.col(id_col).isNotNull()).groupBy(id_col).agg(
        F.min(F.coalesce("quality", F.lit(0))).alias("q"), F.max(F.coalesce("toxic", F.lit(1))).alias("t"))
    return _held_back(good.where("q = 1 and t = 0"), id_col, sample, "trusted")


def toxic_ids(labels: DataFrame, id_col: str, sample: int | None = None) -> DataFrame:
    """Ids that are labelled toxic anywhere, as :func:`trusted_ids` has the good ones."""
    toxic = labels.where(F.col(id_col).isNotNull() & (F.col("toxic") == 1)).select(id_col).distinct()
    return _held_back(toxic, id_col, sample, "toxic")


def _held_back(ids: DataFrame, id_col: str, sample: int | None, label: str) -> DataFrame:
    if sample is not None:
        ids = ids.orderBy(F.xxhash64(id_col), id_col).limit(sample)
    held = F.pmod(F.xxhash64(id_col, F.lit(1)), F.lit(HELD_OUT)) == 0
    return saved(ids.select(id_col, held.alias("held")), label)


def fit_counts(docs: DataFrame, sides: DataFrame, id_col: str, text_col: str, buckets: int) -> DataFrame:
    """Counts of one join of all documents with the labelled ids ``sides`` (``held``, ``toxic``).

    Rows that are not ``of_words``: ``key``, a bucket, with the n-grams of all documents (``n``)
    and of the good ones of the fit (``good``). Rows that are: ``key``, a word's hash, with the
    toxic (``n``) and the good documents of the fit that hold it, if ``MARKER_DOCS`` toxic ones do.
    """
    marked = docs.select(id_col, F.col(text_col).cast("string").alias("text"))
    marked = marked.join(sides.hint("shuffle_hash"), id_col, "left")  # one row an id: no text is sorted
    # generated, so that no filter on it goes below the join: both counts share its shuffle
    marked = materialise(marked, "toxic_fit", F.when(~F.col("held"), F.col("toxic"))).select("text", "toxic_fit")
    good = F.count_if(~F.col("toxic_fit")).alias("good")
    grams = _gram_rows(marked, F.col("text"), buckets).groupBy(F.col("b").alias("key")).agg(
        F.count("*").alias("n"), good)
    held = marked.where("toxic_fit is not null").select("toxic_fit", F.explode(F.array_distinct(
        F.transform(_words(F.col("text")), lambda w: F.xxhash64(w)))).alias("key"))
    held = held.groupBy("key").agg(F.count_if("toxic_fit").alias("n"), good).where(F.col("n") >= MARKER_DOCS)
    return saved(grams.withColumn("of_words", F.lit(False)).unionAll(
        held.withColumn("of_words", F.lit(True))), "fit-counts")


def gram_weights(counts: DataFrame, buckets: int = BUCKETS, prior: float = 4.0) -> Column:
    """One array, by bucket: log-likelihood ratio of target to raw by bucket, from
    :func:`fit_counts`. The target is smoothed towards the raw counts by ``prior`` n-grams a
    bucket. Without trusted documents all weights are zero."""
    counts = counts.where("not of_words").select(F.col("key").alias("b"), F.col("n").alias("raw"),
                                                 F.col("good").alias("target"))
    every = counts.sparkSession.range(buckets).withColumnRenamed("id", "b").join(counts, "b", "left")
    counts = saved(every.fillna(0, ["raw", "target"]), "gram-counts")
    totals = counts.agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).first()
    p = (F.col("raw") + 1) / F.lit(float(totals["raw"] + buckets))
    mass = prior * buckets
    weight = F.log((F.col("target") + mass * p) / (totals["target"] + mass)) - F.log(p)
    if not totals["target"]:
        weight = F.lit(0.0)
    return _by_bucket(counts.select("b", weight.alias("x")), "DOUBLE", "weights")


def _by_bucket(rows: DataFrame, kind: str, label: str) -> Column:
    """``x`` of each bucket ``b`` as one array in place."""
    listed = F.array_sort(F.collect_list(F.struct("b", "x")))  # `buckets` of them
    return _in_place(saved(rows.agg(F.transform(listed, lambda s: s["x"]).alias("weights")), label), kind)


def _in_place(weights: DataFrame, kind: str) -> Column:
    """The one array of ``weights`` as a session variable: a constant of the plan, which tasks
    read in place. As a column it would be copied into every row."""
    spark, name = weights.sparkSession, f"weights_{uuid.uuid4().hex}"
    spark.sql(f"DECLARE VARIABLE {name} ARRAY<{kind}>")
    spark.sql(f"SET VARIABLE {name} = (SELECT weights FROM {{rows}})", rows=weights)
    return F.expr(f"system.session.{name}")


def _score(weights: Column, buckets: int) -> Column:
    """Mean weight of a text's n-grams, from the columns of :func:`_hashed`."""
    def total(table):
        return sum([F.aggregate(grams, F.lit(0.0), lambda done, x: done + F.get(
            table, F.pmod(x, F.lit(buckets)).cast("int"))) for grams in _grams()], F.lit(0.0))

    return F.coalesce(F.try_divide(let(weights, total), F.greatest(3 * F.size("w") - 1, F.lit(0))), F.lit(0.0))


def _quantile(scores: DataFrame, quantile: float) -> float | None:
    """The exact ``quantile`` of ``score``, between neighbours if need be; None of no rows. Steps
    of a thousandth are counted, and only the steps that hold the two neighbours are sorted."""
    step = F.floor(F.col("score") * 1000)
    steps = [tuple(r) for r in scores.groupBy(step).count().collect()]  # a score is a mean of logs
    n = sum(c for _, c in steps)
    if not n:
        return None
    at = quantile * (n - 1)
    low, high = math.floor(at), math.ceil(at)
    ends, before, done = [], 0, 0
    for k, c in sorted(steps):
        if not ends and done + c > low:
            ends, before = [k], done
        if ends and done + c > high:
            ends.append(k)
            break
        done += c
    near = scores.where(step.between(*ends)).orderBy("score").offset(low - before).limit(high - low + 1)
    found = sorted(r["score"] for r in near.select("score").collect())
    return found[0] + (at - low) * (found[-1] - found[0])


def _marker_cut(best: list[tuple], n_toxic: int, n_good: int) -> float:
    """The least ratio with the most toxic documents caught, less ``GOOD_COST`` times the good
    ones lost (shares), from the largest ratios ``best`` of held-out documents: whether toxic,
    the ratio, and the number of such documents if not one."""
    worth = sorted((ratio, sum(many, 0) or 1, toxic) for toxic, ratio, *many in best)
    worth = [(ratio, n / n_toxic if toxic else -n * GOOD_COST / n_good) for ratio, n, toxic in worth]
    caught = sum(x for _, x in worth)
    cut, most = MARKER_RATIO, caught
    for i, (ratio, x) in enumerate(worth):
        caught -= x
        ends = i + 1 == len(worth) or worth[i + 1][0] > ratio
        if ends and caught > most + 1e-9:
            cut, most = math.nextafter(ratio, math.inf), caught
    return cut


def toxic_markers(counts: DataFrame, n_toxic: int, n_good: int, buckets: int) -> Column:
    """One array, by bucket of the hash: the words that may mark toxic documents (``h``) with their
    log ratio of shares of the ``n_toxic`` and ``n_good`` documents of the fit; null for none."""
    ratio = F.log((F.col("n") + 0.5) / (n_toxic + 1) * (n_good + 1) / (F.col("good") + 0.5))
    marks = counts.where("of_words").select(F.col("key").alias("h"), ratio.alias("ratio")) \
        .where(F.col("ratio") >= MARKER_RATIO)
    marks = marks.groupBy(F.pmod("h", F.lit(buckets)).alias("b")).agg(F.collect_list(F.struct("h", "ratio")).alias("x"))
    every = marks.sparkSession.range(buckets).withColumnRenamed("id", "b").join(marks, "b", "left")
    return _by_bucket(every, "ARRAY<STRUCT<h: BIGINT, ratio: DOUBLE>>", "markers")


def _marker_ratio(marks: Column, buckets: int) -> Column:
    """The largest ratio of a text's words in ``marks``, from ``h``; null for none."""
    def here(x):
        return F.get(marks, F.pmod(x, F.lit(buckets)).cast("int"))

    met = F.filter("h", lambda x: here(x).isNotNull())
    return F.array_max(F.flatten(F.transform(met, lambda x: F.transform(
        F.filter(here(x), lambda s: s["h"] == x), lambda s: s["ratio"]))))


def _judged(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, threshold: float | None,
            buckets: int, quantile: float, whole: bool) -> DataFrame:
    """``id``, ``row`` (all columns of ``docs``) if ``whole``, the features, ``score``, ``base_failed``
    and ``kept``. Scores and marker ratios of all documents are written once, and the held-out
    ones among them then set what both are held against."""
    sides = trusted_ids(labels, id_col).withColumn("toxic", F.lit(False)).unionAll(
        toxic_ids(labels, id_col).withColumn("toxic", F.lit(True)))
    counts = fit_counts(docs, sides, id_col, text_col, buckets)
    n = {(r["held"], r["toxic"]): r["count"]
         for r in docs.select(id_col).join(sides, id_col).groupBy("held", "toxic").count().collect()}
    weights = gram_weights(counts, buckets)
    marks = toxic_markers(counts, n.get((False, True), 0), n.get((False, False), 0), buckets)
    text = F.col("row")[text_col].cast("string")
    rows = _hashed(docs.select(F.struct("*").alias("row")), text)
    rows = materialise(rows, "g", windows(F.col("h")))
    judged = rows.select(F.col("row")[id_col].alias("id"), *["row"] * whole, *features(text),
                         _score(weights, buckets).alias("score"), _marker_ratio(marks, buckets).alias("ratio"))
    failed = (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    judged = saved(judged.withColumn("base_failed", failed), "scored")
    held = saved(judged.select("id", "n_words", "score", "ratio").join(
        sides.where("held").withColumnRenamed(id_col, "id"), "id"), "held-out")
    if threshold is None:
        threshold = _quantile(held.where(~F.col("toxic") & (F.col("n_words") >= LEAST_WORDS)), quantile)
    best = held.where("ratio is not null").groupBy("toxic", "ratio").count().collect()  # as many as ratios
    cut = _marker_cut([tuple(r) for r in best], n.get((True, True), 1), n.get((True, False), 1))
    return judged.withColumn("kept", ~failed & (F.col("score") >= (-0.1 if threshold is None else threshold))
                             & F.coalesce(F.col("ratio") < cut, F.lit(True)))


def judge_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  threshold: float | None = None, buckets: int = BUCKETS,
                  quantile: float = 0.005) -> DataFrame:
    """``id_col``, the base features, ``score``, ``base_failed`` and ``kept`` of every row.

    ``labels`` has ``id_col``, ``quality`` and ``toxic``; null labels count as bad. A null
    text has no words. A text without words scores 0 and fails by its base. Rows with null
    or repeated ids are judged like any other. Other columns are ignored. The counts cover
    all documents; the target, the threshold and the markers rest on all labelled ones. A
    ``threshold`` may be given instead of the quantile.
    """
    own = docs.select(id_col, text_col)
    return _judged(own, labels, id_col, text_col, threshold, buckets, quantile, False).select(
        F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines",
        "n_repeat_words", "score", "base_failed", "kept")


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              threshold: float | None = None, buckets: int = BUCKETS,
              quantile: float = 0.005) -> DataFrame:
    """The rows that :func:`judge_quality` keeps, with all their columns."""
    return _judged(docs, labels, id_col, text_col, threshold, buckets, quantile, True) \
        .where("kept").select("row.*")
