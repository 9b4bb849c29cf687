"""Quality rules: counts per text, then robust multivariate outliers.

Everything is Spark SQL expressions. Word counts come first and reject what has
fewer than 50 words or repeats itself; the rest is judged by a vector of
transformed statistics (``VECTOR``): word length, symbols, capitals and marks
on a log scale, shares of repeated lines and repeated words.

For each language and source the minimum-covariance-determinant estimate of
centre and scatter is found by concentration steps: start from medians and
absolute deviations, keep the nearest three quarters of the texts, take their
mean and covariance, measure Mahalanobis distances, repeat; then scale the
distances to their median and take the estimate once more from all texts within
the 97.5 % ellipse. A text is rejected when its squared distance exceeds
``CUTOFF``. Groups of fewer than ``SMALL`` texts, or fewer than ``DISTINCT``
different vectors, use the estimate of their language, and those of all texts
where even that is small. All texts together are an estimate only with ``FEWEST``
texts and ``DISTINCT`` vectors: five dimensions cannot be told from fewer. Where
there is none, the distance is null and no text is an outlier.

Quantiles of distances inside a group are Spark's approximate ones (accuracy
10,000), so the kept three quarters hold 75 % give or take 0.01 %.

Defined results: a null text counts as empty, has no words and fails; null
language and source are groups of their own. Where a statistic has less spread in
a group than ``FLOORS`` (beyond what those before it tell), it has that; other
spreads stay as they are. An empty table gives an empty
result. Equal texts of one group get equal verdicts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.llm import common

WHITE = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
SMALL = 100
FEWEST, DISTINCT = 50, 20  # texts and different vectors that an estimate takes at least
STEPS = 3
NEAREST = 0.75
# Quantiles of the chi-squared distribution with five degrees of freedom.
MEDIAN_5, ELLIPSE_5 = 4.351, 12.833
CUTOFF = 30.856  # 99.999 %
VECTOR = ("x1", "x2", "x3", "x4", "x5")
# Least standard deviation of each.
FLOORS = (0.06, 0.25, 0.20, 0.08, 0.08)
PAIRS = [(i, j) for i in range(5) for j in range(i + 1)]


def _let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once per row."""
    return F.transform(F.array(value), use)[0]


def _removed(text: Column, characters: str) -> Column:
    """How many of the characters the text has."""
    return F.char_length(text) - F.char_length(F.translate(text, characters, ""))


def _repeat_words(words: Column) -> Column:
    """Words inside three-word windows that the text has twice or more."""
    hashes = F.transform(
        F.slice(words, 1, F.greatest(F.size(words) - 2, F.lit(0))),
        lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)),
    )

    def covered(found: Column) -> Column:
        pairs = F.sort_array(F.transform(found, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def repeated(ordered: Column) -> Column:
            def same(p: Column, k: Column) -> Column:
                return F.coalesce(p["h"] == F.get(ordered, k)["h"], F.lit(False))

            return F.filter(ordered, lambda p, k: same(p, k - 1) | same(p, k + 1))

        places = F.sort_array(F.transform(_let(pairs, repeated), lambda p: p["i"]))
        return F.aggregate(
            places,
            F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")),
            lambda a, p: F.struct((p + 3).alias("end"), (a["n"] + 3 - F.greatest(a["end"] - p, F.lit(0))).alias("n")),
            lambda a: a["n"],
        )

    return _let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(covered(h)))


def statistics(text: str = "text") -> Column:
    """Counts of one text as a struct of longs."""
    whole = common.text_of(text)
    trimmed = F.trim(whole, F.lit(WHITE))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+"))
    lines = F.filter(F.split(whole, "\n"), lambda line: F.trim(line, F.lit(WHITE)) != "")
    counts = {
        "n_words": lambda w: F.size(w),
        "n_repeat_words": _repeat_words,
    }
    of_words = _let(words, lambda w: F.struct(*[make(w).cast("long").alias(name) for name, make in counts.items()]))
    of_lines = _let(lines, lambda x: F.struct(F.size(x).cast("long").alias("all"), F.size(F.array_distinct(x)).cast("long").alias("own")))
    return F.struct(
        of_words["n_words"].alias("n_words"),
        (F.char_length(whole) - _removed(whole, WHITE)).cast("long").alias("word_chars"),
        _removed(whole, SYMBOLS).cast("long").alias("n_symbols"),
        (of_lines["all"] - of_lines["own"]).alias("n_dup_lines"),
        of_words["n_repeat_words"].alias("n_repeat_words"),
        of_lines["all"].alias("n_lines"),
        _removed(whole, "ABCDEFGHIJKLMNOPQRSTUVWXYZ!?").cast("long").alias("n_capitals"),
    )


def with_statistics(frame: DataFrame, name: str, text: str = "text") -> DataFrame:
    """The frame with the struct of counts as a column that Spark computes once, however often it is read."""
    # A projection shares the parts of the struct, and nothing is moved through the explode behind it.
    made = common.fresh(frame, f"{name}_made")
    return frame.withColumn(made, statistics(text)).select("*", F.explode(F.array(made)).alias(name)).drop(made)


def base_failed(counts: str) -> Column:
    words = F.col(f"{counts}.n_words")
    return (words < 50) | (100 * F.col(f"{counts}.n_repeat_words") > 50 * words)


def vector(counts: str) -> list[Column]:
    """The transformed statistics; smoothed, so that short texts stay near the middle."""
    c = {name: F.col(f"{counts}.{name}") for name in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals")}
    return [
        F.log((c["word_chars"] + 20.0) / (c["n_words"] + 4.0)),
        F.log((c["n_symbols"] + 1.0) / (c["n_words"] + 20.0)),
        F.log((c["n_capitals"] + 10.0) / (c["word_chars"] + 300.0)),
        c["n_dup_lines"] / (c["n_lines"] + 5.0),
        c["n_repeat_words"] / (c["n_words"] + 20.0),
    ]


def _measured(joined: DataFrame, columns: list[str]) -> DataFrame:
    """Squared Mahalanobis distance ``d2`` by the estimate in the row."""
    solved: list[Column] = []
    for i in range(5):
        rest = F.col(VECTOR[i]) - F.col(f"m{i}")
        for j in range(i):
            rest = rest - F.col(f"l{i}{j}") * F.col(f"z{j}")
        joined = joined.withColumn(f"z{i}", rest / F.col(f"l{i}{i}"))
        solved.append(F.col(f"z{i}") * F.col(f"z{i}"))
    return joined.withColumn("d2", sum(solved[1:], solved[0])).select(*columns, "d2")


def _distance(rows: DataFrame, estimates: DataFrame) -> DataFrame:
    return _measured(rows.join(estimates, ["g"]), rows.columns)


def _cholesky(moments: DataFrame, scale: str | None = None) -> DataFrame:
    """Means m0..m4 and the lower triangle l00..l44 from means and covariances s00..s44."""
    out = moments
    for i, j in PAIRS:
        value = F.col(f"s{i}{j}")
        for k in range(j):
            value = value - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
        if i == j:
            value = F.sqrt(F.greatest(value, F.lit(FLOORS[i] ** 2)))
        else:
            value = value / F.col(f"l{j}{j}")
        out = out.withColumn(f"l{i}{j}", value)
    return out.select("g", *[f"m{i}" for i in range(5)], *[f"l{i}{j}" for i, j in PAIRS])


def _moments(rows: DataFrame) -> DataFrame:
    means = [F.avg(x).alias(f"m{i}") for i, x in enumerate(VECTOR)]
    scatter = [F.covar_pop(VECTOR[i], VECTOR[j]).alias(f"s{i}{j}") for i, j in PAIRS]
    return rows.groupBy("g").agg(*means, *scatter)


def _within(rows: DataFrame, bounds: DataFrame) -> DataFrame:
    return rows.join(bounds, ["g"]).where(F.col("d2") <= F.col("bound"))


def estimates(rows: DataFrame) -> DataFrame:
    """Centre and scatter of every group ``g`` of the vectors; one row per group."""
    medians = rows.groupBy("g").agg(*[F.percentile_approx(x, 0.5, 10000).alias(f"m{i}") for i, x in enumerate(VECTOR)])
    spread = (
        rows.join(medians, ["g"])
        .groupBy("g")
        .agg(
            *[F.first(f"m{i}").alias(f"m{i}") for i in range(5)],
            *[F.percentile_approx(F.abs(F.col(x) - F.col(f"m{i}")), 0.5, 10000).alias(f"a{i}") for i, x in enumerate(VECTOR)],
        )
    )
    start = [(F.pow(1.4826 * F.col(f"a{i}"), 2) if i == j else F.lit(0.0)).alias(f"s{i}{j}") for i, j in PAIRS]
    now = common.stored(_cholesky(spread.select("g", *[f"m{i}" for i in range(5)], *start)), "mcd")
    for step in range(STEPS + 1):
        measured = _distance(rows, now)
        cut = F.percentile_approx("d2", NEAREST, 10000)
        if step == STEPS:  # reweighting: distances on the scale of their median
            cut = F.percentile_approx("d2", 0.5, 10000) * (ELLIPSE_5 / MEDIAN_5)
        bounds = measured.groupBy("g").agg(cut.alias("bound"))
        now = common.stored(_cholesky(_moments(_within(measured, bounds))), "mcd")
    return now


def grouped(rows: DataFrame) -> DataFrame:
    """The group ``g`` of each vector: language and source, or wider where those are small; null where all are."""
    size, kinds = F.count("*").alias("n"), F.approx_count_distinct(F.xxhash64(*VECTOR)).alias("d")
    both = rows.groupBy("lang", "source").agg(size, kinds)
    wide = rows.groupBy(F.col("lang").alias("wl")).agg(F.count("*").alias("wn"), F.approx_count_distinct(F.xxhash64(*VECTOR)).alias("wd"))
    enough = rows.agg((F.count("*") >= FEWEST) & (F.approx_count_distinct(F.xxhash64(*VECTOR)) >= DISTINCT)).scalar()
    sizes = both.join(wide, both["lang"].eqNullSafe(wide["wl"]))
    name = (
        F.when((F.col("n") >= SMALL) & (F.col("d") >= DISTINCT), F.to_json(F.struct("lang", "source"), {"ignoreNullFields": "false"}))
        .when((F.col("wn") >= SMALL) & (F.col("wd") >= DISTINCT), F.to_json(F.struct("lang"), {"ignoreNullFields": "false"}))
        .when(enough, "all")
    )
    return sizes.select(F.col("lang").alias("gl"), F.col("source").alias("gs"), name.alias("g"))


def fit(vectors: DataFrame) -> DataFrame:
    """Estimates by language and source from stored (lang, source, x1..x5); columns gl, gs, g and the estimate.

    Every text also counts for the wider group that stands in for small ones.
    """
    names = common.stored(grouped(vectors), "groups")
    named = vectors.join(names, vectors["lang"].eqNullSafe(names["gl"]) & vectors["source"].eqNullSafe(names["gs"]))
    wide = F.to_json(F.struct("lang"), {"ignoreNullFields": "false"})
    used = names.select("g").distinct()
    levels = named.select(F.explode(F.array_distinct(F.array("g", wide, F.lit("all")))).alias("g"), *VECTOR).join(used, ["g"], "left_semi")
    # As a table it has a known size, so Spark broadcasts it only while it is small.
    return common.stored(names.join(estimates(levels), ["g"], "left"), "fitted")


def verdict(frame: DataFrame, counts: str, fitted: DataFrame, name: str = "d2") -> DataFrame:
    """The frame with the squared distance of each row; ``counts`` names its struct of statistics.

    The row travels as one struct, so its columns may have any names.
    """
    vectors = [v.alias(x) for x, v in zip(VECTOR, vector(counts), strict=True)]
    rows = frame.select(F.struct("*").alias("row"), F.col("lang").alias("rl"), F.col("source").alias("rs"), *vectors)
    own = fitted.drop("g")
    matched = rows.join(own, F.col("rl").eqNullSafe(own["gl"]) & F.col("rs").eqNullSafe(own["gs"]), "left")
    return _measured(matched, ["row"]).select("row.*", F.col("d2").alias(name))


def accepted(counts: str, distance: str = "d2") -> Column:
    return ~base_failed(counts) & (F.coalesce(F.col(distance), F.lit(0.0)) <= CUTOFF)


def vectors(frame: DataFrame, counts: str) -> DataFrame:
    """What the estimates are made from: texts that pass the first rules."""
    return frame.where(~base_failed(counts)).select("lang", "source", *[v.alias(x) for x, v in zip(VECTOR, vector(counts), strict=True)])


def op2_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Counts and the verdict for every document."""
    documents = common.table(spark, folder, "documents")
    counted = common.stored(documents.select("doc_id", "lang", "source", statistics("text").alias("c")), "quality")
    fitted = fit(common.stored(vectors(counted, "c"), "vectors"))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return verdict(counted, "c", fitted).select(
        "doc_id",
        *[F.col(f"c.{name}").alias(name) for name in names],
        base_failed("c").alias("base_failed"),
        accepted("c").alias("kept"),
        F.when(~base_failed("c"), F.col("d2")).alias("distance"),
    )
