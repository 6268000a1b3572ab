"""Quality rules: base limits, and robust outliers among statistic vectors.

Everything is a DataFrame expression. Vectors are integers of a thousandth, so
that all sums are exact and results don't depend on the order of rows.
"""

from __future__ import annotations

from collections.abc import Callable
from math import exp

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cedeflow.llm.storage import written

WHITE = " \t\n\x0b\x0c\r"
WINDOW = 5
SCALE = 1000
FEATURES = ("word_length", "symbol_share", "duplicate_lines", "repeated_words")
#: The least standard deviation of each feature, in thousandths.
FLOORS = (30, 25, 30, 25)
#: Share of a group that its estimate rests on.
CORE = 0.75
#: Share of clean normal rows beyond the cut-off.
TAIL = 1e-12
#: Rows that an estimate of a language, or language and source, needs.
MIN_GROUP = 100
#: The key of all rows; those of groups are JSON.
WHOLE = "all"
C_STEPS = 4
#: Estimates of up to so many groups are broadcast; beyond it Spark chooses.
BROADCAST_GROUPS = 5000


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)``, with the value computed once a row."""
    return F.transform(F.array(value), body)[0]


def _repeated_words(words: Column) -> Column:
    """Words inside windows of ``WINDOW`` words that occur twice or more."""

    def covered(starts: Column) -> Column:
        steps = F.transform(
            starts,
            lambda at, i: F.least(
                F.lit(WINDOW), F.coalesce(F.get(starts, i + 1) - at, F.lit(WINDOW))
            ),
        )
        return F.aggregate(steps, F.lit(0).cast("long"), lambda total, step: total + step)

    def repeats(pairs: Column) -> Column:
        def if_repeated(pair: Column, i: Column) -> Column:
            same = (F.get(pairs, i - 1)["h"] == pair["h"]) | (F.get(pairs, i + 1)["h"] == pair["h"])
            return F.when(same, pair["i"])

        return _let(F.sort_array(F.array_compact(F.transform(pairs, if_repeated))), covered)

    def of_hashes(hashes: Column) -> Column:
        numbered = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        return F.when(
            F.size(F.array_distinct(hashes)) < F.size(hashes), _let(F.sort_array(numbered), repeats)
        ).otherwise(F.lit(0).cast("long"))

    windows = F.transform(
        F.sequence(F.lit(0), F.size(words) - WINDOW),
        lambda i: F.xxhash64(*(F.get(words, i + k) for k in range(WINDOW))),
    )
    return F.when(F.size(words) >= WINDOW, _let(windows, of_hashes)).otherwise(
        F.lit(0).cast("long")
    )


def base_statistics(docs: DataFrame) -> DataFrame:
    """Counts of every whole text, and whether they break a base limit."""
    text = F.coalesce(F.col("text"), F.lit(""))
    white = F.lit(WHITE)
    bare = F.translate(text, WHITE, "")
    lines = F.filter(F.split(text, "\n", -1), lambda line: F.btrim(line, white) != "")
    words = F.when(
        bare != "", F.split(F.btrim(text, white), "[\\x20\\x09-\\x0D]+", -1)
    ).otherwise(F.array().cast("array<string>"))
    measured = docs.select(
        "doc_id",
        "lang",
        "source",
        F.length(bare).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        _let(
            lines,
            lambda a: F.struct(
                F.size(a).cast("long").alias("n_lines"),
                (F.size(a) - F.size(F.array_distinct(a))).cast("long").alias("n_dup_lines"),
            ),
        ).alias("of_lines"),
        _let(
            words,
            lambda a: F.struct(
                F.size(a).cast("long").alias("n_words"), _repeated_words(a).alias("n_repeat_words")
            ),
        ).alias("of_words"),
    )
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return measured.select(
        "doc_id", "lang", "source", "word_chars", "n_symbols", "of_lines.*", "of_words.*"
    ).withColumn("base_failed", failed)


def _vector() -> list[Column]:
    """The transformed statistics: shares smoothed so that short texts vary little more."""
    words, chars = F.col("n_words"), F.col("word_chars")
    values = (
        F.log((chars + 250) / (words + 50)),
        F.sqrt(F.col("n_symbols") / (chars + 250)),
        F.col("n_dup_lines") / (F.col("n_lines") + 10),
        F.col("n_repeat_words") / (words + 50),
    )
    return [F.round(v * SCALE).cast("long").alias(f"x{i}") for i, v in enumerate(values)]


DIMS = range(len(FEATURES))
PAIRS = [(i, j) for i in DIMS for j in range(i + 1)]


def _chi2_cdf(x: float, freedom: int) -> float:
    """Of an even number of degrees of freedom."""
    term, total = 1.0, 1.0
    for k in range(1, freedom // 2):
        term *= x / 2 / k
        total += term
    return 1 - exp(-x / 2) * total


def _chi2_quantile(share: float, freedom: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if _chi2_cdf(mid, freedom) < share else (low, mid)
    return high


def _with_factor(estimates: DataFrame) -> DataFrame:
    """The Cholesky factor ``l{i}{j}`` of covariances ``c{i}{j}``.

    The floor of each feature is added to its variance, so the factor exists
    for constant features too.
    """
    df = estimates
    for j in DIMS:
        inner = sum((F.col(f"l{j}{k}") ** 2 for k in range(j)), F.lit(0.0))
        floor = F.lit(float(FLOORS[j] ** 2))
        df = df.withColumn(
            f"l{j}{j}", F.sqrt(F.greatest(F.col(f"c{j}{j}") + floor - inner, floor / 4))
        )
        for i in range(j + 1, len(FEATURES)):
            inner = sum((F.col(f"l{i}{k}") * F.col(f"l{j}{k}") for k in range(j)), F.lit(0.0))
            df = df.withColumn(f"l{i}{j}", (F.col(f"c{i}{j}") - inner) / F.col(f"l{j}{j}"))
    log_det = sum((F.log(f"l{i}{i}") for i in DIMS), F.lit(0.0))
    factor = [f"l{i}{j}" for i, j in PAIRS]
    return df.select("key", "start", *(f"m{i}" for i in DIMS), *factor, log_det.alias("log_det"))


def _with_distance(rows: DataFrame) -> DataFrame:
    """``d2``, the squared Mahalanobis distance of ``x`` from ``m``."""
    df = rows
    for i in DIMS:
        inner = sum((F.col(f"l{i}{k}") * F.col(f"z{k}") for k in range(i)), F.lit(0.0))
        df = df.withColumn(f"z{i}", (F.col(f"x{i}") - F.col(f"m{i}") - inner) / F.col(f"l{i}{i}"))
    return df.withColumn("d2", sum((F.col(f"z{i}") ** 2 for i in DIMS), F.lit(0.0)))


def _covariances(sums: DataFrame) -> DataFrame:
    """Means and covariances from ``n``, sums ``s{i}`` and products ``p{i}{j}``."""
    means = {f"m{i}": F.col(f"s{i}") / F.col("n") for i in DIMS}
    cross = {
        f"c{i}{j}": F.col(f"p{i}{j}") / F.col("n")
        - (F.col(f"s{i}") / F.col("n")) * (F.col(f"s{j}") / F.col("n"))
        for i, j in PAIRS
    }
    return sums.withColumns(means | cross)


def _moments() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("n"),
        *(F.sum(f"x{i}").alias(f"s{i}") for i in DIMS),
        *(F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"p{i}{j}") for i, j in PAIRS),
    ]


def robust_estimates(vectors: DataFrame) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """Minimum-covariance-determinant estimates of every ``key`` of ``vectors``.

    Two deterministic starts, the spread round the medians without and with the
    correlation of clipped values, take ``C_STEPS`` concentration steps each;
    the smaller determinant wins. A step counts rows and sums moments by
    distance class, a bounded table, and keeps the least classes that hold the
    core share, so no group's rows are sorted or gathered.
    """
    medians = written(
        vectors.groupBy("key").agg(
            F.count(F.lit(1)).alias("n_rows"), *(F.median(f"x{i}").alias(f"m{i}") for i in DIMS)
        )
    )
    few = medians.limit(BROADCAST_GROUPS + 1).count() <= BROADCAST_GROUPS

    def small(groups: DataFrame) -> DataFrame:
        return F.broadcast(groups) if few else groups

    spread = vectors.join(small(medians), "key").groupBy("key").agg(
        *(F.median(F.abs(F.col(f"x{i}") - F.col(f"m{i}"))).alias(f"d{i}") for i in DIMS)
    )
    centre = written(medians.join(spread, "key"))
    scales = {f"r{i}": F.greatest(1.4826 * F.col(f"d{i}"), F.lit(float(FLOORS[i]))) for i in DIMS}
    scaled = centre.withColumns(scales)
    clipped = vectors.join(small(scaled), "key").select(
        "key",
        *(
            F.round(
                SCALE
                * F.greatest(
                    F.lit(-2.0),
                    F.least(F.lit(2.0), (F.col(f"x{i}") - F.col(f"m{i}")) / F.col(f"r{i}")),
                )
            )
            .cast("long")
            .alias(f"x{i}")
            for i in DIMS
        ),
    )
    correlated = (
        _covariances(clipped.groupBy("key").agg(*_moments()))
        .select("key", *(f"c{i}{j}" for i, j in PAIRS))
        .join(scaled, "key")
    )

    def cross(i: int, j: int) -> Column:
        both = F.sqrt(F.col(f"c{i}{i}") * F.col(f"c{j}{j}"))
        rho = F.when(both > 0, F.col(f"c{i}{j}") / both).otherwise(0.0)
        return F.col(f"r{i}") * F.col(f"r{j}") * (F.lit(1.0) if i == j else rho)

    means = [F.col(f"m{i}").cast("double").alias(f"m{i}") for i in DIMS]
    plain = scaled.select(
        "key",
        F.lit(0).alias("start"),
        *means,
        *(
            (F.col(f"r{i}") ** 2 if i == j else F.lit(0.0)).alias(f"c{i}{j}")
            for i, j in PAIRS
        ),
    )
    tilted = correlated.select(
        "key", F.lit(1).alias("start"), *means, *(cross(i, j).alias(f"c{i}{j}") for i, j in PAIRS)
    )
    estimates = written(_with_factor(plain.union(tilted)))

    alpha = _chi2_quantile(CORE, len(FEATURES))
    consistent = CORE / _chi2_cdf(alpha, len(FEATURES) + 2)
    for _ in range(C_STEPS):
        near = _with_distance(vectors.join(small(estimates), "key")).withColumn(
            "class", F.floor(16 * F.log2(1 + F.col("d2")))
        )
        by_class = near.groupBy("key", "start", "class").agg(*_moments())
        totals = by_class.groupBy("key", "start").agg(F.sum("n").alias("rows_all"))
        running = by_class.alias("a").join(
            by_class.select("key", "start", F.col("class").alias("below"), F.col("n").alias("k")),
            ["key", "start"],
        )
        before = running.groupBy("key", "start", "class").agg(
            F.sum(F.when(F.col("below") < F.col("class"), F.col("k")).otherwise(0)).alias("before")
        )
        core = (
            by_class.join(before, ["key", "start", "class"])
            .join(totals, ["key", "start"])
            .filter(F.col("before") < F.col("rows_all") * CORE)
        )
        sums = core.groupBy("key", "start").agg(
            F.sum("n").alias("n"),
            *(F.sum(f"s{i}").alias(f"s{i}") for i in DIMS),
            *(F.sum(f"p{i}{j}").alias(f"p{i}{j}") for i, j in PAIRS),
        )
        grown = {f"c{i}{j}": F.col(f"c{i}{j}") * consistent for i, j in PAIRS}
        estimates = written(_with_factor(_covariances(sums).withColumns(grown)))
    best = estimates.groupBy("key").agg(
        F.min_by(F.struct(*(c for c in estimates.columns if c != "key")), F.struct("log_det", "start")).alias("e")
    )
    return best.select("key", "e.*").join(medians.select("key", "n_rows"), "key"), small


def quality_verdicts(docs: DataFrame) -> DataFrame:
    """Base counts, ``base_failed``, ``distance2`` and ``kept`` of every row.

    A row is dropped if it breaks a base limit, or if its statistic vector is
    further from the robust centre of its language and source than clean rows
    are. Estimates rest on all rows that pass the base limits. A language and
    source of under ``MIN_GROUP`` such rows uses the estimate of the language,
    and one of a language with as few that of all rows, however few those are.
    So every row that passes the base limits is judged; ``distance2`` is null
    for the others alone. A null language or source is a value of its own. Null,
    empty and blank texts have no words and so fail. Equal rows get equal
    verdicts; other columns are not read; an empty table gives an empty one.
    """
    stats = written(base_statistics(docs).select("*", *_vector()))

    def key(*columns: str) -> Column:
        return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})

    keyed = stats.withColumns({"fine": key("lang", "source"), "coarse": key("lang"), "whole": F.lit(WHOLE)})
    xs = [f"x{i}" for i in DIMS]
    vectors = keyed.filter(~F.col("base_failed")).select(
        F.explode(F.array("fine", "coarse", "whole")).alias("key"), *xs
    )
    best, small = robust_estimates(vectors)
    best = written(best.filter((F.col("n_rows") >= MIN_GROUP) | (F.col("key") == WHOLE)))
    chosen = keyed
    for level in ("fine", "coarse"):
        own = best.select(F.col("key").alias(level), F.lit(True).alias(f"has_{level}"))
        chosen = chosen.join(small(own), level, "left")
    chosen = chosen.withColumn(
        "key",
        F.when(F.col("has_fine"), F.col("fine")).when(F.col("has_coarse"), F.col("coarse")).otherwise(F.col("whole")),
    )
    judged = _with_distance(chosen.join(small(best), "key", "left"))
    distance = F.when(~F.col("base_failed"), F.col("d2"))
    far = F.coalesce(distance > _chi2_quantile(1 - TAIL, len(FEATURES)), F.lit(False))
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        (~F.col("base_failed") & ~far).alias("kept"),
        distance.alias("distance2"),
    )
