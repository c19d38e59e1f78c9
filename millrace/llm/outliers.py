"""Quality rules with robust multivariate outliers.

Four shares of a text are transformed to a vector of whole numbers (thousandths):
mean word length, marks per word, repeated lines per word and repeated words. For
each language and source the minimum-covariance-determinant estimate is
approached from medians and median deviations by concentration steps: the
`SUPPORT` of documents nearest to the centre give the next centre and covariance.
Sums are of whole numbers and the nearest documents are found by counts per
distance bin, so the result does not depend on the order of rows. Documents beyond
`CUTOFF` (squared Mahalanobis distance) are rejected. Groups below `MIN_GROUP`
rows are judged together, per language. Built-in functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.components import _stored
from millrace.llm.frames import PREFIX, without

WORD_GAP = r"[\x20\x09-\x0D]+"
SYMBOLS = "[#*$%&|<>]"
WINDOW = 5
SUPPORT = 0.75
STEPS = 4
MIN_GROUP = 50
# Squared distance; a normal vector of four exceeds 40 once in 20 million times.
CUTOFF = 40.0
# Least standard deviation of each statistic in thousandths: a group whose texts
# agree in a statistic must not reject the first that differs a little.
LEAST_SPREAD = (100, 150, 60, 100)
# Scales the covariance of the nearest 75 % of a normal vector of four to that of
# all: 0.75 / P(chi-square of 6 degrees <= 75 % quantile of chi-square of 4).
CONSISTENCY = 1.528
_BINS_PER_DOUBLING = 16
_VECTOR = tuple(f"x{i}" for i in range(4))


def words(text: str = "text") -> Column:
    """A text's words; trimmed first, so only a text without words has an empty one."""
    trimmed = F.btrim(F.coalesce(F.col(text), F.lit("")), F.lit(" \t\n\x0b\x0c\r"))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, WORD_GAP))


def _next(column: str, k: int) -> Column:
    """The array without its first k elements."""
    return F.slice(column, k + 1, F.greatest(F.size(column) - k, F.lit(0)))


def with_repeats(rows: DataFrame, held: str) -> DataFrame:
    """Adds `n_repeat_words`: words in windows of five words found twice or more
    among the words in column `held`.

    Hashes of all windows, built up by halves, show whether any repeats at all; only
    then are the windows themselves sorted with their places, equal neighbours
    found, and the words they cover counted once each.
    """
    h1, h2, h4, h5, win, at = (f"{PREFIX}{x}" for x in ("h1", "h2", "h4", "h5", "win", "at"))
    join = lambda a, b: F.xxhash64(a, b)
    size = F.size(held)
    # zip_with pads the shorter array: one element more than there are windows for each step.
    rows = rows.withColumn(h1, F.transform(held, lambda w: F.xxhash64(w)))
    rows = rows.withColumn(h2, F.zip_with(h1, _next(h1, 1), join))
    rows = rows.withColumn(h4, F.zip_with(h2, _next(h2, 2), join))
    rows = rows.withColumn(h5, F.slice(F.zip_with(h4, _next(h1, 4), join), 1, F.greatest(size - WINDOW + 1, F.lit(0))))
    some = F.size(F.array_distinct(h5)) < F.size(h5)
    starts = F.sequence(F.lit(0), size - WINDOW)
    windows = F.transform(starts, lambda i: F.struct(F.array_join(F.slice(held, i + 1, WINDOW), " ").alias("w"), i.alias("at")))
    rows = rows.withColumn(win, F.when(some, F.sort_array(windows)))
    pairs = F.zip_with(F.slice(win, 1, F.size(win) - 1), _next(win, 1), lambda a, b: F.when(a["w"] == b["w"], F.array(a["at"], b["at"])))
    places = F.sort_array(F.array_distinct(F.flatten(F.array_compact(pairs))))
    rows = rows.withColumn(at, F.when(F.col(win).isNotNull(), places))
    # Each window adds the words up to the next one's start, five at most.
    steps = F.zip_with(at, _next(at, 1), lambda a, b: F.least(F.coalesce(b - a, F.lit(WINDOW)), F.lit(WINDOW)))
    covered = F.aggregate(steps, F.lit(0), lambda a, b: a + b)
    repeated = F.when(F.size(at) > 0, covered).otherwise(0).cast("bigint")
    return rows.withColumn("n_repeat_words", repeated).drop(h1, h2, h4, h5, win, at)


def base_rules(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds `n_words`, `word_chars`, `n_symbols`, `n_dup_lines`, `n_repeat_words` and
    `base_failed`."""
    held = f"{PREFIX}words"
    full = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(full, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    rows = with_repeats(docs.withColumns({held: words(text), f"{PREFIX}lines": lines}), held)
    rows = rows.withColumns(
        {
            "n_words": F.size(held).cast("bigint"),
            "word_chars": F.length(F.array_join(held, "")).cast("bigint"),
            "n_symbols": (F.length(full) - F.length(F.regexp_replace(full, SYMBOLS, ""))).cast("bigint"),
            "n_dup_lines": (F.size(f"{PREFIX}lines") - F.size(F.array_distinct(f"{PREFIX}lines"))).cast("bigint"),
        }
    ).drop(held, f"{PREFIX}lines")
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return rows.withColumn("base_failed", failed)


def vector() -> list[Column]:
    """The transformed statistics in thousandths."""
    n = F.greatest(F.col("n_words"), F.lit(1))
    thousandths = lambda x: F.round(x * 1000).cast("bigint")
    return [
        thousandths(F.log1p(F.col("word_chars") / n)),
        thousandths(F.log1p(F.col("n_symbols") / n)),
        thousandths(F.sqrt(F.col("n_dup_lines") / n)),
        thousandths(F.sqrt(F.col("n_repeat_words") / n)),
    ]


def _distance(row: str = "s", fit: str = "m") -> Column:
    """Squared Mahalanobis distance by forward substitution in the Cholesky factor."""
    solved: list[Column] = []
    for i in range(4):
        rest = F.col(f"{row}.x{i}") - F.col(f"{fit}.c{i}")
        for j in range(i):
            rest = rest - F.col(f"{fit}.l{i}{j}") * solved[j]
        solved.append(rest / F.col(f"{fit}.l{i}{i}"))
    return sum((y * y for y in solved[1:]), solved[0] * solved[0])


def _factor(moments: DataFrame) -> DataFrame:
    """(grp, centre c0.., Cholesky factor l00.. of the covariance) of `moments`
    (grp, n, s0.., s00..), with the least spread added to the variances."""
    rows = moments.withColumns({f"c{i}": F.col(f"s{i}") / F.col("n") for i in range(4)})
    for i in range(4):
        for j in range(i + 1):
            cov = CONSISTENCY * (F.col(f"s{i}{j}") / F.col("n") - F.col(f"c{i}") * F.col(f"c{j}"))
            if i == j:
                cov = F.greatest(cov, F.lit(0.0)) + LEAST_SPREAD[i] ** 2
            for k in range(j):
                cov = cov - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            value = F.sqrt(F.greatest(cov, F.lit(1.0))) if i == j else cov / F.col(f"l{j}{j}")
            rows = rows.withColumn(f"l{i}{j}", value)
    return rows.select("grp", *[f"c{i}" for i in range(4)], *[f"l{i}{j}" for i in range(4) for j in range(i + 1)])


def _start(stats: DataFrame) -> DataFrame:
    """Centres at the medians, a diagonal factor from median deviations.

    Both are taken from counts per value, which are combined before they move, so
    the rows of a large group are never in one task."""
    pairs = F.array(*[F.struct(F.lit(i).alias("i"), F.col(x).alias("x")) for i, x in enumerate(_VECTOR)])
    counts = stats.select("grp", F.inline(pairs)).groupBy("grp", "i", "x").agg(F.count(F.lit(1)).alias("n"))
    counts = _stored(counts, "values")
    medians = _stored(counts.groupBy("grp", "i").agg(F.percentile("x", 0.5, F.col("n")).alias("c")), "medians")
    off = counts.join(medians, ["grp", "i"]).select("grp", "i", F.abs(F.col("x") - F.col("c")).alias("d"), "n")
    spread = off.groupBy("grp", "i").agg(F.percentile("d", 0.5, F.col("n")).alias("l"))
    both = medians.join(spread, ["grp", "i"])
    own = lambda column, i: F.max(F.when(F.col("i") == i, F.col(column)))
    fit = both.groupBy("grp").agg(
        *[own("c", i).alias(f"c{i}") for i in range(4)],
        *[F.greatest(1.4826 * own("l", i), F.lit(float(LEAST_SPREAD[i]))).alias(f"l{i}{i}") for i in range(4)],
    )
    return fit.withColumns({f"l{i}{j}": F.lit(0.0) for i in range(4) for j in range(i)})


def estimates(stats: DataFrame, support: float = SUPPORT, steps: int = STEPS) -> DataFrame:
    """Robust centre and Cholesky factor per `grp` of rows (grp, x0, x1, x2, x3)."""
    fit = _stored(_start(stats), "estimate")
    for _ in range(steps):
        near = stats.alias("s").join(fit.alias("m"), F.col("s.grp") == F.col("m.grp")).select("s.*", _distance().alias("d"))
        near = near.withColumn("bin", F.floor(F.log2(1 + F.col("d")) * _BINS_PER_DOUBLING).cast("int"))
        counts = near.groupBy("grp", "bin").agg(
            F.count(F.lit(1)).alias("n"),
            *[F.sum(x).alias(f"s{x[1]}") for x in _VECTOR],
            *[F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"s{i}{j}") for i in range(4) for j in range(i + 1)],
        )
        # A few hundred bins per group: the nearest ones up to the support.
        before = Window.partitionBy("grp").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
        chosen = counts.withColumns(
            {"_before": F.coalesce(F.sum("n").over(before), F.lit(0)), "_all": F.sum("n").over(Window.partitionBy("grp"))}
        ).where(F.col("_before") < support * F.col("_all"))
        sums = [c for c in counts.columns if c not in ("grp", "bin")]
        fit = _stored(_factor(chosen.groupBy("grp").agg(*[F.sum(c).alias(c) for c in sums])), "estimate")
    return fit


def judge(docs: DataFrame, cutoff: float = CUTOFF, support: float = SUPPORT, steps: int = STEPS, min_group: int = MIN_GROUP) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, distance, kept), a row per row of `docs` (`doc_id`, `text`, `lang`,
    `source`).

    Rows that fail the base rules are not kept and take no part in estimates; their
    distance is NULL. NULL and empty texts have no words and fail. NULL names of
    language or source form groups of their own. Groups below `min_group` rows are
    judged together, per language. An empty table gives an empty result.
    """
    docs = without(docs, ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "distance", "kept"))
    rows = base_rules(docs.select("doc_id", "text", "lang", "source")).drop("text")
    rows = _stored(rows.withColumns(dict(zip(_VECTOR, vector()))), "statistics")
    sizes = rows.where("not base_failed").groupBy("lang", "source").count()
    groups = sizes.select(
        F.col("lang").alias("_lang"),
        F.col("source").alias("_source"),
        F.when(F.col("count") >= min_group, F.to_json(F.array("lang", "source"))).otherwise(F.to_json(F.array("lang"))).alias("grp"),
    )
    same = F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source"))
    grouped = rows.join(groups, same, "left").drop("_lang", "_source")
    grouped = _stored(grouped, "grouped")
    fit = estimates(grouped.where("not base_failed").select("grp", *_VECTOR), support, steps)
    scored = grouped.alias("s").join(fit.alias("m"), F.col("s.grp") == F.col("m.grp"), "left")
    distance = F.when(~F.col("s.base_failed"), _distance())
    return scored.select(
        "s.doc_id", "s.n_words", "s.word_chars", "s.n_symbols", "s.n_dup_lines", "s.n_repeat_words", "s.base_failed",
        distance.alias("distance"),
    ).withColumn("kept", ~F.col("base_failed") & (F.col("distance") <= cutoff))
