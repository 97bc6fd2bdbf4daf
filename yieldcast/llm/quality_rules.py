"""Quality rules: robust multivariate outliers (minimum covariance determinant), DataFrame functions only.

Every document gets base counts. A base rule drops texts of fewer than ten
words or made mostly of repeated word windows. The rest are judged per
(language, source): a minimum-covariance-determinant estimate of the centre
and shape of the transformed statistics, then a Mahalanobis distance cut.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from yieldcast.llm.common import SPACE, let, scratch, word_array

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5
SYMBOLS = "#*$%&|<>"

COVERAGE = 0.75          # share of a group in the covariance subset
STEPS = 4                # concentration steps
SALTS = 32               # tasks that a group is split into
MIN_GROUP = 60           # smaller groups are pooled per language, then over all
CHI2_HALF = 3.3567       # median of chi-square with 4 degrees of freedom
CUT = 30.0               # squared distance beyond which a text is rejected; chi-square, 4 degrees: 1 - 5e-6
# Smallest standard deviation a dimension may have: a group whose subset is
# constant in a statistic must not reject tiny deviations from it.
FLOORS = (0.06, 0.05, 0.1, 0.1)
DIMS = len(FLOORS)


def base_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """One struct of the input row (``row``) beside n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words
    (long), base_failed and the statistic vector x0, x1, ...; a null text counts as empty."""
    t = F.coalesce(F.col("text"), F.lit(""))
    return (docs.select(F.struct(*[_named(c) for c in docs.columns]).alias("row"), _named(text).alias("text"))
            .withColumn("words", word_array(t))
            .select(
                "row",
                F.size("words").cast("long").alias("n_words"),
                F.length(F.translate(t, SPACE, "")).cast("long").alias("word_chars"),
                (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long").alias("n_symbols"),
                let(F.filter(F.split(t, "\n"), lambda x: F.btrim(x, F.lit(SPACE)) != ""),
                    lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
                let(F.col("words"), _repeat_words).cast("long").alias("n_repeat_words"))
            .withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                        | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))
            .select("*", *[x.alias(f"x{i}") for i, x in enumerate(statistic_vector())]))


def _named(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _repeat_words(w: Column) -> Column:
    """Words that lie in a window found twice or more in the text."""
    grams = F.when(F.size(w) >= WINDOW, F.transform(
        F.sequence(F.lit(1), F.size(w) - (WINDOW - 1)),
        lambda i: F.xxhash64(*[F.element_at(w, i + k) for k in range(WINDOW)]))).otherwise(F.array().cast("array<bigint>"))
    return let(grams, lambda g: F.when(F.size(F.array_distinct(g)) == F.size(g), 0).otherwise(_covered(g)))


def _covered(g: Column) -> Column:
    """Positions covered by windows whose hash occurs more than once: neighbours in hash order tell them."""
    def repeated(s):
        at = F.transform(F.sequence(F.lit(1), F.size(s)), lambda k: F.when(
            ((k > 1) & (F.element_at(s, F.greatest(k - 1, F.lit(1)))["h"] == F.element_at(s, k)["h"]))
            | ((k < F.size(s)) & (F.element_at(s, F.least(k + 1, F.size(s)))["h"] == F.element_at(s, k)["h"])),
            F.element_at(s, k)["i"]))
        return F.filter(at, lambda x: x.isNotNull())

    ranked = F.array_sort(F.transform(g, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    places = let(ranked, repeated)
    return F.size(F.array_distinct(F.flatten(F.transform(places, lambda p: F.sequence(p, p + (WINDOW - 1))))))


def statistic_vector() -> list[Column]:
    """Variance-stabilised statistics; the constants shrink short texts towards usual values."""
    words, chars = F.col("n_words").cast("double"), F.col("word_chars").cast("double")
    return [F.log((chars + 100) / (words + 20)),
            F.sqrt(F.col("n_symbols") / (chars + 100)),
            F.sqrt(F.col("n_dup_lines") / (words / 10 + 5)),
            F.sqrt(F.col("n_repeat_words") / (words + 20))]


def _moments() -> list[Column]:
    out = [F.count(F.lit(1)).alias("m")]
    out += [F.avg(f"x{i}").alias(f"c{i}") for i in range(DIMS)]
    out += [F.covar_pop(f"x{i}", f"x{j}").alias(f"s{i}{j}") for i in range(DIMS) for j in range(i + 1)]
    return out


def _cholesky(est: DataFrame) -> DataFrame:
    """Replace covariances s_ij (floored on the diagonal) by the lower factor l_ij."""
    for j in range(DIMS):
        for i in range(j, DIMS):
            rest = F.col(f"s{i}{j}")
            if i == j:
                rest = rest + F.lit(FLOORS[i] ** 2)
            for k in range(j):
                rest = rest - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            est = est.withColumn(f"l{i}{j}", F.sqrt(F.greatest(rest, F.lit(1e-12))) if i == j else rest / F.col(f"l{j}{j}"))
    return est.select("g", "m", *[f"c{i}" for i in range(DIMS)],
                      *[f"l{i}{j}" for i in range(DIMS) for j in range(i + 1)])


def _distance() -> Column:
    """Squared Mahalanobis distance by forward substitution."""
    z: list[Column] = []
    for i in range(DIMS):
        rest = F.col(f"x{i}") - F.col(f"c{i}")
        for k in range(i):
            rest = rest - F.col(f"l{i}{k}") * z[k]
        z.append(rest / F.col(f"l{i}{i}"))
    total = z[0] * z[0]
    for v in z[1:]:
        total = total + v * v
    return total


def _beside(points: DataFrame, per_group: DataFrame) -> DataFrame:
    """Join a row per group to its points; the salt splits a group that holds much of the table over SALTS tasks."""
    salted = per_group.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    return points.join(salted, ["g", "salt"])


def mcd_fit(points: DataFrame) -> DataFrame:
    """Estimates per group of points (g, x0..): centre, factor, and a scale that brings a large median distance down to the usual one.

    Start: medians and median absolute deviations. Every concentration step
    keeps the COVERAGE share nearest under the last estimate and refits, which
    never raises the determinant. Only aggregates leave the tasks.
    """
    points = points.withColumn("salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)))
    med = scratch(points.groupBy("g").agg(*[F.percentile_approx(f"x{i}", 0.5, 2000).alias(f"c{i}") for i in range(DIMS)]))
    mad = _beside(points, med).groupBy("g").agg(
        F.count(F.lit(1)).alias("m"),
        *[F.first(f"c{i}").alias(f"c{i}") for i in range(DIMS)],
        *[(F.pow(1.4826 * F.percentile_approx(F.abs(F.col(f"x{i}") - F.col(f"c{i}")), 0.5, 2000), F.lit(2.0))
           if i == j else F.lit(0.0)).alias(f"s{i}{j}") for i in range(DIMS) for j in range(i + 1)])
    est = scratch(_cholesky(mad))
    for _ in range(STEPS):
        far = _beside(points, est).select("g", "salt", *[f"x{i}" for i in range(DIMS)], _distance().alias("d2"))
        edge = far.groupBy("g").agg(F.percentile_approx("d2", COVERAGE, 2000).alias("edge"))
        est = scratch(_cholesky(_beside(far, edge).where("d2 <= edge").groupBy("g").agg(*_moments())))
    scale = _beside(points, est).groupBy("g").agg(
        F.percentile_approx(_distance(), 0.5, 2000).alias("mid"))
    return scratch(est.join(scale, "g").withColumn(
        "scale", F.lit(CHI2_HALF) / F.greatest("mid", F.lit(CHI2_HALF))))


def _keyed(counted: DataFrame, lang: str, source: str) -> DataFrame:
    """Add the group keys: JSON text tells a null from any string."""
    l, src = (F.col("row").getField(c).cast("string") for c in (lang, source))
    return counted.withColumn("k_lang", F.to_json(F.array(l))).withColumn("k", F.to_json(F.array(l, src)))


def fit(keyed: DataFrame) -> DataFrame:
    """Estimates for every (language, source) key k of counted rows. Groups with fewer than MIN_GROUP usable texts
    are pooled per language and then over everything; a pool that is still small gets no estimate."""
    usable = keyed.where(~F.col("base_failed"))
    sizes = scratch(usable.groupBy("k_lang", "k").agg(F.count(F.lit(1)).alias("n")))
    pooled = sizes.where(F.col("n") < MIN_GROUP).groupBy("k_lang").agg(F.sum("n").alias("pool"))
    groups = scratch(sizes.join(pooled, "k_lang", "left").select(
        "k", F.when(F.col("n") >= MIN_GROUP, F.col("k")).when(F.col("pool") >= MIN_GROUP, F.col("k_lang"))
        .otherwise("all").alias("g")))
    est = mcd_fit(usable.join(groups, "k").select("g", *[f"x{i}" for i in range(DIMS)]))
    return groups.join(est.where(F.col("m") >= COVERAGE * MIN_GROUP), "g")


RESULTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "distance", "kept")


def _judge(keyed: DataFrame, est: DataFrame, columns: list[str]) -> DataFrame:
    judged = keyed.join(est, "k", "left").withColumn(
        "distance", F.when(~F.col("base_failed"), _distance() * F.col("scale")))
    judged = judged.withColumn("kept", ~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= CUT))
    return judged.select(*[F.col("row").getField(c).alias(c) for c in columns if c not in RESULTS], *RESULTS)


def quality_rules(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """Counts, base_failed, distance and kept for every row of ``docs``, with all its columns but the text.

    Nulls in lang or source form groups of their own. A null or empty text
    fails the base rule. Repeated rows are judged alike and all returned. An
    empty table gives an empty result. Input columns named like a result
    column are replaced by it. Texts are read once: what follows works on
    a scratch table of the counts.
    """
    slim = [c for c in docs.columns if c != text]
    counted = base_counts(docs, text).withColumn("row", F.struct(*[F.col("row").getField(c).alias(c) for c in slim]))
    keyed = scratch(_keyed(counted, lang, source))
    return _judge(keyed, fit(keyed), slim)


def keep_good(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """The rows of ``docs`` that the rules keep, with the columns of ``docs`` (none may be named like a result).

    Counts are taken once and written beside the rows. Texts are never shuffled unless the table of
    estimates (a row per language and source) is too large to broadcast.
    """
    keyed = scratch(_keyed(base_counts(docs, text), lang, source))
    slim = keyed.select("k_lang", "k", "base_failed", *[f"x{i}" for i in range(DIMS)])
    judged = keyed.join(fit(slim), "k", "left").where(
        ~F.col("base_failed") & (F.coalesce(_distance() * F.col("scale"), F.lit(0.0)) <= CUT))
    return judged.select([F.col("row").getField(c).alias(c) for c in docs.columns])
