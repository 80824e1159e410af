"""Quality rules: base counts of a text, and robust outliers of their transformed vector.

Only DataFrame and SQL functions. Texts are read once for their counts; the minimum covariance
determinant then works on a stored table of five numbers per document. For every language and source
it starts from medians and repeats concentration steps: distances, their quantile in the group (a
mergeable sketch), mean and covariance of the closer rows. All of it combines on the map side, so a
source with a third of the rows costs no task more than its split.
"""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgersieve.sources.cut import cut

SPACE = r"[\\x20\\x09-\\x0D]"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
FEATURES = ("f_length", "f_word", "f_symbol", "f_line", "f_repeat")
# Least standard deviation of each feature: where nearly all rows agree, rounding is no outlier. One repeated
# line in 400 words is 0.05 of f_line, and a run of three words that returns in 120 is 0.05 of f_repeat: few
# of these are no outlier, but up to what the base rules pass each feature can reach the cutoff alone.
FLOORS = (0.25, 0.06, 0.04, 0.05, 0.05)
# Share of a group's rows that the estimate rests on.
SUPPORT = 0.75
# Chance of a rejection by distance, were the vectors normal.
ALPHA = 1e-7
# A group with fewer rows is judged by its language, and that by all rows.
MIN_GROUP = 200
MAX_STEPS = 8
SALTS = 64
_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def chi_square(quantile: float, d: int) -> float:
    """Quantile of the chi-square distribution (Wilson and Hilferty's approximation)."""
    return d * (1 - 2 / (9 * d) + NormalDist().inv_cdf(quantile) * (2 / (9 * d)) ** 0.5) ** 3


def base_counts(texts: DataFrame, text: str) -> DataFrame:
    """Add the base counts and base_failed. Repeats are found by sorting window hashes that carry their position.

    Sorted 64-bit values hold as many hash bits as the positions leave free; windows that look equal
    there are compared again by their whole 64-bit hash.
    """
    symbols = " + ".join(f"octet_length(_t) - octet_length(replace(_t, '{c}', ''))" for c in SYMBOLS)
    near = "x & _mask = get(_sorted, i - 1) & _mask or x & _mask = get(_sorted, i + 1) & _mask"
    same = "x.h = get(_found, i - 1).h or x.h = get(_found, i + 1).h"
    windows = "slice(arrays_zip(_w, slice(_w, 2, size(_w)), slice(_w, 3, size(_w))), 1, greatest(size(_w) - 2, 0))"
    return (
        texts.withColumn("_t", F.coalesce(F.col(text), F.lit("")))
        .withColumn("_w", F.expr(f"array_remove(split(_t, '{SPACE}+'), '')"))
        .withColumn("_lines", F.expr(r"filter(split(_t, '\n', -1), x -> btrim(x, ' \t\n\u000b\f\r') <> '')"))
        .selectExpr(
            *texts.columns, "_w", "cast(size(_w) as bigint) as n_words",
            "cast(char_length(array_join(_w, '')) as bigint) as word_chars",
            f"cast({symbols} as bigint) as n_symbols",
            "cast(size(_lines) - size(array_distinct(_lines)) as bigint) as n_dup_lines",
            "shiftleft(cast(-1 as bigint), cast(ceil(log2(size(_w) + 1)) as int)) as _mask")
        .withColumn("_sorted", F.expr(f"sort_array(transform({windows}, (x, i) -> (xxhash64(x) & _mask) | cast(i as bigint)))"))
        .withColumn("_near", F.expr(f"filter(_sorted, (x, i) -> coalesce({near}, false))"))
        .withColumn("_found", F.expr(
            "array_sort(transform(transform(_near, x -> cast(x & ~_mask as int)),"
            " p -> struct(xxhash64(_w[p], _w[p + 1], _w[p + 2]) as h, p as p)))"))
        .withColumn("_at", F.expr(f"sort_array(transform(filter(_found, (x, i) -> coalesce({same}, false)), x -> x.p))"))
        .withColumn("n_repeat_words", F.expr(
            "cast(aggregate(transform(_at, (p, i) -> least(3, coalesce(get(_at, i + 1) - p, 3))), 0, (a, x) -> a + x) as bigint)"))
        .withColumn("base_failed", F.expr(f"n_words < {MIN_WORDS} or 100 * n_repeat_words > 50 * n_words"))
        .select(*texts.columns, *_COUNTS)
    )


def _vector(stats: DataFrame) -> DataFrame:
    n, chars = "greatest(n_words, 1)", "greatest(word_chars, 1)"
    return stats.selectExpr(
        "*", "ln(1 + n_words) as f_length", f"ln(greatest(word_chars, 1) / {n}) as f_word",
        f"sqrt(n_symbols / {chars}) as f_symbol", f"sqrt(n_dup_lines / {n}) as f_line",
        f"n_repeat_words / {n} as f_repeat")


def _moments(rows: DataFrame) -> DataFrame:
    """Mean and covariance (floors added on the diagonal) of each group's rows."""
    d = range(len(FEATURES))
    means = [F.avg(f).alias(f"m{i}") for i, f in enumerate(FEATURES)]
    covs = [F.covar_pop(FEATURES[i], FEATURES[j]).alias(f"c{i}{j}") for i in d for j in range(i + 1)]
    out = rows.groupBy("_key").agg(*means, *covs)
    return out.withColumns({f"c{i}{i}": F.col(f"c{i}{i}") + FLOORS[i] ** 2 for i in d})


def _whitened(moments: DataFrame) -> DataFrame:
    """Replace the covariance by the inverse of its Cholesky factor (w) and its log determinant."""
    d = range(len(FEATURES))
    for i in d:
        for j in range(i + 1):
            left = F.col(f"c{i}{j}") - sum((F.col(f"l{i}{k}") * F.col(f"l{j}{k}") for k in range(j)), F.lit(0.0))
            value = F.sqrt(F.greatest(left, F.lit(1e-12))) if i == j else left / F.col(f"l{j}{j}")
            moments = moments.withColumn(f"l{i}{j}", value)
    for i in d:
        for j in range(i + 1):
            rest = sum((F.col(f"l{i}{k}") * F.col(f"w{k}{j}") for k in range(j, i)), F.lit(0.0))
            moments = moments.withColumn(f"w{i}{j}", ((1.0 if i == j else 0.0) - rest) / F.col(f"l{i}{i}"))
    logdet = 2 * sum((F.ln(f"l{i}{i}") for i in d), F.lit(0.0))
    return moments.select(
        "_key", *[f"m{i}" for i in d], *[f"w{i}{j}" for i in d for j in range(i + 1)], logdet.alias("logdet"))


def _distance() -> Column:
    d = range(len(FEATURES))
    y = [sum(((F.col(FEATURES[j]) - F.col(f"m{j}")) * F.col(f"w{i}{j}") for j in range(i + 1)), F.lit(0.0)) for i in d]
    return sum((v * v for v in y), F.lit(0.0))


def _meet(rows: DataFrame, groups: DataFrame, how: str = "inner") -> DataFrame:
    """Join rows with what is known of their group. All rows are dealt by group and `_salt`, so that no
    task gets more of a large group than one part in SALTS."""
    salted = groups.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.join(salted, ["_key", "_salt"], how)


def _start(rows: DataFrame) -> DataFrame:
    """Medians, and spreads from the quartiles, as the first estimate."""
    d = range(len(FEATURES))
    quartiles = [F.percentile_approx(f, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), 1000).alias(f"q{i}")
                 for i, f in enumerate(FEATURES)]
    spread = [((F.col(f"q{i}")[2] - F.col(f"q{i}")[0]) / 1.349) for i in d]
    return rows.groupBy("_key").agg(*quartiles).select(
        "_key", *[F.col(f"q{i}")[1].alias(f"m{i}") for i in d],
        *[(1 / F.sqrt(spread[i] * spread[i] + FLOORS[i] ** 2) if i == j else F.lit(0.0)).alias(f"w{i}{j}")
          for i in d for j in range(i + 1)],
        F.lit(float("inf")).alias("logdet"))


def covariance_estimates(rows: DataFrame) -> DataFrame:
    """(_key, m*, w*, scale): the estimate of each `_key` of `rows`, a stored table with FEATURES and `_salt`."""
    estimate, total = cut(_start(rows), "mcd"), None
    for _ in range(MAX_STEPS):
        far = _meet(rows, estimate).select("_key", "_salt", *FEATURES, _distance().alias("_d"))
        edge = cut(far.groupBy("_key").agg(F.percentile_approx("_d", SUPPORT, 1000).alias("_edge")), "mcd")
        estimate = cut(_whitened(_moments(_meet(far, edge).where("_d <= _edge"))), "mcd")
        last, total = total, estimate.agg(F.sum("logdet")).first()[0]
        if total is None or last is not None and last - total < 1e-3:
            break
    # The closer rows understate the spread: scale so that the median distance is that of a normal.
    median = _meet(rows, estimate).groupBy("_key").agg(F.percentile_approx(_distance(), 0.5, 1000).alias("_m"))
    scale = F.greatest(F.col("_m") / chi_square(0.5, len(FEATURES)), F.lit(1.0)).alias("scale")
    return cut(estimate.join(median, "_key").select(*estimate.columns, scale), "mcd")


def judge(stats: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """Add distance and kept to a stored table of counts. Rows that fail the base rules are no part of an estimate."""
    mark = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-"))
    keys = [F.concat_ws("\x1f", mark(lang), mark(source)), F.concat_ws("\x1f", mark(lang), F.lit("*")), F.lit("*")]
    vectors = _vector(stats)
    vectors = vectors.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)))
    levels = vectors.where("not base_failed").select(
        F.explode(F.array(*keys)).alias("_key"), "_salt", *FEATURES)
    levels = cut(levels, "vectors")
    large = levels.groupBy("_key").count().where((F.col("count") >= MIN_GROUP) | (F.col("_key") == "*"))
    known = covariance_estimates(cut(_meet(levels, cut(large.select("_key"), "mcd")), "vectors"))
    cutoff = chi_square(1 - ALPHA, len(FEATURES))
    pick = vectors.withColumns({f"_k{i}": k for i, k in enumerate(keys)})
    for i in range(2):
        named = known.select("_key", F.col("_key").alias(f"_has{i}"))
        pick = _meet(pick.withColumn("_key", F.col(f"_k{i}")), named, "left").drop("_key")
    pick = pick.withColumn("_key", F.coalesce("_has0", "_has1", F.lit("*")))
    judged = _meet(pick, known, "left").withColumn("distance", _distance() / F.col("scale"))
    kept = ~F.col("base_failed") & F.coalesce(F.col("distance") <= cutoff, F.lit(True))
    return judged.select(*stats.columns, "distance", kept.alias("kept"))


def quality_rules(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source"
) -> DataFrame:
    """One row per row of `docs`: doc_id, text_hash, lang, source, the base counts, base_failed, distance, kept.

    A NULL or empty text has no words and fails. A NULL language or source is a group of its own.
    Rows that repeat are judged alike, and each counts in its group. Other columns are not read. An
    empty table gives an empty table.
    """
    own = docs.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text"), F.xxhash64(text_col).alias("text_hash"),
        F.col(lang_col).alias("lang"), F.col(source_col).alias("source"))
    return judge(cut(base_counts(own, "_text").drop("_text"), "counts"))


def kept_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source"
) -> DataFrame:
    """The rows of `docs` that the rules keep, with all their columns. Rows alike but for language or source are judged apart."""
    kept = quality_rules(docs, id_col, text_col, lang_col, source_col).where("kept").select(
        F.col("doc_id").alias("_kept_id"), F.col("text_hash").alias("_kept_hash"),
        F.col("lang").alias("_kept_lang"), F.col("source").alias("_kept_source")).distinct()
    same = docs[id_col].eqNullSafe(kept["_kept_id"]) & (F.xxhash64(docs[text_col]) == kept["_kept_hash"])
    same &= docs[lang_col].eqNullSafe(kept["_kept_lang"]) & docs[source_col].eqNullSafe(kept["_kept_source"])
    return docs.join(kept, same, "left_semi")
