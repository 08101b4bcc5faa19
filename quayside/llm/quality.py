"""Quality rules whose cutoffs are certified to reject few good documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quayside.llm.common import stored

ALPHA = 0.02  # share of good documents of a stratum that all rules together may reject
DELTA = 0.05  # chance that any of the cutoffs breaks its promise
STRATA = 10_000  # strata whose cutoffs may be broadcast; more are joined
SPACE = "[ \\x09-\\x0D]+"
RULES = ("symbols", "dup_lines", "repeats")


def let(value: Column, use) -> Column:
    """``use`` over a value that is evaluated once."""
    return F.transform(F.array(value), use)[0]


def _repeated(words: Column) -> Column:
    """Words of 3-word windows that occur twice or more, the first included.

    Windows are sorted by hash, so equal ones are neighbours; neighbours are compared word by word.
    """

    def of(w: Column) -> Column:
        at = F.sequence(F.lit(0), F.size(w) - 3)
        window = lambda i: F.struct(F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("i"))

        def same(x: Column, y: Column) -> Column:
            equal = [F.get(w, x["i"] + k) == F.get(w, y["i"] + k) for k in range(3)]
            return F.coalesce((x["h"] == y["h"]) & equal[0] & equal[1] & equal[2], F.lit(False))

        def marked(s: Column) -> Column:
            twice = lambda x, j: F.when(same(x, F.get(s, j - 1)) | same(x, F.get(s, j + 1)), x["i"])
            return F.array_sort(F.array_compact(F.transform(s, twice)))

        def covered(p: Column) -> Column:
            width = lambda x, j: F.least(F.lit(3), F.coalesce(F.get(p, j + 1) - x, F.lit(3)))
            return F.aggregate(F.transform(p, width), F.lit(0), lambda a, b: a + b)

        return let(let(F.sort_array(F.transform(at, window)), marked), covered)

    return F.when(F.size(words) >= 3, of(words)).otherwise(0)


def measures(docs: DataFrame, key: str = "doc_id", text: str = "text", stratum: str = "lang") -> DataFrame:
    """Counts of every whole text and the rule values made from them, in thousandths.

    A NULL text has no words; a NULL stratum is one of its own.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    split = docs.select(
        F.col(key),
        F.col(stratum).alias("stratum"),
        F.array_remove(F.split(whole, SPACE), "").alias("w"),
        F.length(F.regexp_replace(whole, SPACE, "")).cast("bigint").alias("word_chars"),
        (F.length(whole) - F.length(F.regexp_replace(whole, "[#*$%&|<>]", ""))).cast("bigint").alias("n_symbols"),
        F.filter(F.split(whole, "\n"), lambda x: x.rlike("[^ \\x09-\\x0D]")).alias("lines"),
    )
    counted = split.select(
        key,
        "stratum",
        F.size("w").cast("bigint").alias("n_words"),
        "word_chars",
        "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.size("lines").cast("bigint").alias("n_lines"),
        _repeated(F.col("w")).cast("bigint").alias("n_repeat_words"),
    )
    return counted.withColumn(
        "base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    )


def rule_values() -> dict[str, Column]:
    share = lambda a, b: F.expr(f"1000L * {a} div greatest({b}, 1L)")
    return {
        "symbols": share("n_symbols", "word_chars"),
        "dup_lines": share("n_dup_lines", "n_lines"),
        "repeats": share("n_repeat_words", "n_words"),
    }


def _ln_gamma(x: Column) -> Column:
    """Stirling's series, moved up by eight to converge: good to about 13 digits for x >= 1."""
    z = x + 8
    series = (z - 0.5) * F.log(z) - z + 0.9189385332046727 + 1 / (12 * z) - 1 / (360 * z * z * z)
    series = series + 1 / (1260 * z * z * z * z * z)
    for i in range(8):
        series = series - F.log(x + i)
    return series


def allowed(n: Column, alpha: float, delta: Column) -> Column:
    """The most rejections among ``n`` that still show a rate of at most ``alpha``, else -1.

    The largest k with P(Binomial(n, alpha) <= k) <= delta: the exact (Clopper-Pearson) upper
    bound of k out of n is then at most alpha. The sum runs over the counts from twelve standard
    deviations below the mean, under which nothing is left of a double.
    """
    count = n.cast("double")
    mean, spread = count * alpha, F.sqrt(count * alpha * (1 - alpha))
    low = F.greatest(F.lit(0), F.floor(mean - 12 * spread - 12)).cast("bigint")
    ways = lambda k: _ln_gamma(count + 1) - _ln_gamma(k + 1) - _ln_gamma(count - k + 1)
    chance = lambda k: F.exp(ways(k) + k * F.log(F.lit(alpha)) + (count - k) * F.log(F.lit(1 - alpha)))
    steps = F.transform(
        F.sequence(low, F.ceil(mean).cast("bigint")),
        lambda k: F.struct(k.alias("k"), chance(k.cast("double")).alias("p")),
    )
    start = F.struct(F.lit(0.0).alias("sum"), F.lit(-1).cast("bigint").alias("k"))

    def add(held: Column, step: Column) -> Column:
        total = held["sum"] + step["p"]
        return F.struct(total.alias("sum"), F.when(total <= delta, step["k"]).otherwise(held["k"]).alias("k"))

    return F.aggregate(steps, start, add, lambda held: held["k"])


def good_ones(labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """Documents that every label row calls good."""
    return labels.where(F.col(key).isNotNull()).groupBy(key).agg(F.min("quality").alias("q")).where("q = 1").select(key)


def cutoffs(measured: DataFrame, labels: DataFrame, key: str = "doc_id", alpha: float = ALPHA,
            delta: float = DELTA) -> DataFrame:
    """One row ``stratum, symbols, dup_lines, repeats`` per stratum with labelled good documents.

    A rule rejects values above its cutoff; NULL means that the labels cannot certify any. For
    each stratum and rule the cutoffs are ordered from lax to strict, and the strictest is taken
    that rejects no more of the good documents than :func:`allowed`. Each stratum's share
    ``alpha`` is divided by the rules, and ``delta`` by all pairs of stratum and rule (Bonferroni),
    so with probability 1 - delta no stratum loses more than ``alpha`` of its good documents.
    All labelled documents that pass the base rules count.
    """
    holdout = measured.where(~F.col("base_failed")).join(good_ones(labels, key), key)
    pairs = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), v.alias("value")) for r, v in rule_values().items()]))
    # A histogram of at most 1001 values per stratum and rule; only counts are shuffled.
    counts = stored(
        holdout.select("stratum", pairs.alias("x")).groupBy("stratum", "x.rule", "x.value").agg(F.count("*").alias("c")),
        "holdout",
    )
    tests = max(1, counts.select("stratum", "rule").distinct().count())
    group = Window.partitionBy("stratum", "rule")
    ranked = counts.select(
        "*",
        F.sum("c").over(group).alias("n"),
        (F.sum("c").over(group.orderBy(F.col("value").desc())) - F.col("c")).alias("above"),
    )
    most = allowed(F.col("n"), alpha / len(RULES), F.lit(delta / tests))
    best = ranked.withColumn("most", most).groupBy("stratum", "rule").agg(
        F.min(F.when(F.col("above") <= F.col("most"), F.col("value"))).alias("cutoff")
    )
    return best.groupBy("stratum").agg(*[F.max(F.when(F.col("rule") == r, F.col("cutoff"))).alias(r) for r in RULES])


def judge(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", stratum: str = "lang",
          alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """Counts and verdict of every document; base rules first, then the certified cutoffs.

    A stratum without labels has no cutoffs and loses nothing beyond the base rules. A NULL text
    fails the base rules. Labels of unknown documents and with NULL ids are not used; a document
    with labels of both kinds is not good. Repeated rows are judged alike.
    """
    measured = stored(measures(docs, key, text, stratum), "quality")
    limits = stored(cutoffs(measured, labels, key, alpha, delta), "cutoffs")
    limits = limits.select(F.col("stratum").alias("__s"), *[F.col(r).alias(f"__{r}") for r in RULES])
    if limits.count() <= STRATA:
        limits = F.broadcast(limits)
    rows = measured.join(limits, measured["stratum"].eqNullSafe(F.col("__s")), "left")
    fine = ~F.col("base_failed")
    for rule, value in rule_values().items():
        fine = fine & F.coalesce(value <= F.col(f"__{rule}"), F.lit(True))
    return rows.select(
        key, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", fine.alias("kept")
    )


def keep_good(docs: DataFrame, labels: DataFrame, key: str = "doc_id", **options) -> DataFrame:
    """Documents that pass, all columns as they are; needs ids that are unique and not NULL."""
    passed = judge(docs, labels, key, **options).where("kept").select(key).distinct()
    return docs.join(passed, key, "left_semi").select(*docs.columns)
