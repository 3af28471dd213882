"""Quality rules with risk-controlled thresholds.

Every rule rejects a document whose measure exceeds a cutoff. Cutoffs come from
a labelled holdout, stratum by stratum: a candidate may be used only if an exact
binomial test shows, at a level corrected for all tests made (strata x rules x
candidates, Bonferroni), that it rejects less than its share ``risk / rules`` of
good documents. So with confidence ``1 - delta`` all rules together reject less
than ``risk`` of the good documents of every stratum. Strata with too few
labels certify nothing, and there the method rejects nothing.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import packed, prepare, stored, unpacked, words

#: rule: (measure, candidate cutoffs, fixed before any label is seen)
RULES = {
    "symbols": ("1.0 * n_symbols / n_words", (0.05, 0.1, 0.2, 0.3, 0.5, 1.0, 2.0)),
    "long_words": ("1.0 * word_chars / n_words", (6.5, 7.0, 7.5, 8.0, 8.5, 9.0, 10.0, 12.0)),
    "dup_lines": ("1.0 * n_dup_lines / n_lines", (0.05, 0.1, 0.2, 0.3, 0.4, 0.5)),
    "repeats": ("1.0 * n_repeat_words / n_words", (0.05, 0.1, 0.15, 0.2, 0.3, 0.4)),
    "bangs": ("1.0 * n_bangs / n_words", (0.05, 0.1, 0.2, 0.3, 0.5, 0.8)),
}
RISK, DELTA = 0.05, 0.05
#: A certified cutoff is used if it rejects a larger share of bad documents than so many times that of good ones.
COST = 20.0
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50


def with_measures(df: DataFrame, text: Column) -> DataFrame:
    """``df`` with the text counts that the rules use.

    n_repeat_words counts the words covered by 3-word windows that occur twice
    or more. Windows are sorted by (hash, position) within the row, so repeated
    ones are neighbours; 64-bit hashes are compared within one text only.
    """
    text = F.coalesce(text, F.lit(""))
    df = df.withColumn("m_words", words(text)).withColumn("m_lines", F.split(text, "\n"))
    df = df.withColumn("n_words", F.size("m_words").cast("long"))
    df = df.withColumn("word_chars", F.length(F.array_join("m_words", "")).cast("long"))
    df = df.withColumn("n_symbols", F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long"))
    df = df.withColumn("n_bangs", F.regexp_count(text, F.lit("!")).cast("long"))
    df = df.withColumn("m_lines", F.filter("m_lines", lambda x: x.rlike("[^ \\t-\\r]")))
    df = df.withColumn("n_lines", F.size("m_lines").cast("long"))
    df = df.withColumn("n_dup_lines", (F.size("m_lines") - F.size(F.array_distinct("m_lines"))).cast("long")).drop("m_lines")
    w = F.col("m_words")
    hashes = F.when(F.size(w) >= 3, F.transform(F.slice(w, 3, F.size(w)), lambda x, i: F.xxhash64(F.get(w, i), F.get(w, i + 1), x))).otherwise(F.array().cast("array<bigint>"))
    df = df.withColumn("m_hash", hashes).drop("m_words")
    some = F.size(F.array_distinct("m_hash")) < F.size("m_hash")
    df = df.withColumn("m_hash", F.when(some, F.array_sort(F.transform("m_hash", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    h = F.col("m_hash")
    again = F.transform(F.filter(F.transform(h, lambda x, k: F.struct(x["i"].alias("i"), ((x["h"] == F.get(h, k - 1)["h"]) | (x["h"] == F.get(h, k + 1)["h"])).alias("hit"))), lambda x: x["hit"]), lambda x: x["i"])
    df = df.withColumn("m_hit", F.array_sort(again)).drop("m_hash")
    hit = F.col("m_hit")
    # each repeated window adds the words that the one before did not cover: up to 3
    covered = F.aggregate(F.transform(hit, lambda x, k: F.least(F.lit(3), F.coalesce(x - F.get(hit, k - 1), F.lit(3)))), F.lit(0), lambda a, x: a + x)
    return df.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("m_hit")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def measure(rule: str) -> Column:
    """The rule's measure, 0 where its divisor is 0."""
    over, under = RULES[rule][0].removeprefix("1.0 * ").split(" / ")
    return F.when(F.col(under) > 0, F.col(over).cast("double") / F.col(under)).otherwise(F.lit(0.0))


def calibrate(measured: DataFrame, labels: DataFrame, risk: float = RISK, delta: float = DELTA, cost: float = COST) -> DataFrame:
    """Chosen cutoffs: stratum, rule, cutoff, false_rejected, good, allowed, true_rejected, bad.

    ``measured`` has doc_id, stratum and the counts; ``labels`` doc_id and
    quality (1 good, 0 bad; others and nulls are ignored). A document is one
    trial: repeated labels count once, contradictory ones not at all, and an id
    that several rows share is no trial, as its label may belong to any of them.
    Documents count as independent draws; copies under ids of their own are
    separate trials, so copies should be removed from a holdout. ``allowed`` is the
    largest number of false rejections k with P(Bin(good, risk / rules) <= k)
    <= delta / tests, the exact (Clopper-Pearson) bound turned round.
    """
    alpha = risk / len(RULES)
    known = labels.filter("quality in (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("other")).filter("quality = other").drop("other")
    once = measured.groupBy("doc_id").agg(F.count("*").alias("rows")).filter("rows = 1").drop("rows")
    held = measured.join(once, "doc_id").join(known, "doc_id")
    bins = F.array(*[F.struct(F.lit(r).alias("rule"), sum((F.when(measure(r) > c, 1).otherwise(0) for c in cuts), F.lit(0)).alias("over")) for r, (_, cuts) in RULES.items()])
    cells = held.select("stratum", "quality", F.explode(bins).alias("x")).groupBy("stratum", "quality", "x.rule", "x.over").count()
    cells = stored(cells, "rule-cells")
    cuts = F.create_map(*[x for r, (_, c) in RULES.items() for x in (F.lit(r), F.array(*map(F.lit, c)))])
    steps = cells.select("stratum", "quality", "rule", F.col("count").alias("n"), "over", F.posexplode(cuts[F.col("rule")]).alias("pos", "cutoff"))
    above = F.when(F.col("over") > F.col("pos"), F.col("n")).otherwise(0)
    tried = steps.groupBy("stratum", "rule", "cutoff").agg(
        F.sum(F.when(F.col("quality") == 1, above).otherwise(0)).alias("false_rejected"), F.sum(F.when(F.col("quality") == 1, F.col("n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("quality") == 0, above).otherwise(0)).alias("true_rejected"), F.sum(F.when(F.col("quality") == 0, F.col("n")).otherwise(0)).alias("bad"))
    strata = tried.select("stratum").distinct().count()
    tests = max(strata, 1) * sum(len(c) for _, c in RULES.values())
    tried = tried.join(allowed(tried.select("good").distinct(), alpha, delta / tests), "good")
    score = F.col("true_rejected") / F.greatest(F.col("bad"), F.lit(1)) - cost * F.col("false_rejected") / F.greatest(F.col("good"), F.lit(1))
    fit = tried.filter(F.col("false_rejected") <= F.col("allowed")).withColumn("score", score).filter("score > 0")
    return fit.groupBy("stratum", "rule").agg(F.max_by(F.struct("cutoff", "false_rejected", "good", "allowed", "true_rejected", "bad"), F.struct("score", "cutoff")).alias("x")).select("stratum", "rule", "x.*")


def allowed(goods: DataFrame, alpha: float, level: float) -> DataFrame:
    """``good`` with ``allowed``, the largest k with P(Bin(good, alpha) <= k) <= level; -1 if none.

    The terms are added in order, each from the one before in logarithms; they
    are looked at up to the mean, as the probability there is over any level used.
    """
    n = F.col("good").cast("double")
    odds = math.log(alpha) - math.log1p(-alpha)
    start = F.struct((n * math.log1p(-alpha)).alias("log"), F.exp(n * math.log1p(-alpha)).alias("p"), F.when(F.exp(n * math.log1p(-alpha)) <= level, 0).otherwise(-1).alias("k"))

    def step(a, i):
        log = a["log"] + F.log(n - i + 1) - F.log(i) + odds
        p = a["p"] + F.exp(log)
        return F.struct(log.alias("log"), p.alias("p"), F.when(p <= level, i).otherwise(a["k"]).alias("k"))

    most = F.ceil(n * alpha).cast("int")
    return goods.withColumn("allowed", F.when(most < 1, start["k"]).otherwise(F.aggregate(F.sequence(F.lit(1), F.greatest(most, F.lit(1))), start, step)["k"]))


def cutoff_columns(chosen: DataFrame) -> DataFrame:
    """One row a stratum that has a cutoff: ``cut_stratum`` (a struct, which joins null with null) and ``cut_<rule>``."""
    cuts = chosen.groupBy("stratum").agg(*[F.max(F.when(F.col("rule") == r, F.col("cutoff"))).alias(f"cut_{r}") for r in RULES])
    return stored(cuts.select(F.struct("stratum").alias("cut_stratum"), *[f"cut_{r}" for r in RULES]), "cutoffs")


def verdict() -> Column:
    """True unless a rule's measure exceeds its stratum's cutoff."""
    out = F.lit(False)
    for rule in RULES:
        out = out | F.coalesce(measure(rule) > F.col(f"cut_{rule}"), F.lit(False))
    return ~out


def judge(docs: DataFrame, labels: DataFrame, stratum: str = "lang", **options) -> DataFrame:
    """One row per document: doc_id, stratum, the counts, base_failed, kept.

    Null text has no words and fails the base rules; null strata form one
    stratum; any number of strata will do. Repeated rows are judged alike.
    Labels of unknown documents are ignored; without labels only the base rules
    reject.
    """
    prepare(docs.sparkSession)
    columns = ["doc_id", "stratum", "n_words", "word_chars", "n_symbols", "n_bangs", "n_lines", "n_dup_lines", "n_repeat_words"]
    measured = stored(with_measures(docs.select("doc_id", F.col(stratum).cast("string").alias("stratum"), "text"), F.col("text")).select(*columns), "measures")
    cuts = cutoff_columns(calibrate(measured, labels, **options))
    judged = measured.withColumn("cut_stratum", F.struct("stratum")).join(cuts, "cut_stratum", "left")
    return judged.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & verdict()).select(*columns, "base_failed", "kept")


def keep_good(docs: DataFrame, labels: DataFrame, stratum: str = "lang", **options) -> DataFrame:
    """``docs`` without the rows that ``judge`` rejects; any further columns stay."""
    prepare(docs.sparkSession)
    # all rows of a labelled id, so that ids which several rows share are seen
    narrow = with_measures(docs.join(labels.select("doc_id").distinct(), "doc_id", "left_semi").select("doc_id", F.col(stratum).cast("string").alias("stratum"), "text"), F.col("text")).drop("text")
    cuts = cutoff_columns(calibrate(stored(narrow, "measures"), labels, **options))
    rows = docs.select(packed(docs), F.col(stratum).cast("string").alias("stratum"))
    rows = with_measures(rows, F.col("row.text"))
    # with a column that is not deterministic, the filter does not move below the counts and repeat them
    rows = rows.withColumn("at", F.monotonically_increasing_id()).withColumn("cut_stratum", F.struct("stratum"))
    rows = rows.join(cuts, "cut_stratum", "left").filter((F.col("at") >= 0) & ~base_failed() & verdict())
    return unpacked(rows, docs.columns)


