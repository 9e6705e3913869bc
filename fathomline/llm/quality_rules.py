"""Quality rules whose cutoffs are chosen on labelled holdouts with a controlled risk.

A document's rates (symbols, capitals, repeated lines, repeated words) are put in fixed
units; its score is the worst of them, so one joint cutoff rules on all rates and the risk is
not split between them. In each stratum (language) the cutoff is an order statistic of the
scores of labelled good documents: the score that just k of n exceed, with the largest k for
which the exact binomial tail ``P(Bin(n, RISK) <= k)`` is at most the error level. This is the
exact upper confidence bound of the false rejection rate being at most ``RISK``, for any
distribution of scores. The error level is divided by the number of strata and one more
(Bonferroni), so with probability ``1 - ERROR`` no cutoff rejects more than ``RISK`` of the
good documents it is made for. Strata with too few labels share one common cutoff.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fathomline.functions.binding import let
from fathomline.llm.columns import small, words
from fathomline.operators.numbering import row_numbers
from fathomline.session import written

# Share of a stratum's good documents that the cutoff may reject, and the probability that any stratum's cutoff rejects more.
RISK = 0.015
ERROR = 0.05
# What counts as one unit of each rate, so that one score tells the worst of them. Fixed before any label is seen.
UNITS = {"symbol_rate": 0.1, "upper_rate": 0.2, "dup_line_rate": 0.5, "repeat_rate": 0.3}


def _repeat_words(w: Column) -> Column:
    """Words covered by 3-word windows that occur twice or more, the first included.

    Windows are compared by a 64-bit hash. Hashes are sorted with their positions,
    so the cost is n log n for texts of any length; a text whose windows all differ
    needs no sort.
    """
    n = F.size(w)
    hashes = F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))

    def covered(h: Column) -> Column:
        placed = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def twice(s: Column) -> Column:
            same = F.transform(s, lambda x, i: F.when(
                (F.get(s, i - 1)["h"] == x["h"]) | (F.get(s, i + 1)["h"] == x["h"]), x["i"]))
            return F.sort_array(F.filter(same, lambda p: p.isNotNull()))

        def spanned(p: Column) -> Column:
            steps = F.transform(p, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(p, i + 1) - x, F.lit(3))))
            return F.aggregate(steps, F.lit(0), lambda a, x: a + x)

        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(let(let(placed, twice), spanned))

    return F.when(n < 3, F.lit(0)).otherwise(let(hashes, covered)).cast("long")


def features(docs: DataFrame, keep: list[str]) -> DataFrame:
    """Base figures and rates of every whole text; a null text has no words."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    base = docs.select(
        *keep,
        let(words(text), lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"), F.char_length(F.array_join(w, "")).cast("long").alias("word_chars"),
            _repeat_words(w).alias("n_repeat_words"))).alias("_w"),
        F.char_length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        F.char_length(F.regexp_replace(text, r"\P{Lu}+", "")).cast("long").alias("n_upper"),
        let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"))).alias("_l"),
    ).select(*keep, "_w.*", "n_symbols", "n_upper", "_l.*")
    per = lambda part, whole: F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(F.lit(0.0))
    return base.withColumns({
        "base_failed": (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")),
        "symbol_rate": per("n_symbols", "n_words"), "upper_rate": per("n_upper", "word_chars"),
        "dup_line_rate": per("n_dup_lines", "n_lines"), "repeat_rate": per("n_repeat_words", "n_words"),
    }).withColumn("score", F.greatest(*[F.col(rate) / F.lit(unit) for rate, unit in UNITS.items()]))


def allowed_rejections(n: Column, risk: float, level: Column) -> Column:
    """Largest k with ``P(Bin(n, risk) <= k) <= level``, summed exactly in logarithms; -1 if there is none.

    If the true share of good documents above a cutoff were over ``risk``, so few above it
    among ``n`` would be seen with probability ``level`` at most.
    """
    first = let(F.exp(n * math.log1p(-risk)), lambda p: F.struct((n * math.log1p(-risk)).alias("log"), p.alias("sum"), F.when(p <= level, 0).otherwise(-1).cast("long").alias("k")))
    step = math.log(risk / (1 - risk))

    def add(acc: Column, j: Column) -> Column:
        grown = let(acc["log"] + F.log((n - j + 1) / j) + step, lambda x: let(acc["sum"] + F.exp(x), lambda total: F.struct(
            x.alias("log"), total.alias("sum"), F.when(total <= level, j).otherwise(acc["k"]).alias("k"))))
        return grown

    upto = F.floor(n * risk).cast("long")
    return F.when(upto < 1, first["k"]).otherwise(F.aggregate(F.sequence(F.lit(1).cast("long"), F.greatest(upto, F.lit(1))), first, add)["k"])


def certified_cutoffs(labelled: DataFrame, stratum: str, risk: float = RISK, error: float = ERROR) -> tuple[DataFrame, DataFrame]:
    """(stratum, group, n, cut) of every labelled stratum, and the cutoff of the common group in one row or none.

    ``labelled`` holds the stratum and the score of good labelled documents. A stratum whose
    labels allow no rejection joins the common group of all such strata, which also stands in
    for strata without labels; its guarantee holds for that group as a whole. ``cut`` is the
    score that just ``k`` of the n labelled documents exceed, null where even k = 0 is not
    certified. The error is shared by all strata and the common group. The scores are ranked
    over all tasks, so a stratum may have any number of labels.
    """
    sizes = labelled.groupBy(stratum).agg(F.count(F.lit(1)).alias("n"))
    level = F.lit(error) / (F.count(F.lit(1)).over(Window.partitionBy(F.lit(0))) + 1)
    strata = written(sizes.withColumn("level", level).withColumn("group", F.when(allowed_rejections(F.col("n"), risk, F.col("level")) >= 0, F.col(stratum))), "quality_strata")
    groups = strata.groupBy("group").agg(F.sum("n").alias("n"), F.any_value("level").alias("level"))
    allowed = groups.select(F.col("group").alias("_group"), "n", allowed_rejections(F.col("n"), risk, F.col("level")).alias("k")).where("k >= 0")
    # equal scores may change places; the tie only keeps them from one task
    grouped = labelled.join(small(strata.select(stratum, "group")), stratum).select("group", "score", F.rand(1).alias("tie"))
    ranked = row_numbers(grouped, ["group"], [F.desc("score"), F.col("tie")], "place")
    cuts = written(ranked.join(small(allowed), F.col("group").eqNullSafe(F.col("_group")) & (F.col("place") == F.col("k") + 1)).select("group", F.col("score").alias("cut")), "quality_cutoffs")
    named = cuts.select(F.col("group").alias("_group"), "cut")
    return strata.join(named, F.col("group").eqNullSafe(F.col("_group")), "left").select(stratum, "group", "n", "cut"), cuts.where("group IS NULL").select("cut")


def quality_rules(docs: DataFrame, labels: DataFrame, stratum: str = "lang", risk: float = RISK, error: float = ERROR) -> DataFrame:
    """Figures, ``base_failed``, score, cut and ``kept`` of every document.

    ``docs`` needs doc_id, text and the stratum column (null is a stratum of its own),
    ``labels`` doc_id and quality. Other columns are ignored. Repeated rows stay; a
    document with several labels counts as good if all of them are 1. Cutoffs are chosen on
    good documents that pass the base rules. Without labels none is certified and only the
    base rules reject; an empty table gives none.
    """
    rates = written(features(docs.select("doc_id", F.coalesce(F.col(stratum).cast("string"), F.lit("und")).alias("_s"), "text"), ["doc_id", "_s"]), "quality_rules")
    good = labels.groupBy("doc_id").agg(F.min("quality").alias("_q")).where("_q = 1").select("doc_id")
    strata, common = certified_cutoffs(rates.where("NOT base_failed").join(good, "doc_id", "left_semi").select("_s", "score"), "_s", risk, error)
    judged = rates.join(small(strata.select("_s", F.lit(True).alias("_known"), F.col("cut").alias("_cut"))), "_s", "left")
    cut = F.when(F.col("_known"), F.col("_cut")).otherwise(F.lit(next((r["cut"] for r in common.collect()), None)).cast("double"))
    kept = ~F.col("base_failed") & F.coalesce(F.col("score") <= cut, F.lit(True))
    return judged.withColumns({"cut": cut, "kept": kept}).drop("_known", "_cut").withColumnRenamed("_s", "stratum")
