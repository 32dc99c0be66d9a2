"""Stratified split and prediction scores per group."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablevet.functions.ordered import ranked, running_sums
from tablevet.operators.profile import share
from tablevet.session import staged


def split_80_20(df: DataFrame, key: str, target: str, train_share: float = 0.8) -> DataFrame:
    """Adds ``part``: in each class the first 80 % (rounded up) by the key's digest train.

    The digest orders rows the same way on every run; ``key`` must be unique. Only digest, key and class
    are ranked; each class keeps the place of its last training row, and rows compare with that.
    """
    place = F.struct(F.md5(F.col(key).cast("string")).alias("digest"), F.col(key).alias("key"))
    slim = df.select(F.col(target).alias("_class"), place.alias("_place"))
    numbered = ranked(slim, ["_class"], [F.asc("_place")], "_rank")
    last = F.col("_rank") == F.ceil(F.col("_rank_total") * train_share)
    cuts = staged(numbered.where(last).select("_class", F.col("_place").alias("_cut")), "cuts")
    trains = F.coalesce(place <= F.col("_cut"), F.lit(False))
    return (
        df.join(cuts, F.col(target).eqNullSafe(F.col("_class")), "left")
        .withColumn("part", F.when(trains, "train").otherwise("test"))
        .drop("_class", "_cut")
    )


def classification_scores(df: DataFrame, group: str, label: str, prediction: str) -> DataFrame:
    """Accuracy and macro precision, recall and F1 over the classes labelled or predicted.

    Rows are folded to the confusion counts of each group first; everything after is tiny.
    """
    confusion = df.groupBy(group, F.col(label).alias("_l"), F.col(prediction).alias("_p")).agg(
        F.count("*").alias("_n")
    )
    sides = confusion.select(
        group,
        F.explode(
            F.array(
                F.struct(F.col("_l").alias("cls"), F.lit(True).alias("actual")),
                F.struct(F.col("_p").alias("cls"), F.lit(False).alias("actual")),
            )
        ).alias("_s"),
        (F.col("_l") == F.col("_p")).alias("_hit"),
        "_n",
    ).select(group, "_s.*", "_hit", "_n")
    zero = F.lit(0)
    classes = sides.groupBy(group, "cls").agg(
        F.coalesce(F.sum(F.when(F.col("actual") & F.col("_hit"), F.col("_n"))), zero).alias("hits"),
        F.coalesce(F.sum(F.when(F.col("actual"), F.col("_n"))), zero).alias("actual"),
        F.coalesce(F.sum(F.when(~F.col("actual"), F.col("_n"))), zero).alias("predicted"),
    )
    none = F.lit(0.0)
    per_class = classes.select(
        group,
        "hits",
        "actual",
        F.coalesce(share(F.col("hits"), F.col("predicted")), none).alias("precision"),
        F.coalesce(share(F.col("hits"), F.col("actual")), none).alias("recall"),
        F.coalesce(share(2 * F.col("hits"), F.col("actual") + F.col("predicted")), none).alias("f1"),
    )
    return per_class.groupBy(group).agg(
        (F.sum("hits") / F.sum("actual")).alias("accuracy"),
        F.avg("precision").alias("macro_precision"),
        F.avg("recall").alias("macro_recall"),
        F.avg("f1").alias("macro_f1"),
    )


def roc_auc(df: DataFrame, group: str, label: str, score: str) -> DataFrame:
    """Area under the ROC curve by rank sum, ties at half; ``label`` is 0 or 1.

    NULL when a group has one class only. Rows without a score or label have no rank and are left out.
    """
    known = df.where(F.col(score).isNotNull() & F.col(label).isNotNull())
    counts = known.groupBy(group, score).agg(
        F.sum(F.col(label).cast("bigint")).alias("_pos"),
        F.sum(1 - F.col(label).cast("bigint")).alias("_neg"),
    )
    placed = running_sums(counts, [group], [F.asc(score)], {"_neg_to_here": "_neg"})
    pairs = (F.col("_neg_to_here") - F.col("_neg") / 2) * F.col("_pos")
    totals = placed.groupBy(group).agg(
        F.sum(pairs).alias("_won"), (F.sum("_pos").cast("double") * F.sum("_neg")).alias("_all")
    )
    return totals.select(group, share(F.col("_won"), F.col("_all")).alias("auc"))


def regression_scores(df: DataFrame, group: str, label: str, prediction: str) -> DataFrame:
    """R2, RMSE and MAE over rows with both values; R2 is NULL where the label is constant."""
    error = F.col(label) - F.col(prediction)
    sums = df.where(error.isNotNull()).groupBy(group).agg(
        F.avg(error * error).alias("_mse"),
        F.avg(F.abs(error)).alias("mae"),
        F.var_pop(label).alias("_var"),
    )
    return sums.select(
        group,
        (1 - share(F.col("_mse"), F.col("_var"))).alias("r2"),
        F.sqrt("_mse").alias("rmse"),
        "mae",
    )
