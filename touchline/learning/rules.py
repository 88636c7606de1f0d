"""Association rules between the items of a basket."""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.operators.profile import argmax_abs


def basket(*items: Column) -> Column:
    """Array of items as text; NULL items are left out."""
    return F.array_distinct(F.array_compact(F.array(*[i.cast("string") for i in items])))


def with_metrics(rules: DataFrame) -> DataFrame:
    """Add confidence, lift, leverage, conviction and Zhang's metric.

    Needs the supports of the antecedent, the consequent and both.
    """
    a, c, ac = F.col("support_a"), F.col("support_c"), F.col("support")
    leverage = ac - a * c
    confidence = ac / a
    return rules.select(
        "antecedent", "consequent", "support_a", "support_c", "support",
        confidence.alias("confidence"),
        (confidence / c).alias("lift"),
        leverage.alias("leverage"),
        F.try_divide(F.lit(1.0) - c, F.lit(1.0) - confidence).alias("conviction"),
        F.try_divide(leverage, F.greatest(ac * (1 - a), a * (c - ac))).alias("zhang"),
    )


def association_rules(
    df: DataFrame, items: str, min_support: float = 0.01, min_confidence: float = 0.01
) -> DataFrame:
    """Rules with one consequent from baskets of any length, by FP-growth."""
    baskets = df.where(F.size(items) > 0).select(F.col(items).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(baskets)
    sides = F.array_join(F.array_sort("antecedent"), ","), F.array_join("consequent", ",")
    found = model.associationRules.select(
        sides[0].alias("antecedent"), sides[1].alias("consequent"),
        (F.col("support") / F.col("confidence")).alias("support_a"),
        (F.col("confidence") / F.col("lift")).alias("support_c"),
        "support",
    )
    return with_metrics(found)


def pair_rules(
    df: DataFrame, a: str, b: str, min_support: float = 0.01, min_confidence: float = 0.01
) -> DataFrame:
    """The same for baskets of exactly two columns, by counting alone.

    One aggregate shrinks the rows to (a, b, n); everything else runs on that.
    Baskets with a NULL item are left out.
    """
    pairs = (
        df.where(F.col(a).isNotNull() & F.col(b).isNotNull())
        .groupBy(F.col(a).cast("string").alias("_a"), F.col(b).cast("string").alias("_b"))
        .agg(F.count("*").alias("_n"))
    )
    total = pairs.agg(F.sum("_n").alias("_t")).scalar()
    by_a = pairs.groupBy("_a").agg((F.sum("_n") / total).alias("_sa"))
    by_b = pairs.groupBy("_b").agg((F.sum("_n") / total).alias("_sb"))
    both = pairs.join(by_a, "_a").join(by_b, "_b").withColumn("_s", F.col("_n") / total)

    def rule(frm, to, sa, sb):
        return F.struct(
            F.col(frm).alias("antecedent"), F.col(to).alias("consequent"),
            F.col(sa).alias("support_a"), F.col(sb).alias("support_c"), F.col("_s").alias("support"),
        )

    both = both.where(F.col("_s") >= min_support)
    two_way = both.select(F.explode(F.array(rule("_a", "_b", "_sa", "_sb"), rule("_b", "_a", "_sb", "_sa"))).alias("_r"))
    return with_metrics(two_way.select("_r.*")).where(F.col("confidence") >= min_confidence)


def most_significant(rules: DataFrame) -> DataFrame:
    """The rule with the greatest absolute Zhang metric."""
    return argmax_abs(rules, "zhang", ["antecedent", "consequent"])


def one_hot_items(df: DataFrame, row_id: str, items: str) -> DataFrame:
    """(row, item, 1) triples: the sparse form of the one-hot basket matrix."""
    return df.select(row_id, F.explode(items).alias("item")).withColumn("present", F.lit(1))
