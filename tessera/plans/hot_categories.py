"""Hot categories (top 10 by clicks, orders, pays) and their top sessions.

One pass over the visit log: each row is tagged with the single action it
carries (click, else order, else pay, tested in that order), its id list is
exploded, and three conditional sums are taken.  The aggregate is partial
(map-side) so a hot category never funnels raw rows into one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.topk import top_n_per_group


def tag_actions(visits: DataFrame) -> DataFrame:
    """(category_id, kind) per category mention; kind 0 click, 1 order, 2 pay."""
    kind = (F.when(F.col("click_category_id").isNotNull(), F.lit(0))
            .when(F.col("order_category_ids").isNotNull(), F.lit(1))
            .when(F.col("pay_category_ids").isNotNull(), F.lit(2)))
    ids = (F.when(kind == 0, F.array(F.col("click_category_id").cast("string")))
           .when(kind == 1, F.split("order_category_ids", ","))
           .when(kind == 2, F.split("pay_category_ids", ",")))
    return (visits.select(kind.alias("kind"), ids.alias("ids"))
            .where(F.col("kind").isNotNull())
            .select("kind", F.explode("ids").alias("cid"))
            .select(F.col("cid").try_cast("bigint").alias("category_id"), "kind")
            .where("category_id is not null"))  # empty or no number: not a category


def category_counts(visits: DataFrame) -> DataFrame:
    t = tag_actions(visits)
    return t.groupBy("category_id").agg(
        F.sum(F.when(F.col("kind") == 0, 1).otherwise(0)).cast("bigint").alias("click_cnt"),
        F.sum(F.when(F.col("kind") == 1, 1).otherwise(0)).cast("bigint").alias("order_cnt"),
        F.sum(F.when(F.col("kind") == 2, 1).otherwise(0)).cast("bigint").alias("pay_cnt"),
    )


def hot_categories(visits: DataFrame, n: int = 10) -> DataFrame:
    """Top ``n`` categories by (clicks, orders, pays) desc; ties by id asc.

    ``orderBy().limit()`` plans as TakeOrderedAndProject: every task keeps
    its own top n and only those reach the final merge.
    """
    return (category_counts(visits)
            .orderBy(F.desc("click_cnt"), F.desc("order_cnt"), F.desc("pay_cnt"),
                     F.asc("category_id"))
            .limit(n))


def hot_category_sessions(visits: DataFrame, n_categories: int = 10, n_sessions: int = 10) -> DataFrame:
    """For the hot categories: top sessions by clicks (ties by session id).

    The hot list holds at most ``n_categories`` rows (a limit), so it is
    broadcast into a semi join; clicks are counted per (category, session)
    with a partial aggregate and cut per category by a row_number limit that
    Spark evaluates as a WindowGroupLimit before its shuffle.
    """
    hot = hot_categories(visits, n_categories).select("category_id")
    clicks = (visits.where(F.col("click_category_id").isNotNull())
              .select(F.col("click_category_id").alias("category_id"), "session_id"))
    counts = (clicks.join(F.broadcast(hot), "category_id", "left_semi")
              .groupBy("category_id", "session_id")
              .agg(F.count(F.lit(1)).alias("click_cnt")))
    return top_n_per_group(counts, ["category_id"], [F.desc("click_cnt"), F.asc("session_id")],
                           n_sessions, rank_col="rn")
