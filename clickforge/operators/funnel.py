"""Conversion funnel and product view-to-cart conversion."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickforge.functions.columns import batch_keys, pct

# Funnel stage names.
STAGES = ["1_page_view", "2_product_view", "3_cart_add", "4_checkout"]


def funnel_stage_users(pv: DataFrame, prd: DataFrame, crt: DataFrame,
                       by="event_date") -> DataFrame:
    """four independent distinct-user counts per batch (not sequential):
    any page view, any product view, any cart ``add``, a ``checkout`` page view.

    One union of per-event flags, a per-(batch, user) ``max`` (partial-aggregated map
    side), then a per-batch ``sum``: no four-way distinct ``Expand``.
    """
    by = batch_keys(by)
    t, f = F.lit(1), F.lit(0)

    def flags(df, s1, s2, s3, s4):
        return df.select(*by, "user_id", s1.alias("s1"), s2.alias("s2"),
                         s3.alias("s3"), s4.alias("s4"))

    chk = F.when(F.col("page_type") == "checkout", 1).otherwise(0)
    add = F.col("action") == "add"
    u = (flags(pv, t, f, f, chk)
         .unionByName(flags(prd, f, t, f, f))
         .unionByName(flags(crt.filter(add), f, f, t, f)))
    per_user = u.groupBy(*by, "user_id").agg(*[F.max(c).alias(c) for c in
                                               ("s1", "s2", "s3", "s4")])
    return per_user.groupBy(*by).agg(
        F.coalesce(F.sum("s1"), F.lit(0)).cast("long").alias("page_view_users"),
        F.coalesce(F.sum("s2"), F.lit(0)).cast("long").alias("product_view_users"),
        F.coalesce(F.sum("s3"), F.lit(0)).cast("long").alias("cart_add_users"),
        F.coalesce(F.sum("s4"), F.lit(0)).cast("long").alias("checkout_users"))


def conversion_funnel(pv: DataFrame, prd: DataFrame, crt: DataFrame,
                      by="event_date") -> DataFrame:
    """one row per stage with ``users`` and ``conversion_rate_pct`` against stage 1
    (stage 1 is always 100.0; other stages are 0.0 when stage 1 has no users)."""
    by = batch_keys(by)
    s = funnel_stage_users(pv, prd, crt, by)
    base = F.col("page_view_users")
    stack = F.expr(
        "stack(4, '{0}', page_view_users, '{1}', product_view_users, "
        "'{2}', cart_add_users, '{3}', checkout_users) as (funnel_stage, users)"
        .format(*STAGES))
    rows = s.select(*by, base.alias("_base"), stack)
    rate = (F.when(F.col("funnel_stage") == STAGES[0], F.lit(100.0))
             .when(F.col("_base") > 0, pct("users", "_base"))
             .otherwise(F.lit(0.0)))
    return rows.select(*by, "funnel_stage", "users", rate.alias("conversion_rate_pct"))


def product_view_vs_cart(prd: DataFrame, crt: DataFrame, by="event_date",
                         min_views: int = 10, low_rate: float = 5.0) -> DataFrame:
    """views per ``(product_id, category, price)``, cart adds per product, left
    joined; ``is_low_conversion`` = views >= 10 and the *rounded* rate < 5.0.

    Both sides are aggregated before the join, so the join sees one row per product
    and batch; AQE turns it into a broadcast join from measured sizes when small.
    """
    by = batch_keys(by)
    views = prd.groupBy(*by, "product_id", "category", "price") \
               .agg(F.count(F.lit(1)).alias("total_views"))
    adds = crt.filter(F.col("action") == "add").groupBy(*by, "product_id") \
              .agg(F.count(F.lit(1)).alias("cart_adds"))
    rate = pct("cart_adds", "total_views")
    return (views.join(adds, [*by, "product_id"], "left")
                 .withColumn("cart_adds", F.coalesce("cart_adds", F.lit(0).cast("long")))
                 .withColumn("view_to_cart_rate", rate)
                 .withColumn("is_low_conversion",
                             (F.col("total_views") >= min_views)
                             & (F.col("view_to_cart_rate") < low_rate)))


def low_conversion_products(prd: DataFrame, crt: DataFrame, by="event_date",
                            **kw) -> DataFrame:
    """the products flagged by F3."""
    return product_view_vs_cart(prd, crt, by, **kw).filter(F.col("is_low_conversion"))
