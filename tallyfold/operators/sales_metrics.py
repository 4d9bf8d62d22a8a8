"""Per-file sales metrics over a checked table.

Every metric is an aggregate with a map-side part, keyed by ``path`` or
``(path, key)``; a file that holds a third of all rows costs one row per map
task and key. Files that fail as a whole get the empty values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallyfold.operators.verdict import any_fatal, arg_max, is_reject, is_valid


def _unless_failed(value: Column, empty: Column, failed: Column | None = None) -> Column:
    return F.when(any_fatal() if failed is None else failed, empty).otherwise(F.coalesce(value, empty))


# Amounts are added as decimals, so that a sum does not depend on the order of
# its rows; amounts of 30 digits and more are beyond them and added as doubles.
_EXACT = "decimal(38,9)"


def exact(amount: str) -> Column:
    return F.col(amount).try_cast(_EXACT)


def beyond(amount: str) -> Column:
    """What ``exact`` leaves out."""
    return F.when(exact(amount).isNull(), F.col(amount))


def exact_sum(amount: str) -> Column:
    """Aggregate: the sum of amounts, rounded once at the end."""
    small, large = F.sum(exact(amount)).cast("double"), F.sum(beyond(amount))
    return F.when(large.isNull(), small).otherwise(large + F.coalesce(small, F.lit(0.0)))


def total_sales(checked: DataFrame) -> DataFrame:
    return checked.groupBy("path").agg(_unless_failed(exact_sum("net"), F.lit(0.0)).alias("total_sales"))


def unique_products(checked: DataFrame) -> DataFrame:
    n = F.count_distinct("product")
    return checked.groupBy("path").agg(_unless_failed(n, F.lit(0).cast("bigint")).alias("unique_products"))


def _top(checked: DataFrame, key: str, total: Column, name: str, value: str) -> DataFrame:
    sums = checked.groupBy("path", key).agg(total.alias("v"), any_fatal().alias("fatal"))
    best = sums.groupBy("path").agg(arg_max(F.col("v"), F.col(key)).alias("best"), any_fatal().alias("failed"))
    shown = F.when(~F.col("failed"), F.col("best"))
    return best.select("path", shown["key"].alias(name), (F.lit(0) - shown["neg"]).alias(value))


def top_product(checked: DataFrame) -> DataFrame:
    """The product with the most units; a total beyond 38 digits is the most, shown as NULL."""
    return _top(checked, "product", F.try_sum("quantity"), "top_product", "top_product_units")


def top_category(checked: DataFrame) -> DataFrame:
    """The category with the highest revenue."""
    return _top(checked, "category", exact_sum("net"), "top_category", "top_category_revenue")


def average_discount(checked: DataFrame) -> DataFrame:
    return checked.groupBy("path").agg(_unless_failed(exact_sum("discount_pct") / F.count("discount_pct"), F.lit(0.0)).alias("avg_discount_pct"))


def date_range(checked: DataFrame) -> DataFrame:
    none = F.lit(None).cast("date")
    return checked.groupBy("path").agg(
        _unless_failed(F.min("date"), none).alias("date_from"),
        _unless_failed(F.max("date"), none).alias("date_to"),
    )


def sales_cube(checked: DataFrame) -> DataFrame:
    """The one reduction all sales results can be derived from.

    A single pass over the lines, a single shuffle by
    ``(path, product, category)``; skipped and rejected lines fall into the
    group with NULL keys and keep their file visible.
    """
    return checked.groupBy("path", "product", "category").agg(
        F.count_if(is_valid()).alias("n_valid"),
        F.count_if(is_reject()).alias("n_reject"),
        any_fatal().alias("fatal"),
        F.sum(exact("net")).alias("net"),
        F.sum(beyond("net")).alias("net_beyond"),
        F.try_sum("quantity").alias("units"),
        F.sum(exact("discount_pct")).alias("discount"),
        F.min("date").alias("date_from"),
        F.max("date").alias("date_to"),
    )


def cube_sales() -> Column:
    """Aggregate over cube rows: their sales."""
    small, large = F.sum("net").cast("double"), F.sum("net_beyond")
    return F.when(large.isNull(), small).otherwise(large + F.coalesce(small, F.lit(0.0)))


def sales_metrics(cube: DataFrame) -> DataFrame:
    """All sales metrics and line counts, one row per file, from the cube."""
    files = cube.groupBy("path").agg(
        F.sum("n_valid").alias("n_valid"),
        F.sum("n_reject").alias("n_reject"),
        any_fatal().alias("failed"),
        cube_sales().alias("net"),
        F.sum("discount").cast("double").alias("discount"),
        F.min("date_from").alias("date_from"),
        F.max("date_to").alias("date_to"),
    )
    products = cube.groupBy("path", "product").agg(F.try_sum("units").alias("v"))
    products = products.groupBy("path").agg(
        F.count("product").alias("unique_products"), arg_max(F.col("v"), F.col("product")).alias("p")
    )
    categories = cube.groupBy("path", "category").agg(cube_sales().alias("v"))
    categories = categories.groupBy("path").agg(arg_max(F.col("v"), F.col("category")).alias("c"))
    failed = F.col("failed")
    shown = lambda c: F.when(~failed, c)
    return (
        files.join(products, "path")
        .join(categories, "path")
        .select(
            "path", "failed",
            F.when(failed, 0).otherwise(F.col("n_valid")).alias("n_valid"),
            F.col("n_reject"),
            _unless_failed(F.col("net"), F.lit(0.0), failed).alias("total_sales"),
            _unless_failed(F.col("unique_products"), F.lit(0).cast("bigint"), failed).alias("unique_products"),
            shown(F.col("p.key")).alias("top_product"),
            shown(F.lit(0) - F.col("p.neg")).alias("top_product_units"),
            shown(F.col("c.key")).alias("top_category"),
            shown(-F.col("c.neg")).alias("top_category_revenue"),
            _unless_failed(F.try_divide("discount", "n_valid"), F.lit(0.0), failed).alias("avg_discount_pct"),
            shown(F.col("date_from")).alias("date_from"),
            shown(F.col("date_to")).alias("date_to"),
        )
    )
