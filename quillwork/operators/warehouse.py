"""Star-schema reports over purchases, customers, payment methods and amenities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillwork.operators.median import summary_with_median
from quillwork.operators.sizing import join_measured, settle_measured


def average_by_method(purchases: DataFrame, methods: DataFrame, customers: DataFrame,
                      province: str = "ON") -> DataFrame:
    """Mean purchase per payment method for customers of one province.

    Purchases are first summed per payment method id.  The two joins and that sum all partition on
    their keys, and a method used by a third of all purchases is one row by the time it is joined.
    """
    local = customers.filter(F.col("province") == province).select("custid")
    methods_here = methods.join(local, "custid").select("pmid", "mtype")
    paid = purchases.groupBy("pmid").agg(
        F.sum("amount").alias("_sum"), F.count(F.lit(1)).alias("_rows")
    )
    return (
        paid.join(methods_here, "pmid").groupBy(F.col("mtype").alias("payment_method"))
        .agg((F.sum("_sum").cast("double") / F.sum("_rows")).alias("average_amount"))
    )


def area_view(customers: DataFrame, prefixes: DataFrame) -> DataFrame:
    """Customers with a 0/1 flag: does the postal prefix belong to the area?

    The prefix list is made distinct first, since repeated prefixes would multiply customers, and
    measured, so that customers of one crowded prefix do not meet in one task.
    """
    listed, size = settle_measured(
        prefixes.select(F.col("pcprefix").alias("_vp"), F.lit(1).alias("_in")).distinct()
    )
    placed = customers.withColumn("_vp", F.substring("postalcode", 1, 3))
    return join_measured(placed, listed, size, ["_vp"], "left").select(
        "custid", F.coalesce("_in", F.lit(0)).alias("in_area")
    )


def visitor_segments(purchases: DataFrame, area: DataFrame, customers: DataFrame,
                     home_province: str = "BC") -> DataFrame:
    """Count, mean and median purchase of three groups: area, rest of the province, elsewhere.

    The segment of each customer is settled first.  Joined in one go, the three tables would share
    a stage on ``custid``, in which adaptive execution cannot split the purchases of a customer who
    holds a large part of them; against a settled table it can.
    """
    segments = area.join(customers.select("custid", "province"), "custid").select(
        "custid",
        ((F.col("in_area") == 0) & F.coalesce(F.col("province") == home_province, F.lit(False)))
        .alias("from_province_only"),
        (F.col("in_area") == 1).alias("from_area"),
    )
    segments, size = settle_measured(segments)
    facts = join_measured(purchases.select("custid", "amount"), segments, size, ["custid"])
    report = summary_with_median(facts, ["from_province_only", "from_area"], "amount")
    return report.select(
        "from_province_only", "from_area", F.col("n_rows").alias("count"),
        F.try_divide(F.col("total").cast("double"), F.col("count")).alias("average"), "median",
    )


def tag(tags: str, key: str, kind: T.DataType) -> Column:
    """A field of semi-structured data (map, struct, variant or JSON text); NULL when missing."""
    if isinstance(kind, T.MapType):
        return F.try_element_at(F.col(tags), F.lit(key))
    if isinstance(kind, T.StructType):
        return F.col(f"{tags}.{key}") if key in kind.names else F.lit(None).cast("string")
    if isinstance(kind, T.VariantType):
        return F.try_variant_get(F.col(tags), f"$.{key}", "string")
    return F.get_json_object(F.col(tags), f"$.{key}")


def amenities_with_tag(amenities: DataFrame, key: str, pattern: str, kind: str) -> DataFrame:
    """Ids of amenities of one kind whose tag matches a pattern, upper and lower case alike."""
    value = tag("tags", key, amenities.schema["tags"].dataType)
    return amenities.filter(value.ilike(pattern) & (F.col("amenity") == kind)).select("amenid")


def average_at_tagged(purchases: DataFrame, amenities: DataFrame, area: DataFrame,
                      key: str = "cuisine", pattern: str = "%sushi%",
                      kind: str = "restaurant") -> DataFrame:
    """Mean purchase at matching amenities, for customers inside and outside the area."""
    chosen = amenities_with_tag(amenities, key, pattern, kind)
    spent = (
        purchases.select("amenid", "custid", "amount").join(chosen, "amenid", "left_semi")
        .groupBy("custid").agg(F.sum("amount").alias("_sum"), F.count(F.lit(1)).alias("_rows"))
    )
    return (
        spent.join(area, "custid").groupBy("in_area")
        .agg((F.sum("_sum").cast("double") / F.sum("_rows")).alias("avg"))
    )


def average_on_days(purchases: DataFrame, days: DataFrame, name: str) -> DataFrame:
    """Count and mean amount of the purchases on days of one name, by date.

    ``days`` (``date, holiday``) is measured before it is broadcast.  On a table partitioned by
    ``pdate`` its dates prune directories at run time, before any is read.
    """
    listed, size = settle_measured(days.filter("holiday is not null").distinct())
    chosen = listed.filter(F.col("holiday") == name).select(F.col("date").alias("pdate"))
    return join_measured(purchases, chosen, size, ["pdate"]).groupBy("pdate").agg(
        F.count(F.lit(1)).alias("purchases"), F.avg("amount").cast("double").alias("avg"))


def average_by_day(purchases: DataFrame, month: int = 8, days: tuple[int, ...] = (1, 2, 3, 4, 5),
                   date: str = "pdate", amount: str = "amount") -> DataFrame:
    """Mean amount per date for chosen days of one month.

    On a table partitioned by ``pdate`` the calendar test prunes directories before any read.
    """
    chosen = (F.month(date) == month) & F.dayofmonth(date).isin(*days)
    return purchases.filter(chosen).groupBy(date).agg(F.avg(amount).cast("double").alias("avg"))
