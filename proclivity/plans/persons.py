"""Person-level table derived from the star schema: one row per customer.

Line items are first reduced to one row per order, orders then to one row per customer, so
the two big tables meet on unique order keys and each is shuffled once. Every aggregate has
a partial form, hence a customer or order that holds a large share of all rows stays cheap.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from proclivity.session import materialize

CUTOFF = "2001-06-01"
LAST_YEAR = "2000-06-01"


def table(spark: SparkSession, data_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{data_dir}/{name}.parquet")


def _orders_with_lines(spark: SparkSession, data_dir: str) -> DataFrame:
    returned = F.col("l_returnflag") == "R"
    last_year = F.col("l_shipdate") >= F.lit(LAST_YEAR).cast("timestamp_ntz")
    lines = (
        table(spark, data_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            F.count(F.lit(1)).alias("lines"),
            F.count_if(returned).alias("lines_returned"),
            F.count_if(last_year).alias("lines_year"),
            F.count_if(last_year & returned).alias("lines_year_returned"),
        )
    )
    orders = table(spark, data_dir, "orders")
    return orders.join(lines, orders.o_orderkey == lines.l_orderkey, "left")


def _per_customer(spark: SparkSession, data_dir: str) -> DataFrame:
    date = F.col("o_orderdate")
    before = date < F.lit(CUTOFF).cast("timestamp_ntz")
    amount = F.col("o_totalprice").cast("decimal(18,2)")
    ago = (2001 - F.year(date)) * 12 + 6 - F.month(date)
    card = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    recent = before & (ago <= 36)
    sequence = (F.year(date) * 10000 + F.month(date) * 100 + F.day(date)).cast("long") * F.lit(
        1_000_000_000
    ) + F.col("o_orderkey")

    def total(value: Column, where: Column) -> Column:
        return F.sum(F.when(where, value))

    return (
        _orders_with_lines(spark, data_dir)
        .groupBy("o_custkey")
        .agg(
            F.max(F.when(before, 0).otherwise(1)).alias("came_back"),
            F.count_if(before).alias("gifts"),
            F.count_if(before & card).alias("card_gifts"),
            F.count_if(recent).alias("recent"),
            F.count_if(recent & card).alias("recent_card"),
            total(amount, before).cast("double").alias("amount"),
            total(amount, recent).cast("double").alias("recent_amount"),
            total(amount, recent & card).cast("double").alias("recent_card_amount"),
            F.max(F.when(before, amount)).cast("double").alias("max_amount"),
            F.min(F.when(before, amount)).cast("double").alias("min_amount"),
            F.max(F.when(before, ago)).alias("first_ago"),
            F.min(F.when(before, ago)).alias("last_ago"),
            F.max_by(amount, F.when(before, sequence)).cast("double").alias("last_amount"),
            F.max_by("o_orderstatus", F.when(before, sequence)).alias("last_status"),
            total(F.col("lines"), before).alias("lines"),
            total(F.col("lines_returned"), before).alias("lines_returned"),
            total(F.col("lines_year"), before).alias("lines_year"),
            total(F.col("lines_year_returned"), before).alias("lines_year_returned"),
        )
    )


def build_person_frame(spark: SparkSession, data_dir: str) -> DataFrame:
    """The person table as a lazy plan over customer, orders and lineitem."""
    customers = table(spark, data_dir, "customer").select(
        "c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment"
    )
    history = _per_customer(spark, data_dir)
    c = F.col("c_custkey")
    had = F.col("gifts") > 0

    def d(column: Column) -> Column:
        return column.cast("double")

    def when_had(name: str) -> Column:
        return F.when(had, d(F.col(name)))

    gifts = when_had("gifts")
    recent = when_had("recent")
    recent_card = when_had("recent_card")
    nation = F.col("c_nationkey")
    months_last = when_had("last_ago")
    columns = {
        "CONTROL_NUMBER": c,
        "TARGET_B": F.coalesce(F.col("came_back"), F.lit(0)).cast("int"),
        "HOME_OWNER": F.when(c % 3 == 0, "U").otherwise("H"),
        "URBANICITY": F.when(c % 17 == 0, None)
        .when(c % 13 == 0, "?")
        .otherwise(F.substring("c_mktsegment", 1, 1)),
        "SES": F.when(c % 19 == 0, "?").otherwise((1 + nation % 4).cast("string")),
        "DONOR_GENDER": F.when(c % 23 == 0, None).when(c % 2 == 0, "F").otherwise("M"),
        "RECENCY_STATUS_96NK": F.col("last_status"),
        "DONOR_AGE": F.when(c % 4 == 0, None).otherwise(d((c * 7) % 110)),
        "CHILDREN": F.when(c % 29 == 0, F.lit(-1.0)).when(c % 7 == 0, None).otherwise(d(c % 4)),
        "INCOME_GROUP": F.when(c % 5 == 0, None).otherwise(d(1 + nation % 7)),
        "WEALTH_RATING": F.when((F.col("amount") < 2_000_000) | (c % 6 == 0), None).otherwise(
            d(c % 10)
        ),
        "MONTHS_SINCE_LAST_PROM_RESP": F.when(c % 31 == 0, None).otherwise(months_last),
        "MEDIAN_HOUSEHOLD_INCOME": d(F.col("c_acctbal")),
        "PER_CAPITA_INCOME": d(F.col("c_acctbal")) * F.lit(0.5),
        "MEDIAN_HOME_VALUE": d((c * 7919) % 6000),
        "PCT_ATTRIBUTE1": d((c * 31) % 101),
        "PCT_ATTRIBUTE2": d((c * 37) % 101),
        "PCT_ATTRIBUTE3": d((c * 41) % 101),
        "PCT_ATTRIBUTE4": d((c * 43) % 101),
        "PCT_OWNER_OCCUPIED": d((c * 47) % 101),
        "PEP_STAR": d(c % 2),
        "RECENT_STAR_STATUS": F.when(c % 10 == 0, d(1 + c % 7)).otherwise(F.lit(0.0)),
        "FREQUENCY_STATUS_97NK": F.least(F.lit(4.0), F.greatest(F.lit(1.0), recent)),
        "NUMBER_PROM_12": d(F.col("lines_year")),
        "CARD_PROM_12": d(F.col("lines_year_returned")),
        "LIFETIME_PROM": d(F.col("lines")),
        "LIFETIME_CARD_PROM": d(F.col("lines_returned")),
        "FILE_CARD_GIFT": when_had("card_gifts"),
        "LIFETIME_GIFT_AMOUNT": F.col("amount"),
        "LIFETIME_GIFT_COUNT": gifts,
        "LIFETIME_MAX_GIFT_AMT": F.col("max_amount"),
        "LIFETIME_MIN_GIFT_AMT": F.col("min_amount"),
        "LAST_GIFT_AMT": F.col("last_amount"),
        "MONTHS_SINCE_FIRST_GIFT": when_had("first_ago"),
        "MONTHS_SINCE_LAST_GIFT": months_last,
        "RECENT_AVG_GIFT_AMT": F.try_divide(F.col("recent_amount"), recent),
        "RECENT_AVG_CARD_GIFT_AMT": F.when(c % 37 == 0, F.lit(-5.0)).otherwise(
            F.try_divide(F.col("recent_card_amount"), recent_card)
        ),
        "RECENT_RESPONSE_COUNT": recent,
        "RECENT_CARD_RESPONSE_COUNT": recent_card,
        "RECENT_RESPONSE_PROP": F.when(c % 41 == 0, F.lit(1.5)).otherwise(
            F.try_divide(recent, gifts)
        ),
        "RECENT_CARD_RESPONSE_PROP": F.try_divide(recent_card, gifts),
    }
    joined = customers.join(history, customers.c_custkey == history.o_custkey, "left")
    return joined.select(*[column.alias(name) for name, column in columns.items()])


_frames: dict[tuple[str, str], DataFrame] = {}


def person_frame(spark: SparkSession, data_dir: str) -> DataFrame:
    """The person table, written once per application and then scanned column-wise."""
    key = (spark.sparkContext.applicationId, data_dir)
    if key not in _frames:
        _frames[key] = materialize(build_person_frame(spark, data_dir), "persons")
    return _frames[key]


def score_frame(spark: SparkSession, data_dir: str) -> DataFrame:
    """Key, target and a deterministic score with ties, for the evaluation operators."""
    c = F.col("CONTROL_NUMBER")
    score = F.round(((c * 37) % 101).cast("double") / 101, 4)
    return person_frame(spark, data_dir).select("CONTROL_NUMBER", "TARGET_B", score.alias("score"))
