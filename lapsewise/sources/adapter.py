"""Adapter: the driver's TPC-H style tables → the raw insurance star schema.

Every domain column is a deterministic expression of driver columns, so the
raw tables grow with the input and carry the defects the cleaning stage is
built for (nulls, orphans, duplicate keys, negative amounts, inverted dates).
The same rules are written in DuckDB SQL in ``lapsewise.oracle``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions.columns import date_lit
from ..operators import ordered
from .io import read_driver

EPOCH = dt.date(1995, 1, 1)
CALENDAR_DAYS = 3650
MISSING_DAY_EVERY = 29

# --- fixed values: adapter mappings ------------------------------------------
TENURE_BY_CUSTKEY_MOD10 = (1, 2, 3, 4, 5, 10, 15, 20, 25, 30)
STATUS_BY_ORDERSTATUS = (("F", K.LAPSED), ("O", K.ACTIVE))
PENDING_STATUS_BY_CUSTKEY_MOD4 = (K.MATURED, K.CLAIMED, K.CANCELLED, K.IN_GRACE)
STATUS_BY_EVENT_TYPE = (("view", K.ACTIVE), ("click", K.IN_GRACE), ("signup", K.LAPSED),
                        ("error", K.CANCELLED), ("purchase", K.CLAIMED))
PAYMENT_STEP_BY_ORDERKEY_MOD5 = (30, 91, 182, 365, 57)
PRODUCTS = ((1, "Term Shield", "Protection"), (2, "Whole Life Secure", "Savings"),
            (3, "Child Future Plan", "Savings"), (4, "Wealth ULIP", "Investment"))
CHANNELS = ((1, "Agent Network", "Assisted"), (2, "Direct Sales", "Assisted"), (3, "Digital", "Online"))


def _lookup(key: Column, pairs, default=None) -> Column:
    out = None
    for k, v in pairs:
        out = F.when(key == k, F.lit(v)) if out is None else out.when(key == k, F.lit(v))
    return out if default is None else out.otherwise(default)


def date_id_of(d: Column) -> Column:
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def customers(customer: DataFrame) -> DataFrame:
    k = F.col("c_custkey")
    bal = F.col("c_acctbal")
    return customer.select(
        k.alias("customer_id"),
        F.concat(F.lit("  "), F.lower("c_name"), F.lit(" ")).alias("customer_name"),
        F.when(k % 11 == 0, F.lit(None)).otherwise((15 + k % 80).cast("int")).alias("customer_age"),
        F.when(k % 2 == 0, "F").otherwise("M").alias("customer_gender"),
        F.concat(F.lit(" city_"), F.col("c_nationkey").cast("string")).alias("customer_city"),
        F.when(k % 13 == 0, F.lit(None)).otherwise(F.col("c_mktsegment")).alias("customer_occupation"),
        F.when(k % 7 == 0, F.lit(None)).when(bal < 0, "<3L").when(bal < 5000, "3L-30L").otherwise(">30L")
        .alias("customer_income_bracket"),
    )


def _channel_of(k: Column) -> Column:
    return F.when(k % 10 < 6, 1).when(k % 10 < 9, 2).otherwise(3).cast("int")


def policies(orders: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    ck = F.col("o_custkey")
    total = F.col("o_totalprice").cast("decimal(18,2)")
    tenure = _lookup(ck % 10, list(enumerate(TENURE_BY_CUSTKEY_MOD10))).cast("int")
    pending = _lookup(ck % 4, list(enumerate(PENDING_STATUS_BY_CUSTKEY_MOD4)))
    issue = F.col("o_orderdate").cast("date")
    channel = _channel_of(k)
    return orders.select(
        k.alias("policy_id"),
        F.concat(F.lit("P"), k.cast("string")).alias("policy_number"),
        F.when(k % 101 == 0, -ck - 1).otherwise(ck).alias("customer_id"),
        (k % 4 + 1).cast("int").alias("product_id"),
        channel.alias("channel_id"),
        F.when((channel == 1) & (k % 17 != 0), F.concat(F.lit("A"), (k % 800).cast("string"))).alias("agent_id"),
        total.alias("policy_value"),
        tenure.alias("policy_tenure"),
        (total % 60000).cast("decimal(18,2)").alias("policy_premium"),
        _lookup(F.col("o_orderstatus"), STATUS_BY_ORDERSTATUS, pending).alias("latest_status"),
        issue.alias("issue_date"),
        F.when(k % 200 == 0, F.date_sub(issue, 1)).otherwise(F.date_add(issue, 365 * tenure)).alias("expiry_date"),
        (k % 2).cast("int").alias("is_current"),
        F.when(k % 19 == 0, F.lit(None)).otherwise((total * 7 % 70000).cast("decimal(18,2)")).alias("cost_spent"),
        (k % 5 * 7).cast("int").alias("total_time_in_grace"),
        F.year(issue).alias("issue_year"),
    )


def previous_status(events: DataFrame) -> DataFrame:
    """``events`` plus the ``current_status`` of the same policy's event before
    it in (date, event) order, with no heavy policy as a group
    (``ordered.previous``).  Events with a null policy, date or id are kept;
    null policies are one policy.
    """
    return ordered.previous(events, "policy_id", [F.col("date_id").asc_nulls_first(), F.col("event_id").asc_nulls_first()],
                            {"previous_status": "current_status"})


def policy_events(events: DataFrame) -> DataFrame:
    e = F.col("event_id")
    policy = F.when(e % 50 == 0, -e - 1).otherwise(F.expr("event_id div 3"))
    day = date_lit(EPOCH) + (F.expr("event_id div 2") * 37 % 2400).cast("int")
    base = events.select(
        e.alias("event_id"),
        policy.alias("policy_id"),
        F.col("user_id").alias("customer_id"),
        (policy % 4 + 1).cast("int").alias("product_id"),
        _channel_of(policy).alias("channel_id"),
        date_id_of(day).alias("date_id"),
        _lookup(F.col("event_type"), STATUS_BY_EVENT_TYPE).alias("current_status"),
        (F.col("event_type") == "purchase").alias("is_renewed"),
    )
    return previous_status(base).select(
        "event_id", "policy_id", "customer_id", "product_id", "channel_id", "date_id", "previous_status",
        "current_status", "is_renewed")


def premium_payments(lineitem: DataFrame) -> DataFrame:
    ok = F.col("l_orderkey")
    ln = F.col("l_linenumber")
    step = _lookup(ok % 5, list(enumerate(PAYMENT_STEP_BY_ORDERKEY_MOD5)))
    day = date_lit(EPOCH) + (ok % 365 + ln * step).cast("int")
    price = F.col("l_extendedprice")
    return lineitem.select(
        (ok * 10 + ln).alias("payment_id"),
        F.when(ok % 97 == 0, -ok - 1).otherwise(ok).alias("policy_id"),
        date_id_of(day).alias("date_id"),
        F.when((F.col("l_returnflag") == "R") & (ln == 1), -price).otherwise(price).cast("decimal(18,2)")
        .alias("premium_amount"),
        F.col("l_linestatus").alias("payment_status"),
        (F.col("l_returnflag") == "R").cast("int").alias("is_missed"),
        (F.col("l_returnflag") == "A").cast("int").alias("is_in_grace_period"),
        # survivor order for de-duplication; dropped by the cleaner
        "l_partkey", "l_suppkey", "l_shipdate",
    )


def dates(spark: SparkSession) -> DataFrame:
    """Calendar dimension: one row per day, with every 29th day missing so the
    date lookups meet unmatched keys."""
    idx = F.col("id")
    day = date_lit(EPOCH) + idx.cast("int")
    return (spark.range(CALENDAR_DAYS).filter(idx % MISSING_DAY_EVERY != 0)
            .select(date_id_of(day).alias("date_id"), day.alias("date"), F.year(day).alias("year"),
                    F.dayofweek(day).between(2, 6).cast("int").alias("is_weekday")))


def literal_table(spark: SparkSession, rows, names: list[str]) -> DataFrame:
    """A small fixed table built JVM-side (``inline`` of literal structs), so
    no Python worker is involved in producing it."""
    structs = [F.struct(*[F.lit(v).alias(n) for v, n in zip(r, names)]) for r in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def products(spark: SparkSession) -> DataFrame:
    df = literal_table(spark, PRODUCTS, ["product_id", "product_name", "product_category"])
    return df.withColumn("product_id", F.col("product_id").cast("int"))


def channels(spark: SparkSession) -> DataFrame:
    df = literal_table(spark, CHANNELS, ["channel_id", "channel_name", "channel_type"])
    return df.withColumn("channel_id", F.col("channel_id").cast("int"))


def agents(supplier: DataFrame) -> DataFrame:
    s = F.col("s_suppkey")
    return supplier.select(
        F.concat(F.lit("A"), s.cast("string")).alias("agent_id"),
        F.concat(F.lit(" "), F.lower("s_name"), F.lit("  ")).alias("agent_name"),
        F.concat(F.lit(" city_"), F.col("s_nationkey").cast("string")).alias("agent_city"),
        F.concat(F.lit("region_"), (F.col("s_nationkey") % 5).cast("string"), F.lit(" ")).alias("agent_region"),
        F.when(s % 10 == 0, F.lit(None)).otherwise(F.lit(1)).cast("int").alias("channel_id"),
    )


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The eight raw domain tables over one driver directory; lazy, but for a look for heavy policies in the events, whose order is landed in slices if there are any."""
    rd = lambda name: read_driver(spark, sf_dir, name)
    return {
        "customers": customers(rd("customer")),
        "policies": policies(rd("orders")),
        "products": products(spark),
        "channels": channels(spark),
        "agents": agents(rd("supplier")),
        "dates": dates(spark),
        "policy_events": policy_events(rd("events")),
        "premium_payments": premium_payments(rd("lineitem")),
    }
