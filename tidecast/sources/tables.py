"""Daily series out of the order, line item and event tables."""

from pyspark.sql import functions as F

from tidecast.operators.series import to_series
from tidecast.sources.schema import RAW_COLUMNS


def read_table(spark, folder, name):
    return spark.read.parquet(f"{folder}/{name}.parquet")


def line_items_by(spark, folder, key, value="l_extendedprice"):
    """Last value of the day per ``key``: greatest order, then line, then value.

    The three are packed into one decimal, whose aggregate state is updated in place by a
    hash aggregate; a struct would make Spark sort every input split first.
    """
    items = read_table(spark, folder, "lineitem")
    line = (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("decimal(20,0)")
    cents = F.round(F.col(value) * 100).cast("decimal(12,0)")
    order = line * F.lit(10 ** 12).cast("decimal(13,0)") + cents
    return to_series(items, F.col(key).cast("string"), F.to_date("l_shipdate"),
                     F.col(value), order)


def bars(spark, folder):
    """Few long series: one per return flag."""
    return line_items_by(spark, folder, "l_returnflag")


def quantity_days(spark, folder):
    """Few long series of whole numbers: the quantity per return flag."""
    return line_items_by(spark, folder, "l_returnflag", "l_quantity")


def supplier_bars(spark, folder):
    """Many medium series: one per supplier."""
    return line_items_by(spark, folder, "l_suppkey")


def order_lines(spark, folder):
    """Very short series: the shipments of an order."""
    return line_items_by(spark, folder, "l_orderkey")


def _orders_by(spark, folder, key):
    orders = read_table(spark, folder, "orders")
    return to_series(orders, F.col(key).cast("string"), F.to_date("o_orderdate"),
                     F.col("o_totalprice"), F.col("o_orderkey"))


def order_days(spark, folder):
    """Last order total of the day per priority."""
    return _orders_by(spark, folder, "o_orderpriority")


def customer_orders(spark, folder):
    """Short series: last order total of the day per customer."""
    return _orders_by(spark, folder, "o_custkey")


def event_days(spark, folder):
    """Last event value of the day per user."""
    events = read_table(spark, folder, "events")
    return to_series(events, F.col("user_id").cast("string"), F.to_date("ts"),
                     F.col("value"), F.col("event_id"))


def raw_records(spark, folder, placed=False):
    """The 18 raw columns as text, every one filled from the line items.

    One record per supplier and day, the last line of the day; some closes are the ``N/A``
    of an unrenderable cell. ``placed`` puts a ticker's records into one partition, as a
    window over them needs it: as seven numbers, they are moved at a third of their text.
    """
    items = read_table(spark, folder, "lineitem")
    whole = ["l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice",
             "l_discount", "l_tax"]
    order = F.struct("l_orderkey", "l_linenumber", "l_extendedprice", "l_partkey", "l_quantity",
                     "l_discount", "l_tax")
    last = items.groupBy(F.col("l_suppkey").alias("supplier"), F.to_date("l_shipdate").alias(
        "day")).agg(F.max(order).alias("last")).select(
        F.col("supplier").cast("string").alias("Ticker"), "day", "last")
    if placed:
        last = last.repartition("Ticker")

    def money(name):
        return F.format_number(F.col(f"last.{name}").cast("double"), 2)

    def plain(name):
        return F.col(f"last.{name}").cast("string")
    close = F.when(F.dayofmonth("day") == 13, "N/A").otherwise(money("l_extendedprice"))
    filled = {
        "No": plain("l_linenumber"), "Date": F.date_format("day", "dd/MM/yyyy"),
        "Ticker": F.col("Ticker"), "Reference": money("l_extendedprice"),
        "Open_price": money("l_partkey"), "Close_price": close,
        "Highest_price": money("l_orderkey"), "Lowest_price": money("l_quantity"),
        "Average": money("l_extendedprice"), "Change": money("l_discount"),
        "Change_percent": plain("l_tax"), "Matched_volume": plain("l_quantity"),
        "Matched_value": money("l_extendedprice"), "Negotiated_volume": plain("l_linenumber"),
        "Negotiated_value": money("l_partkey"), "Total_volume": plain("l_quantity"),
        "Total_value": money("l_extendedprice"), "Market_cap": money("l_orderkey")}
    return last.select(*[filled[c].alias(c) for c in RAW_COLUMNS])


def formatted_records(spark, folder):
    """Raw text records derived from the supplier bars, as the daily files hold them.

    Numbers carry thousands separators, dates are day-first, and some numbers are the
    ``N/A`` of an unrenderable cell.
    """
    series = supplier_bars(spark, folder)
    money = F.format_number("value", 2)
    return series.select(
        F.col("series").alias("Ticker"),
        F.date_format("date", "dd/MM/yyyy").alias("Date"),
        F.when(F.dayofmonth("date") == 13, "N/A").otherwise(money).alias("Close_price"),
        F.when(F.month("date") == 2, F.date_format("date", "d-M-yyyy"))
        .otherwise(F.date_format("date", "d/M/yyyy")).alias("Loose_date"))
