"""Staging model: typed, normalised change events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.money import money
from ..functions.times import ntz_from_epoch_ms, parse_timestamp

KEY_COLUMNS = ["id", "customer_id", "product_id"]


def stg_orders(processed: DataFrame, strict_timestamps: bool = True) -> DataFrame:
    """Typed projection of processed events.

    * rows missing any key (order, customer, product) are removed;
    * ``total_amount`` is recomputed as ``quantity * unit_price`` (the
      source's generated column never arrives on the wire);
    * status lower-cased, operation upper-cased, both trimmed;
    * timestamps parsed to UTC ``TIMESTAMP_NTZ``; ``strict_timestamps``
      fails on bad text like the reference, otherwise bad text is NULL.
    """
    keyed = processed.where(F.col("id").isNotNull() & F.col("customer_id").isNotNull()
                            & F.col("product_id").isNotNull())
    return keyed.select(
        F.col("id").cast("bigint").alias("order_id"),
        F.col("customer_id").cast("bigint").alias("customer_id"),
        F.col("product_id").cast("bigint").alias("product_id"),
        F.col("quantity").cast("int").alias("quantity"),
        money(F.col("unit_price")).alias("unit_price"),
        money(F.col("quantity") * F.col("unit_price")).alias("total_amount"),
        F.lower(F.trim(F.col("status"))).alias("status"),
        F.upper(F.trim(F.col("operation"))).alias("operation_type"),
        parse_timestamp(F.col("created_at"), strict_timestamps).alias("created_at"),
        parse_timestamp(F.col("updated_at"), strict_timestamps).alias("updated_at"),
        ntz_from_epoch_ms(F.col("processed_at").cast("bigint")).alias("processed_at"),
    )
