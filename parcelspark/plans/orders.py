"""Order against waybill: addresses, weights, fees and express type that changed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelspark.functions.classify import order_vs_waybill
from parcelspark.functions.timeops import AsOf, local_time, rolling_window
from parcelspark.operators.enrich import decode_option
from parcelspark.operators.skew import HOT_ROWS, left_join
from parcelspark.sources.tables import Tables

_FEES = {
    "insurance_amount": "insurance", "standard_shipping_fee": "std_shipping_fee", "handling_fee": "handling_fee",
    "other_fee": "other_fee", "total_shipping_fee": "total_shipping_fee",
}
_PLACES = ("sender_city_name", "sender_district_name", "recipient_city_name", "recipient_district_name")
_WEIGHTS = ("item_calculated_weight", "item_volume_weight")


def shipping_fee_check(tables: Tables, as_of: AsOf, *, days: int = 186, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Every order next to each version of its waybill; not reduced to one row per parcel. The versions of a parcel
    with more than ``hot_rows`` of them are spread over many tasks."""
    numeric = "decimal(38,9)"
    orders = rolling_window(tables["order_order"], "input_time", days, as_of)
    orders = orders.where(F.col("waybill_no").contains("IDE")).select(
        "waybill_no", "input_time", F.col("order_source").alias("_source"), F.col("express_type").alias("_o_express"),
        *[F.col(name).alias(f"order_{name}") for name in _PLACES],
        *[F.col(name).cast(numeric).alias(f"order_{name}") for name in _WEIGHTS],
        F.col("item_weight").cast(numeric).alias("_o_actual"),
        *[F.col(name).alias(f"order_{out}") for name, out in _FEES.items()],
    )
    waybills = rolling_window(tables["waybill_waybill"], "shipping_time", days, as_of)
    waybills = waybills.where(F.col("deleted") == "0").select(
        "waybill_no", "shipping_time", "recipient_address", "pod_photo_url",
        F.col("express_type").alias("_w_express"),
        F.col("sender_name").alias("order_sender_name"), F.col("sender_address").alias("order_sender_address"),
        *[F.col(name).alias(f"waybill_{name}") for name in _PLACES],
        *[F.col(name).cast(numeric).alias(f"waybill_{name}") for name in _WEIGHTS],
        F.col("item_actual_weight").cast(numeric).alias("_w_actual"),
        *[F.col(name).alias(f"waybill_{out}") for name, out in _FEES.items()],
    )
    rows = left_join(orders, waybills, "waybill_no", hot_rows)
    options = tables["system_option"]
    rows = decode_option(rows, "_o_express", options, "expressType", "order_express_type", unique=False)
    rows = decode_option(rows, "_w_express", options, "expressType", "waybill_express_type", unique=False)
    rows = decode_option(rows, "_source", options, "orderSource", "order_source", unique=False)

    def side(prefix: str, actual: str) -> dict:
        return {
            "sender_city": F.col(f"{prefix}_sender_city_name"),
            "sender_district": F.col(f"{prefix}_sender_district_name"),
            "recipient_city": F.col(f"{prefix}_recipient_city_name"),
            "recipient_district": F.col(f"{prefix}_recipient_district_name"),
            "calculated_weight": F.col(f"{prefix}_item_calculated_weight"),
            "volume_weight": F.col(f"{prefix}_item_volume_weight"),
            "actual_weight": F.col(actual),
            "insurance": F.col(f"{prefix}_insurance"),
            "express_type": F.col(f"{prefix}_express_type"),
        }

    remarks = order_vs_waybill(side("order", "_o_actual"), side("waybill", "_w_actual"))
    both = [name for field in (*_PLACES, *_WEIGHTS, *_FEES.values(), "express_type") for name in
            (f"order_{field}", f"waybill_{field}")]
    return rows.select(
        "waybill_no", "order_source",
        local_time(F.col("input_time"), as_of.tz).alias("input_time"),
        local_time(F.col("shipping_time"), as_of.tz).alias("shipping_time"),
        "order_sender_name", "order_sender_address", "recipient_address", "pod_photo_url",
        *both,
        *[remark.alias(name) for name, remark in remarks.items()],
    )
