"""Synthetic orders in the landing format, generated on the executors at any scale.

Each row is a pure function of its id, so any partition of ids generates its rows
independently: no driver-side loop, no shuffle, the same rows for the same ids
and seed on every run and every partitioning.  Values come from an integer mixing
function (Park–Miller multiplier, a squaring round, a second multiplier, all
modulo the Mersenne prime 2^31 - 1); every product stays below 2^63, so it is
exact in BIGINT arithmetic and reproducible in any SQL engine.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The product catalogue (name, category, base price), regions,
# status shares (completed 7, pending 2, cancelled 1 in 10), date span and id formats.
PRODUCTS = (
    ("Laptop Pro 15", "Electronics", 1299.99),
    ("Wireless Headphones", "Electronics", 199.99),
    ("Standing Desk", "Furniture", 449.99),
    ("Office Chair", "Furniture", 329.99),
    ("Mechanical Keyboard", "Accessories", 129.99),
    ("USB-C Hub", "Accessories", 59.99),
    ("Monitor 27in", "Electronics", 399.99),
    ("Webcam HD", "Electronics", 89.99),
    ("Desk Lamp", "Furniture", 49.99),
    ("Mouse Pad XL", "Accessories", 29.99),
)
REGIONS = ("North", "South", "East", "West")
STATUS_SHARES = (("completed", 7), ("pending", 2), ("cancelled", 1))
BASE_DATE = dt.date(2024, 1, 1)
DAY_SPAN = 90
CUSTOMERS = 100
MAX_QUANTITY = 5
ORDER_ID_FORMAT = "ORD-%05d"
CUSTOMER_ID_FORMAT = "CUST-%04d"
# Price factor 0.95 .. 1.05 in steps of 1/10000.
PRICE_FACTOR_MIN, PRICE_FACTOR_STEPS = 9500, 1001

MODULUS = 2_147_483_647  # 2^31 - 1
MULT_A = 48_271
MULT_B = 16_807
MULT_Q = 69_621  # for the part of an id above the modulus
SQUARE_OFFSET = 12_345

# Field salts: one per generated column.
_FIELDS = ("customer", "product", "quantity", "price", "date", "region", "status")


def salt(seed: int, field: str) -> int:
    return (seed * 7_919 + (_FIELDS.index(field) + 1) * 104_729) % MODULUS


def mix(x: Column, s: int) -> Column:
    """Deterministic pseudo-random value in [0, 2^31 - 1) from a non-negative BIGINT."""
    above = F.pmod((x - F.pmod(x, F.lit(MODULUS))) / F.lit(MODULUS), F.lit(MODULUS)).cast("bigint")
    u = F.pmod(F.pmod(x, F.lit(MODULUS)) * F.lit(MULT_A) + above * F.lit(MULT_Q) + F.lit(s), F.lit(MODULUS))
    v = F.pmod(u * u + F.lit(SQUARE_OFFSET), F.lit(MODULUS))
    return F.pmod(v * F.lit(MULT_B) + u, F.lit(MODULUS))


def _pick(values, idx: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx + F.lit(1)).cast("int"))


def orders_from_ids(ids: DataFrame, seed: int = 42, id_col: str = "id") -> DataFrame:
    """Landing-format orders (9 STRING columns) for every id (a positive BIGINT) in ``ids``."""
    x = F.col(id_col).cast("bigint")
    prod = F.pmod(mix(x, salt(seed, "product")), F.lit(len(PRODUCTS)))
    base_cents = _pick([round(p * 100) for _, _, p in PRODUCTS], prod).cast("bigint")
    factor = F.pmod(mix(x, salt(seed, "price")), F.lit(PRICE_FACTOR_STEPS)) + F.lit(PRICE_FACTOR_MIN)
    price_cents = F.floor((base_cents * factor + F.lit(5_000)) / F.lit(10_000)).cast("bigint")
    status_roll = F.pmod(mix(x, salt(seed, "status")), F.lit(sum(s for _, s in STATUS_SHARES)))
    status, upper = None, 0
    for name, share in STATUS_SHARES:
        upper += share
        status = (F.when(status_roll < upper, F.lit(name)) if status is None
                  else status.when(status_roll < upper, F.lit(name)))
    day = F.pmod(mix(x, salt(seed, "date")), F.lit(DAY_SPAN)).cast("int")
    return ids.select(
        F.format_string(ORDER_ID_FORMAT, x).alias("order_id"),
        F.format_string(CUSTOMER_ID_FORMAT,
                        F.pmod(mix(x, salt(seed, "customer")), F.lit(CUSTOMERS)) + 1).alias("customer_id"),
        _pick([p for p, _, _ in PRODUCTS], prod).alias("product"),
        _pick([c for _, c, _ in PRODUCTS], prod).alias("category"),
        (F.pmod(mix(x, salt(seed, "quantity")), F.lit(MAX_QUANTITY)) + 1).cast("string").alias("quantity"),
        F.concat(F.floor(price_cents / 100).cast("bigint").cast("string"), F.lit("."),
                 F.lpad(F.pmod(price_cents, F.lit(100)).cast("string"), 2, "0")).alias("unit_price"),
        F.date_format(F.date_add(F.lit(BASE_DATE), day), "yyyy-MM-dd").alias("order_date"),
        _pick(REGIONS, F.pmod(mix(x, salt(seed, "region")), F.lit(len(REGIONS)))).alias("region"),
        status.alias("status"),
    )


def synthetic_orders(spark: SparkSession, n: int = 500, seed: int = 42,
                     num_partitions: int | None = None) -> DataFrame:
    """``n`` synthetic orders with ids 1..n (``spark.range`` splits them over the cluster)."""
    ids = spark.range(1, n + 1, numPartitions=num_partitions)
    return orders_from_ids(ids, seed)
