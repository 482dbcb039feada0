"""The hand-worked example: four orders, eight payments (money in units).

t0 = 1467849600000 ms. Arrival follows time; at equal time the order comes
first (o4 before p7).
"""

from __future__ import annotations

T0 = 1467849600000
M0 = T0 // 60000

ORDERS = [  # name, order_id, platform, seconds after t0, total
    ("o1", 1, 0, 0, 51.98),
    ("o2", 1, 1, 3, 51.98),
    ("o3", 2, 1, 65, 12.00),
    ("o4", 3, 0, 180, 1.00),
]
PAYMENTS = [  # name, order_id, amount, source, device, seconds after t0
    ("p1", 1, 10.00, 0, 0, 1),
    ("p2", 1, 19.99, 1, 1, 2),
    ("p3", 1, 19.99, 1, 1, 40),
    ("p4", 2, 5.50, 0, 1, 61),
    ("p5", 2, 4.50, 2, 0, 70),
    ("p6", 9, 7.00, 3, 0, 80),
    ("p7", 3, 1.00, 0, 1, 180),
    ("p8", 1, 2.00, 0, 0, 240),
]


def orders_df(spark):
    rows = [(n, oid, plat, T0 + s * 1000, total, s * 10) for n, oid, plat, s, total in ORDERS]
    return spark.createDataFrame(
        rows, "name string, order_id long, platform int, create_time_ms long, total_price double, arrival long"
    )


def payments_df(spark):
    rows = [(n, oid, amt, src, dev, T0 + s * 1000, s * 10 + 1) for n, oid, amt, src, dev, s in PAYMENTS]
    return spark.createDataFrame(
        rows,
        "name string, order_id long, pay_amount double, pay_source int, pay_platform int, "
        "create_time_ms long, arrival long",
    )
