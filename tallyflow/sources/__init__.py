"""Sources: table views, message feeds (S1-S4, S6) and the delimited log."""

from tallyflow.sources.bucketed import read_bucketed, write_bucketed
from tallyflow.sources.delimited import (
    delimited_file_check,
    delimited_rejects,
    read_delimited_orders,
    write_delimited_orders,
)
from tallyflow.sources.feeds import (
    bounded_ingest_options,
    drop_end_markers,
    feed_completion,
    orders_source,
    payments_source,
    read_route,
    route_by_topic,
    route_to_folders,
)
from tallyflow.sources.tables import orders_ev, orders_v, payments_li, payments_v, read_table, redelivered, redelivered_soon

__all__ = [
    "bounded_ingest_options",
    "delimited_file_check",
    "delimited_rejects",
    "drop_end_markers",
    "feed_completion",
    "orders_ev",
    "orders_source",
    "orders_v",
    "payments_li",
    "payments_source",
    "payments_v",
    "read_delimited_orders",
    "read_table",
    "redelivered",
    "redelivered_soon",
    "route_by_topic",
    "route_to_folders",
    "read_route",
    "write_bucketed",
    "write_delimited_orders",
    "read_bucketed",
]
