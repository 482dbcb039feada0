"""Run the live metrics flow against message topics (spark-submit entry).

    spark-submit --packages org.apache.spark:spark-sql-kafka-0-10_2.13:<spark version> \\
        tools/run_live_metrics.py --servers host:9092 --pay-topic pay \\
        --taobao-topic tb_orders --tmall-topic tm_orders --out <shared folder> \\
        [--team T] [--every "5 seconds"] [--max-offsets 1000000]

Checkpoints and the metrics table live under ``--out`` (a shared folder);
restarting with the same ``--out`` resumes from the checkpoints.
"""

from __future__ import annotations

import argparse
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def parse(argv: list[str]) -> argparse.Namespace:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("--servers", required=True)
    ap.add_argument("--pay-topic", required=True)
    ap.add_argument("--taobao-topic", required=True)
    ap.add_argument("--tmall-topic", required=True)
    ap.add_argument("--out", required=True)
    ap.add_argument("--team", default="team")
    ap.add_argument("--every", default="5 seconds")
    ap.add_argument("--max-offsets", type=int, default=None)
    return ap.parse_args(argv)


def main(argv: list[str] | None = None) -> None:
    args = parse(sys.argv[1:] if argv is None else argv)
    from pyspark.sql import SparkSession

    from tallyflow.session import configure
    from tallyflow.sources.topics import decode_orders, decode_payments, topic_messages
    from tallyflow.streaming.live import LiveMetrics

    spark = configure(SparkSession.builder.appName("tallyflow-live").getOrCreate())
    pays = decode_payments(topic_messages(spark, args.servers, [args.pay_topic], args.max_offsets))
    orders = decode_orders(
        topic_messages(spark, args.servers, [args.taobao_topic, args.tmall_topic], args.max_offsets),
        args.taobao_topic,
        args.tmall_topic,
    )
    # Arrival order is the offset: total within a topic partition (as the
    # reference's consumers, which also pulled partitions in parallel).
    pays = pays.withColumnRenamed("offset", "arrival")
    orders = orders.withColumnRenamed("offset", "arrival")
    live = LiveMetrics(spark, f"{args.out.rstrip('/')}/metrics", team=args.team)
    queries = live.start(pays, orders, f"{args.out.rstrip('/')}/checkpoints", {"processingTime": args.every})
    for q in queries:
        q.awaitTermination()


if __name__ == "__main__":
    main()
