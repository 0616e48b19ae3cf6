"""The live job: three record streams cleaned into three tables, until one of them fails.

    spark-submit ... -m postlens.plans.live --format kafka --option kafka.bootstrap.servers=... \
        --posts subscribe=posts --places subscribe=places --users subscribe=users --out <folder> --checkpoints <folder>

Each record set has its query, its table, its checkpoint and a table of the payloads that could not be read.
"""

from __future__ import annotations

import argparse
import json
import logging
import sys
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.types import StructType

from postlens.session import build_session
from postlens.streaming.ingest import PAYLOADS, append_to_table, broken_payloads, open_stream, start_ingest, with_payload_counts

LOG = logging.getLogger("postlens.live")
ENTITIES = tuple(PAYLOADS)


class Watch(StreamingQueryListener):
    """Tells of each micro-batch, adds up the payload counts, and keeps why queries ended."""

    def __init__(self):
        self.counts: dict[str, dict[str, int]] = {}
        self.ended: dict[str, str | None] = {}

    def onQueryStarted(self, event) -> None:
        LOG.info("started %s", event.name or event.id)

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        for name, row in progress.observedMetrics.items():
            held = self.counts.setdefault(name, {"records": 0, "broken": 0})
            for field in held:
                held[field] += row[field]
        LOG.info("%s batch %s: %s rows", progress.name or progress.id, progress.batchId, progress.numInputRows)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended[str(event.id)] = event.exception
        LOG.info("ended %s%s", event.id, f": {event.exception}" if event.exception else "")


def start_all(
    streams: Mapping[str, DataFrame],
    out: str,
    checkpoints: str,
    tables: Mapping[str, str],
    trigger: Mapping[str, object] | None = None,
    fmt: str = "parquet",
) -> list[StreamingQuery]:
    """A query per record set, and one per record set for its broken payloads."""
    counted = {entity: with_payload_counts(records, entity) for entity, records in streams.items()}
    paths = {entity: f"{out}/{entity}" for entity in streams}
    queries = list(start_ingest(counted, tables, checkpoints, fmt, paths, trigger).values())
    for entity, records in streams.items():
        side = f"{tables[entity]}_broken"
        queries.append(
            append_to_table(broken_payloads(records, entity), side, f"{checkpoints}/{entity}-broken", fmt, f"{out}/{entity}-broken", trigger)
        )
    return queries


def wait_for_all(spark: SparkSession, queries: Sequence[StreamingQuery]) -> int:
    """Wait until every query has ended by itself (0), or one has failed: then the others are stopped (1)."""
    failed = None
    while failed is None and any(q.isActive for q in queries):
        try:
            spark.streams.awaitAnyTermination()
        except Exception as error:  # noqa: BLE001  whatever ended the query ends the job
            LOG.error("a query failed: %s", error)
        failed = next((q for q in queries if q.exception() is not None), None)
        spark.streams.resetTerminated()
    failed = failed or next((q for q in queries if q.exception() is not None), None)
    if failed is None:
        return 0
    for query in queries:
        if query.isActive:
            query.stop()
    return 1


def _options(told: Sequence[str]) -> dict[str, str]:
    return dict(item.split("=", 1) for item in told)


def main(arguments: Sequence[str] | None = None, spark: SparkSession | None = None) -> int:
    parser = argparse.ArgumentParser(description="Clean three live record streams into tables.")
    parser.add_argument("--format", required=True, help="stream source: kafka, kinesis, json, parquet, ...")
    parser.add_argument("--option", action="append", default=[], help="name=value, for all three sources")
    parser.add_argument("--schema", help="DDL of the records, for file sources; must have the column data")
    for entity in ENTITIES:
        parser.add_argument(f"--{entity}", action="append", default=[], help=f"name=value, for {entity}; path=... for files")
    parser.add_argument("--out", required=True, help="shared folder of the tables")
    parser.add_argument("--checkpoints", required=True, help="shared folder, one checkpoint each in it")
    parser.add_argument("--table-prefix", default="", help="goes before the tables' names")
    parser.add_argument("--table-format", default="parquet")
    parser.add_argument("--once", action="store_true", help="take what there is and end")
    args = parser.parse_args(arguments)
    spark = spark or build_session("postlens-live")
    watch = Watch()
    spark.streams.addListener(watch)
    try:
        schema = StructType.fromDDL(args.schema) if args.schema else None
        streams = {}
        for entity in ENTITIES:
            options = _options(args.option) | _options(getattr(args, entity))
            streams[entity] = open_stream(spark, args.format, options, options.pop("path", None), schema)
        tables = {entity: f"{args.table_prefix}{entity}" for entity in ENTITIES}
        trigger = {"availableNow": True} if args.once else None
        code = wait_for_all(spark, start_all(streams, args.out, args.checkpoints, tables, trigger, args.table_format))
    finally:
        spark.streams.removeListener(watch)
    LOG.info("payloads: %s", json.dumps(watch.counts))
    return code


if __name__ == "__main__":
    sys.exit(main())
