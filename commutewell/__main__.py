"""Command line of the loads: ``spark-submit -m commutewell`` or ``python -m commutewell``.

The lake root and the business parameters are arguments; storage credentials belong in Spark's own
configuration.
"""

from __future__ import annotations

import argparse

from pyspark.sql import functions as F

from commutewell.contract import ACTIVITY
from commutewell.functions.wire import avro_schema, from_avro_payload, from_json_payload
from commutewell.operators import facts
from commutewell.plans import landing, loads, reports
from commutewell.plans.lake import Lake, Parameters
from commutewell.session import build_session
from commutewell.sources.topic import DEFAULT_TOPIC, read_topic, stream_topic


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="commutewell", description="Loads of the benefits lake.")
    parser.add_argument("lake", help="root folder of the lake")
    parser.add_argument("--master", help="Spark master; default: as configured")
    jobs = parser.add_subparsers(dest="job", required=True)
    for name, text in [("land-history", "replace the history zone"), ("land-live", "append to the live zone")]:
        land = jobs.add_parser(name, help=f"{text} from a topic")
        land.add_argument("servers", help="broker addresses")
        land.add_argument("--topic", default=DEFAULT_TOPIC)
        land.add_argument("--codec", choices=("avro", "json"), default="avro")
        land.add_argument("--schema", help="file with the writer's Avro schema; default: the contract")
        land.add_argument("--min-partitions", type=int, help="tasks that share the topic's partitions, at least")
        if name == "land-live":
            land.add_argument("--max-offsets", type=int, help="messages of one micro-batch, at most")
            land.add_argument("--bounded", action="store_true", help="end after what is there now")
    inject = jobs.add_parser("inject", help="drop the events of a CSV file")
    inject.add_argument("csv")
    history = jobs.add_parser("load-history", help="facts and reference from the history zone")
    history.add_argument("--mode", choices=("replace", "contribute"), default="replace")
    history.add_argument("--threshold", type=int, default=facts.HISTORY_THRESHOLD)
    history.add_argument("--one-way-km", type=float, default=facts.ONE_WAY_KM)
    history.add_argument("--euro-per-km", type=float, default=facts.EURO_PER_KM)
    live = jobs.add_parser("load-live", help="merge the new bronze files into facts and reference")
    live.add_argument("--rate", type=float, default=facts.BONUS_RATE)
    live.add_argument("--threshold", type=int, default=facts.LIVE_THRESHOLD)
    live.add_argument("--mode", choices=("replace", "accumulate", "contribute"), default="replace")
    reference = jobs.add_parser("load-reference", help="replace the reference by an HR export")
    reference.add_argument("csv")
    jobs.add_parser("audit", help="refill the quarantine and show checks and alert")
    jobs.add_parser("health", help="show the health report")
    jobs.add_parser("counts", help="show the fact tables' row counts")
    jobs.add_parser("reset-live", help="empty the facts and process all live files again")
    jobs.add_parser("expire", help="delete superseded versions of the gold tables")
    return parser


def _codec(options: argparse.Namespace):
    if options.codec == "json":
        return from_json_payload(ACTIVITY)
    if options.schema:
        with open(options.schema, encoding="utf-8") as file:
            return from_avro_payload(file.read())
    return from_avro_payload(avro_schema(ACTIVITY))


def _rates(options: argparse.Namespace) -> dict[str, str]:
    named = {"minPartitions": options.min_partitions, "maxOffsetsPerTrigger": getattr(options, "max_offsets", None)}
    return {name: str(value) for name, value in named.items() if value is not None}


def main(arguments: list[str] | None = None) -> None:
    options = _parser().parse_args(arguments)
    spark = build_session(f"commutewell {options.job}", options.master)
    lake = Lake(spark, options.lake)
    match options.job:
        case "land-history":
            messages = read_topic(spark, options.servers, options.topic, **_rates(options))
            print(landing.land_history(lake, messages, _codec(options)), "messages landed")
        case "land-live":
            messages = stream_topic(spark, options.servers, options.topic, **_rates(options))
            landing.land_live(lake, messages, _codec(options), options.bounded).awaitTermination()
        case "inject":
            print(landing.inject_events(lake, options.csv))
        case "load-history":
            loads.load_history(
                lake,
                Parameters(
                    live_mode=options.mode,
                    history_threshold=options.threshold,
                    one_way_km=options.one_way_km,
                    euro_per_km=options.euro_per_km,
                ),
            )
        case "load-live":
            parameters = Parameters(
                bonus_rate=options.rate, live_threshold=options.threshold, live_mode=options.mode
            )
            print(loads.load_live(lake, parameters), "entries processed")
        case "load-reference":
            print(loads.load_reference(lake, options.csv), "employees loaded")
        case "audit":
            report = reports.audit(lake)
            report["checks"].show(truncate=False)
            lines = report["alert"].orderBy(F.desc_nulls_last("n")).select(F.coalesce("message", "name").alias("alert"))
            for line in lines.toLocalIterator():  # every person, one partition at a time
                print(line.alert)
        case "health":
            print(reports.health_report(lake).first().rapport)
        case "counts":
            reports.fact_counts(lake).show()
        case "reset-live":
            loads.reset_live(lake)
        case "expire":
            print(sum(t.expire() for t in (lake.bonus, lake.eligibility, lake.reference, lake.quarantine)), "paths deleted")


if __name__ == "__main__":
    main()
