"""Run a job: ``spark-submit ... -m vitals JOB --lake ROOT [options]`` or ``python -m vitals ...``."""

from __future__ import annotations

import argparse
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from .functions.health import DEFAULT_THRESHOLDS, Thresholds
from .plans import jobs
from .session import build_session, configure
from .sources import catalog, streams
from .sources.lake import Lake, register_views
from .streaming import aggregates, alerting, ingest


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="vitals", description=__doc__)
    parser.add_argument("job", choices=sorted(JOBS))
    parser.add_argument("--lake", required=True, help="root folder of the lake")
    parser.add_argument("--input", help="folder of arriving files")
    parser.add_argument("--servers", help="brokers to read messages from, instead of files")
    parser.add_argument("--topic", help="topic to read")
    parser.add_argument("--starting", help="where to start in a topic: alert jobs at its end, others at its beginning")
    parser.add_argument("--group", help="consumer group")
    parser.add_argument("--output", help="folder to write alerts or notifications to")
    parser.add_argument("--output-topic", help="topic to publish alerts to")
    parser.add_argument("--every", help="trigger interval; without one the job ends when caught up")
    parser.add_argument("--max-files", help="files per micro-batch, to work through a backlog in steps")
    parser.add_argument("--max-records", help="messages of a topic per micro-batch")
    parser.add_argument("--hours-back", type=int, default=2)
    parser.add_argument("--dt")
    parser.add_argument("--hour")
    parser.add_argument("--keep-days", type=int, default=30)
    parser.add_argument("--hr-low", type=int, default=DEFAULT_THRESHOLDS.low)
    parser.add_argument("--hr-high", type=int, default=DEFAULT_THRESHOLDS.high)
    parser.add_argument("--silver-format", default="parquet", help="format of the readings' silver")
    parser.add_argument("--sql", help="query over the four event tables; needs --rows or --output")
    parser.add_argument("--rows", type=int, help="rows of the query's result to print")
    args = parser.parse_args(argv)
    args.limits = Thresholds(args.hr_low, args.hr_high)
    return args


def _trigger(args: argparse.Namespace) -> dict:
    return {"processingTime": args.every} if args.every else streams.UNTIL_CAUGHT_UP


def _pace(args: argparse.Namespace) -> dict:
    return {"maxFilesPerTrigger": args.max_files} if args.max_files else {}


def _offsets(args: argparse.Namespace) -> dict:
    return {"maxOffsetsPerTrigger": args.max_records} if args.max_records else {}


def _messages(spark: SparkSession, args: argparse.Namespace, starting: str) -> DataFrame:
    if args.servers:
        return streams.kafka_messages(
            spark, args.servers, args.topic, args.starting or starting, args.group, **_offsets(args)
        )
    return streams.text_messages(spark, args.input, **_pace(args))


def _records(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    if args.servers:
        return streams.topic_records(spark, args.servers, args.topic, args.starting or "earliest", **_offsets(args))
    return streams.transport_records(spark, args.input, **_pace(args))


def _alerts(spark: SparkSession, lake: Lake, args: argparse.Namespace):
    messages = _messages(spark, args, "latest")
    if args.output_topic:
        return alerting.publish_alerts(
            messages, lake, sink_format="kafka", trigger=_trigger(args),
            **{"kafka.bootstrap.servers": args.servers, "topic": args.output_topic},
        )
    return alerting.publish_alerts(messages, lake, args.output, trigger=_trigger(args))


def _sql(spark: SparkSession, lake: Lake, args: argparse.Namespace):
    """Write the whole result, or print as many rows as asked for."""
    register_views(spark, lake)
    result = spark.sql(args.sql)
    if args.output:
        return result.write.mode("overwrite").parquet(args.output)
    if args.rows is None:
        raise ValueError("say how many --rows to print, or which folder to write the --output to")
    return result.show(args.rows, truncate=False)


def _now() -> datetime:
    return datetime.now(timezone.utc)


# Streams return their query, batch jobs their report.
JOBS = {
    "readings-ingest": lambda s, k, a: ingest.readings_to_bronze(
        _messages(s, a, "earliest"), k, _trigger(a)
    ),
    "readings-silver": lambda s, k, a: jobs.bronze_to_silver(s, k, a.silver_format),
    "readings-gold": lambda s, k, a: jobs.silver_to_gold(s, k, a.silver_format),
    "readings-advance": lambda s, k, a: jobs.advance_readings(s, k),
    "readings-answers": lambda s, k, a: jobs.answer_questions(s, k, a.silver_format),
    "alerts": _alerts,
    "notifications": lambda s, k, a: alerting.render_notifications(
        _messages(s, a, "latest"), k, a.output, trigger=_trigger(a)
    ),
    "events-bronze": lambda s, k, a: ingest.events_to_bronze(
        _records(s, a), k, _trigger(a)
    ),
    "events-silver": lambda s, k, a: ingest.bronze_to_silver(
        streams.bronze_stream(s, k.bronze, **_pace(a)), k, limits=a.limits, trigger=_trigger(a)
    ),
    "events-quarantine": lambda s, k, a: ingest.bronze_to_quarantine(
        streams.bronze_stream(s, k.bronze, **_pace(a)), k, _trigger(a)
    ),
    "events-route": lambda s, k, a: ingest.route_events(
        _records(s, a), k, limits=a.limits, trigger=_trigger(a)
    ),
    "gold-stream": lambda s, k, a: aggregates.refresh_touched_hours(
        streams.silver_stream(s, k.silver, **_pace(a)), k, trigger=_trigger(a)
    ),
    "gold-refresh": lambda s, k, a: jobs.refresh_gold(s, k, _now(), a.hours_back, a.dt, a.hour),
    "expire": lambda s, k, a: jobs.expire(s, k, _now(), a.keep_days),
    "compact": lambda s, k, a: jobs.compact(s, k),
    "catalog": lambda s, k, a: catalog.publish(s, k),
    "vacuum": lambda s, k, a: jobs.vacuum(s, k),
    "malformed": lambda s, k, a: alerting.report_malformed(
        _messages(s, a, "latest"), k, a.output, trigger=_trigger(a)
    ),
    "alarms": lambda s, k, a: [r.asDict() for r in jobs.refresh_alarms(s, k).orderBy("minute", "alarm").limit(a.rows or 20).collect()],
    "closed-gold": lambda s, k, a: aggregates.emit_closed_hours(
        streams.silver_stream(s, k.silver, **_pace(a)), k, trigger=_trigger(a)
    ),
    "sql": _sql,
}


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> object:
    args = _arguments(argv)
    session = configure(spark) if spark else build_session(f"vitals-{args.job}")
    result = JOBS[args.job](session, Lake(args.lake), args)
    if hasattr(result, "awaitTermination"):
        result.awaitTermination()
        result = result.lastProgress
    return result


if __name__ == "__main__":
    print(main())
