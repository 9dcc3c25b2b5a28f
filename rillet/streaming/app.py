"""Run a whole flow from a settings file, until stopped.

    python -m rillet.streaming.app --settings settings.xml --checkpoint /shared/ck \\
        --bootstrap-servers host:9092 [--topics logs]
    python -m rillet.streaming.app --settings settings.xml --checkpoint /shared/ck \\
        --text-dir /shared/incoming --available-now

Lines come from Kafka (topics from the settings unless given) or from text
files in a folder. Derived rows go to the settings' row output path, window
results to the SQL output path (as parquet, plus ``[a,b]`` text lines next
to it). With ``--available-now`` the data present is processed, every window
is flushed, and the program ends.
"""

from __future__ import annotations

import argparse
import importlib

from pyspark.sql import SparkSession

from ..functions import default_registry
from ..plans.settings import flow_from_settings
from ..sources import kafka_lines, text_lines
from .runner import FlowStream


def build(spark: SparkSession, args: argparse.Namespace) -> FlowStream:
    st = flow_from_settings(args.settings)
    if getattr(args, "functions", None):
        module, _, name = args.functions.partition(":")
        registry = default_registry()
        getattr(importlib.import_module(module), name)(registry)
        st.flow.registry = registry
    if args.text_dir:
        lines = text_lines(spark, args.text_dir, max_files_per_trigger=args.max_files)
    else:
        topics = args.topics or st.topics
        if not (args.bootstrap_servers and topics):
            raise SystemExit("Kafka needs --bootstrap-servers and topics")
        group = getattr(args, "group_id", None)
        lines = kafka_lines(spark, args.bootstrap_servers, topics,
                            starting_offsets=getattr(args, "starting_offsets", None) or "latest",
                            **({"kafka.group.id": group} if group else {}))
    sql_out = st.sql_output_path
    return FlowStream(st.flow, lines, output_path=st.output_path,
                      sql_output_path=f"{sql_out}/results" if sql_out else None,
                      sql_text_path=f"{sql_out}/lines" if sql_out else None,
                      checkpoint=args.checkpoint, trigger_seconds=st.batch_seconds,
                      echo_rows=args.echo, lateness=getattr(args, "lateness", None))


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="rillet.streaming.app", description=__doc__.split("\n")[0])
    p.add_argument("--settings", required=True, help="settings file (entry key=... XML)")
    p.add_argument("--checkpoint", required=True, help="shared folder for offsets and staging")
    p.add_argument("--bootstrap-servers", help="Kafka bootstrap servers")
    p.add_argument("--topics", help="comma-separated topics (default: from the settings)")
    p.add_argument("--starting-offsets", default="latest",
                   help="where a first run starts: latest, earliest or JSON (later runs: the checkpoint)")
    p.add_argument("--group-id", default=None, help="Kafka consumer group id")
    p.add_argument("--text-dir", help="read lines from text files in this folder instead")
    p.add_argument("--max-files", type=int, default=None, help="files per micro-batch")
    p.add_argument("--available-now", action="store_true",
                   help="process the data present, flush all windows, then stop")
    p.add_argument("--lateness", default=None,
                   help="e.g. '10 minutes': windows are final, and staged rows expire, this long "
                        "after their end (default: windows are completed however late rows come)")
    p.add_argument("--functions", default=None, metavar="MODULE:CALLABLE",
                   help="called with the function registry to add rule functions of your own")
    p.add_argument("--echo", type=int, default=0, help="print up to N rows per batch")
    args = p.parse_args(argv)
    spark = SparkSession.builder.appName("rillet").getOrCreate()
    runner = build(spark, args)
    if args.available_now:
        runner.start(available_now=True).awaitTermination()
        runner.flush()
    else:
        runner.run()


if __name__ == "__main__":
    main()
