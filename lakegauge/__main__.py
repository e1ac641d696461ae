"""Command line: ``python -m lakegauge --base URI --hour 2026-03-26T14``."""

from __future__ import annotations

import argparse
import json
from datetime import datetime, timezone

from lakegauge.functions.timeparts import previous_hour
from lakegauge.plans.hourly import Roots, run_hour, summary
from lakegauge.session import build_session


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="lakegauge", description="Run one hour.")
    parser.add_argument("--base", required=True, help="URI that holds all layers")
    parser.add_argument("--hour", help="ingest hour, UTC; default: the last one")
    parser.add_argument("--scope", choices=["hour", "day"], default="hour")
    parser.add_argument("--cores", type=int, help="cores of the whole cluster")
    options = parser.parse_args(arguments)

    hour = previous_hour()
    if options.hour:
        hour = datetime.fromisoformat(options.hour).replace(tzinfo=timezone.utc)
    spark = build_session("lakegauge", options.cores)
    roots = Roots.below(options.base)
    print(json.dumps(run_hour(spark, roots, hour, options.scope)))
    counts, lowest = summary(spark, roots)
    counts.show(truncate=False)
    lowest.show(truncate=False)


if __name__ == "__main__":
    main()
