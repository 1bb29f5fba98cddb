"""Run one of the jobs, for use with ``spark-submit``.

    spark-submit --py-files sitewind.zip run_job.py ingest RAW MEASUREMENTS
    spark-submit --py-files sitewind.zip run_job.py site-info ZONES.csv SITES.csv GEO.csv ROOT
    spark-submit --py-files sitewind.zip run_job.py batches ROOT --size 5000
    spark-submit --py-files sitewind.zip run_job.py process MEASUREMENTS ROOT [--run-id 3]
    spark-submit --py-files sitewind.zip run_job.py score ROOT
"""

from __future__ import annotations

import argparse

from sitewind.operators import batches, score
from sitewind.plans import jobs
from sitewind.session import create_session
from sitewind.sources import measurements


def parse(arguments: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description="Jobs over wind measurements of many sites.")
    commands = parser.add_subparsers(dest="job", required=True)

    command = commands.add_parser("ingest", help="raw site files to the measurement dataset")
    command.add_argument("raw")
    command.add_argument("measurements")
    bound = {"type": lambda text: None if text == "open" else text, "help": "a UTC time, or open"}
    command.add_argument("--start", default=measurements.PERIOD_START, **bound)
    command.add_argument("--end", default=measurements.PERIOD_END, **bound)
    command.add_argument("--blocks", type=int, nargs="+")
    command.add_argument("--count", action="store_true", help="print the rows read and kept")

    command = commands.add_parser("compact", help="rewrite small files of the dataset")
    command.add_argument("measurements")
    command.add_argument("compacted")

    command = commands.add_parser("site-info", help="join the three site files")
    for name in ("timezone", "site_3tier", "geo", "root"):
        command.add_argument(name)

    command = commands.add_parser("batches", help="assign the sites to batches")
    command.add_argument("root")
    command.add_argument("--size", type=int, default=batches.SITES_PER_BATCH)

    command = commands.add_parser("materialise", help="one input set per batch")
    for name in ("measurements", "root", "path"):
        command.add_argument(name)

    command = commands.add_parser("process", help="roll-ups and directions")
    command.add_argument("measurements")
    command.add_argument("root")
    command.add_argument("--run-id", type=int, default=jobs.ALL_SITES)

    command = commands.add_parser("process-batches", help="the same for all batches, in one scan")
    command.add_argument("measurements")
    command.add_argument("root")

    command = commands.add_parser("score", help="score all sites")
    command.add_argument("root")
    command.add_argument("--first-year", type=int, default=score.FIRST_YEAR)
    command.add_argument("--last-year", type=int, default=score.LAST_YEAR)
    return parser.parse_args(arguments)


def run(spark, options: argparse.Namespace) -> None:
    if options.job == "ingest":
        counts = jobs.ingest(spark, options.raw, options.measurements, start=options.start,
                             end=options.end, blocks=options.blocks, count=options.count)
        if counts:
            print(f"{counts['read']} rows read, {counts['kept']} kept")
    elif options.job == "compact":
        measurements.compact_measurements(spark, options.measurements, options.compacted)
    elif options.job == "site-info":
        lost = jobs.load_site_info(
            spark, options.timezone, options.site_3tier, options.geo, options.root
        )
        lost.show()
    elif options.job == "batches":
        jobs.split_batches(spark, options.root, options.size)
    elif options.job == "materialise":
        jobs.materialise_batches(spark, options.measurements, options.root, options.path)
    elif options.job == "process":
        jobs.process_measurements(spark, options.measurements, options.root, options.run_id)
    elif options.job == "process-batches":
        jobs.process_batches(spark, options.measurements, options.root)
    elif options.job == "score":
        jobs.score_sites(spark, options.root, options.first_year, options.last_year)


if __name__ == "__main__":
    chosen = parse()
    run(create_session(f"sitewind {chosen.job}"), chosen)
