"""Run the batch job: ``python -m farevalue RAW ROOT``, or with ``spark-submit``."""

from __future__ import annotations

import argparse
import sys

from farevalue.operators.pricing import read_rates
from farevalue.operators.quality import DEFAULT_THRESHOLD
from farevalue.plans.medallion import STEPS, Layout, Options, run_job
from farevalue.session import build_session, size_shuffles
from farevalue.sources.files import contents


def main(arguments: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="farevalue", description=__doc__)
    parser.add_argument("raw", help="folder or file with raw fare envelopes")
    parser.add_argument("root", help="folder for the tables")
    parser.add_argument("--multi-line", action="store_true", help="raw files are JSON arrays")
    parser.add_argument("--keep-other-days", action="store_true", help="load only the days in RAW")
    parser.add_argument("--one-day-files", action="store_true", help="a raw file holds few days")
    parser.add_argument("--strict", action="store_true", help="a malformed line ends the job")
    parser.add_argument("--period", choices=["day", "month", "year"], default=Layout.period)
    parser.add_argument("--buckets", type=int, help="buckets per period; measured if not given")
    parser.add_argument("--rates", help="folder with the rule tables as CSV files with a header")
    parser.add_argument("--threshold", type=float, default=DEFAULT_THRESHOLD, help="null rate")
    parser.add_argument("--run-id", help="name of the validation; the time if not given")
    parser.add_argument("--resume", action="store_true", help="skip steps that are up to date")
    parser.add_argument("--input-bytes", type=int, help="size of the raw data; measured if not given")
    parser.add_argument(
        "--step", action="append", choices=[name for name, _ in STEPS], help="run only these steps"
    )
    given = parser.parse_args(arguments)
    layout = Layout(
        given.raw,
        given.root,
        given.multi_line,
        given.keep_other_days,
        given.one_day_files,
        given.strict,
        given.period,
        given.buckets,
    )
    steps = [s for s in STEPS if given.step is None or s[0] in given.step]
    spark = build_session("farevalue")
    size_shuffles(spark, given.input_bytes or contents(spark, given.raw).size)
    options = Options(
        rates=read_rates(spark, given.rates) if given.rates else None,
        threshold=given.threshold,
        run_id=given.run_id,
        resume=given.resume,
        rates_mark=f"{given.rates} {contents(spark, given.rates).mark()}" if given.rates else "",
    )
    results = run_job(spark, layout, steps, options)
    for result in results:
        state = "ok" if result.ok else f"failed: {result.error}"
        print(f"[{result.name}] {state} ({result.seconds:.1f} s)")
    return 0 if all(result.ok for result in results) else 1


if __name__ == "__main__":
    sys.exit(main())
