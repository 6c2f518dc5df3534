"""Clean transaction files into Parquet.

    spark-submit .../ledgersift/jobs/clean.py INPUT [OUTPUT] [options]
    spark-submit .../ledgersift/jobs/clean.py --root ROOT [options]

INPUT is a file, a folder or a glob; OUTPUT defaults to INPUT.parquet. With
``--files`` INPUT is a folder of which some files are taken by name. With
``--root`` the input is ROOT/input_data/*.txt, the output ROOT/output_data,
and customers are filtered before the trim. Access to storage is a matter
of the session's configuration. The job ends with 1 on an error and with 0
otherwise; an empty input is no error and leaves the output as it was.
"""

from __future__ import annotations

import argparse
import logging
import sys
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgersift.plans.clean import CUSTOMER_FIRST, SIGMA_FIRST, clean_counted
from ledgersift.session import build_session, pin_timezone, size_shuffles
from ledgersift.sources.files import select_files, total_bytes
from ledgersift.sources.typed import FILE, TEXT, typed_copy
from ledgersift.sources.transactions import default_output, read_transactions, write_clean

log = logging.getLogger("ledgersift.clean")
UNREADABLE = "__unreadable"
ORDERS = {"sigma-first": SIGMA_FIRST, "customer-first": CUSTOMER_FIRST}


@dataclass(frozen=True)
class RunSummary:
    rows_in: int
    rows_out: int | None = None
    unreadable: int = 0

    @property
    def written(self) -> bool:
        return self.rows_out is not None

    def lines(self) -> list[str]:
        if not self.written:
            return ["the input is empty, nothing was written"]
        removed = 1 - self.rows_out / self.rows_in
        lines = [f"rows read: {self.rows_in}", f"rows left: {self.rows_out} ({removed:.2%} removed)"]
        return [*lines, f"lines with unreadable values: {self.unreadable}"] if self.unreadable else lines


def run(
    spark: SparkSession,
    input_path: str,
    output_path: str | None = None,
    order: str = "sigma-first",
    files: str | None = None,
    infer: bool = False,
    partition_by: list[str] | None = None,
    steps: bool = False,
    versioned: bool = False,
    rejects: str | None = None,
) -> RunSummary:
    """Read, clean, write, in one read of the text. All numbers are counted by
    the plan that writes. If lines came in and none of them could be read, what
    was written is thrown away and the earlier output stays. ``rejects`` is
    where unreadable lines go, with their files; the text is parsed once into a
    typed copy then, from which both are written."""
    pin_timezone(spark)
    output_path = output_path or default_output(input_path)
    paths = select_files(spark, input_path, files) if files is not None else input_path
    if not paths:
        return RunSummary(0)
    size_shuffles(spark, total_bytes(spark, paths))
    if rejects is None:
        raw = read_transactions(spark, paths, infer=infer, corrupt_column=None if infer else UNREADABLE)
        return _clean(raw, output_path, order, partition_by, steps, versioned)
    with typed_copy(spark, paths) as copy:
        copy.rejects.write.mode("overwrite").parquet(rejects)
        raw = copy.whole.withColumnRenamed(TEXT, UNREADABLE).drop(FILE)
        return _clean(raw, output_path, order, partition_by, steps, versioned)


def _clean(raw: DataFrame, output_path: str, order: str, partition_by, steps: bool, versioned: bool) -> RunSummary:
    bad = {UNREADABLE: F.count(UNREADABLE)} if UNREADABLE in raw.columns else {}
    cleaned, counts = clean_counted(raw, ORDERS[order], full=steps, **bad)
    seen: dict[str, int] = {}

    def accept() -> bool:
        seen["rows"] = counts.get("input")
        seen["bad"] = counts.get("input", UNREADABLE) if bad else 0
        if not seen["rows"]:  # nothing came out, and Spark may have dropped the counting with it
            rows, unreadable = raw.agg(F.count(F.lit(1)), *(bad.values() or [F.lit(0)])).first()
            seen.update(rows=rows, bad=unreadable)
        if seen["rows"] and seen["bad"] == seen["rows"]:
            raise ValueError(f"none of {seen['rows']} lines could be read")
        return seen["rows"] > 0

    if not write_clean(cleaned, output_path, partition_by or (), versioned, accept):
        return RunSummary(0)
    if steps:
        for _, step, left, removed in counts.lines():
            log.info("%-10s %d rows (%.2f%% removed)", step, left, 100 * (removed or 0))
    return RunSummary(seen["rows"], counts.get(ORDERS[order][-1]), seen["bad"])


def parse(argv: list[str]) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description="Clean transaction files into Parquet.")
    parser.add_argument("input", nargs="?")
    parser.add_argument("output", nargs="?")
    parser.add_argument("--root", help="folder with input_data and output_data")
    parser.add_argument("--order", choices=sorted(ORDERS))
    parser.add_argument("--files", help="all, latest, or how many files by name")
    parser.add_argument("--infer", action="store_true", help="infer column types")
    parser.add_argument("--partition-by", action="append", default=[])
    parser.add_argument("--versioned", action="store_true", help="write the next version of OUTPUT, in place of none")
    parser.add_argument("--rejects", help="folder for unreadable lines")
    parser.add_argument("--steps", action="store_true", help="log the rows left after each step")
    args = parser.parse_args(argv)
    if bool(args.root) == bool(args.input):
        parser.error("give either INPUT or --root")
    return args


def main(argv: list[str] | None = None) -> int:
    logging.basicConfig(level=logging.INFO, format="[%(asctime)s] %(message)s")
    args = parse(sys.argv[1:] if argv is None else argv)
    input_path, output_path, order = args.input, args.output, args.order or "sigma-first"
    if args.root:
        root = args.root.rstrip("/")
        input_path = f"{root}/input_data" if args.files is not None else f"{root}/input_data/*.txt"
        output_path, order = f"{root}/output_data", args.order or "customer-first"
    try:
        spark = build_session("clean-transactions")
        summary = run(
            spark, input_path, output_path, order, args.files, args.infer, args.partition_by, args.steps, args.versioned, args.rejects
        )
    except Exception:
        log.exception("cleaning failed")
        return 1
    for line in summary.lines():
        log.info(line)
    return 0


if __name__ == "__main__":
    sys.exit(main())
