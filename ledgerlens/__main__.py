"""Commands: a whole run, the gate of a stored model, the audit of a stored table.

The exit code is 1 when the model fails the gate or the audit finds a leak.
"""

from __future__ import annotations

import argparse
import sys
from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession

from ledgerlens import session
from ledgerlens.operators import audit, evaluate, model
from ledgerlens.plans import pipeline
from ledgerlens.schemas import AUC_LIMIT, TARGET
from ledgerlens.sources import versions


def run(spark: SparkSession, args: argparse.Namespace) -> int:
    outcome = pipeline.run(spark, args.raw_dir, args.out_dir, args.run_id, pit=args.pit, salt=args.salt)
    print(f"AUC {outcome.auc:.4f}, leak found: {outcome.leak_found}, passed: {outcome.passed}")
    return 0 if outcome.passed else 1


def gate(spark: SparkSession, args: argparse.Namespace) -> int:
    """Score every row of a feature table with a stored model."""
    with session.run_scratch(spark):
        scored = model.score(PipelineModel.load(versions.current(spark, args.model)), versions.read_table(spark, args.features)).select(TARGET, "score")
        result = evaluate.model_gate(scored, "score", threshold=args.limit).first()
    print(f"AUC {result['auc']:.4f}, threshold {args.limit}, passed: {result['passed']}")
    return 0 if result["passed"] else 1


def check_leaks(spark: SparkSession, args: argparse.Namespace) -> int:
    with session.run_scratch(spark):
        report = session.staged(audit.audit_report(versions.read_table(spark, args.features)), "audit")
        for row in report.filter("flagged").orderBy("check", "feature").toLocalIterator():
            print(f"{row['check']}: {row['feature']} {row['value']:.4f}")
        found = audit.audit_verdict(report).first()["leak_found"]
    print(f"leak found: {found}")
    return int(found)


def main(argv: Sequence[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="ledgerlens")
    commands = parser.add_subparsers(required=True)
    whole = commands.add_parser("run", help="from CSV files to the gate")
    whole.add_argument("raw_dir", help="folder with the seven CSV files")
    whole.add_argument("out_dir", help="folder for tables, model and run log")
    whole.add_argument("run_id")
    whole.add_argument("--pit", choices=["strict", "observed"], default="strict")
    whole.add_argument("--salt", help="appended to every id before hashing; never stored")
    whole.set_defaults(do=run)
    one = commands.add_parser("gate", help="judge a stored model on a stored feature table")
    one.add_argument("model")
    one.add_argument("features")
    one.add_argument("--limit", type=float, default=AUC_LIMIT)
    one.set_defaults(do=gate)
    leaks = commands.add_parser("audit", help="look for leaks in a stored feature table")
    leaks.add_argument("features")
    leaks.set_defaults(do=check_leaks)
    args = parser.parse_args(argv)
    spark = session.configure(SparkSession.builder.appName("ledgerlens").getOrCreate())
    return args.do(spark, args)


if __name__ == "__main__":
    sys.exit(main())
