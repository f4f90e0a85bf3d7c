"""spark-submit entry points: ``python -m scoreloom <job> --train T [--test T --template T] --out DIR``.

Paths ending in ``.csv`` are read as CSV, all others as Parquet.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from scoreloom.operators.ledger import best_runs, select_final, update_scores
from scoreloom.operators.publish import validate, write_ordered
from scoreloom.plans import reports, scoring
from scoreloom.sources.store import append_run, load_ledger, save_report
from scoreloom.sources.tables import scan_csv, scan_parquet, with_positions

JOBS = {
    "balanced": scoring.balanced,
    "fast": scoring.fast,
    "baseline": scoring.baseline,
    "safety": scoring.safety,
    "compete": scoring.compete,
    "advanced": scoring.advanced,
    "aggressive": scoring.aggressive,
    "ensemble": scoring.train_and_ensemble,
    "meta": scoring.meta,
    "full": scoring.full,
}


def read(spark: SparkSession, path: str) -> DataFrame:
    return scan_csv(spark, path) if path.endswith(".csv") else scan_parquet(spark, path)


def read_template(spark: SparkSession, path: str) -> DataFrame:
    template = read(spark, path)
    return template if "pos" in template.columns else with_positions(template)


def arguments() -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="scoreloom")
    parser.add_argument(
        "job", choices=[*JOBS, "tune", "explore", "profile", "validate", "ledger-add", "ledger-update", "ledger-best", "ledger-select"]
    )
    parser.add_argument("--train")
    parser.add_argument("--test")
    parser.add_argument("--template")
    parser.add_argument("--submission")
    parser.add_argument("--target")
    parser.add_argument("--ledger")
    parser.add_argument("--model")
    parser.add_argument("--ensemble-type")
    parser.add_argument("--cv-score", type=float)
    parser.add_argument("--file")
    parser.add_argument("--notes")
    parser.add_argument("--scores", type=float, nargs="*", default=[])
    parser.add_argument("-n", type=int, default=2)
    parser.add_argument("--strict", action="store_true")
    parser.add_argument("--single-file", action="store_true")
    parser.add_argument("--out")
    parser.add_argument("--families", nargs="+", help="balanced, compete, meta, full, aggressive, tune")
    parser.add_argument("--seeds", type=int, nargs="+", help="compete, meta, full")
    parser.add_argument("--folds", type=int, help="balanced, fast, advanced, aggressive, ensemble, tune")
    parser.add_argument("--tune-trials", type=int, help="compete, meta, full, advanced, ensemble, tune")
    parser.add_argument("--store", help="compete, meta, full: keeps each family's scores; ensemble: also trials and models; tune: trials")
    parser.add_argument("--done", nargs="+", help="compete: families to read from the store")
    return parser.parse_args()


def job_options(args: argparse.Namespace) -> dict[str, object]:
    """The options that were given; a job that does not know one refuses it."""
    named = {"families": "families", "seeds": "seeds", "folds": "k", "tune_trials": "tune_trials", "store": "store", "done": "done"}
    given = {parameter: getattr(args, option, None) for option, parameter in named.items()}
    return {parameter: value for parameter, value in given.items() if value is not None}


def run(spark: SparkSession, args: argparse.Namespace) -> int:
    if args.job in JOBS:
        done = JOBS[args.job](
            read(spark, args.train), read(spark, args.test), read_template(spark, args.template), **job_options(args)
        )
        stages = done if isinstance(done, dict) else {"": done}
        for stage, outcome in stages.items():
            folder = f"{args.out}/{stage}".rstrip("/")
            write_ordered(outcome.published, f"{folder}/predictions", args.single_file)
            save_report(outcome.board, f"{folder}/board")
            for name, note in outcome.notes.items():
                print(f"{name}: {note}")
        return 1 if any(outcome.failed for outcome in stages.values()) else 0
    elif args.job == "tune":
        best, trials = scoring.tune(
            read(spark, args.train), read(spark, args.test), read_template(spark, args.template), **job_options(args)
        )
        save_report(trials, f"{args.out}/trials")
        for family, params in best.items():
            print(f"{family}: {params}")
    elif args.job == "explore":
        test = read(spark, args.test) if args.test else None
        for name, report in reports.explore(read(spark, args.train), test, args.target).items():
            save_report(report, f"{args.out}/{name}")
    elif args.job == "profile":
        for name, report in reports.profile(read(spark, args.train), args.target).items():
            save_report(report, f"{args.out}/{name}")
    elif args.job == "validate":
        test = read_template(spark, args.test) if args.test else None
        submission, template = read_template(spark, args.submission), read_template(spark, args.template)
        report = validate(submission, template, args.strict, test)
        if args.out:
            save_report(report, args.out)
        return 0 if report.first()["valid"] else 1
    elif args.job == "ledger-add":
        append_run(spark, args.ledger, model=args.model, ensemble_type=args.ensemble_type, cv_score=args.cv_score,
                   file=args.file, notes=args.notes)
    elif args.job == "ledger-update":
        updated = update_scores(load_ledger(spark, args.ledger), args.scores)
        updated.write.mode("overwrite").parquet(args.out)
    else:
        pick = best_runs if args.job == "ledger-best" else select_final
        chosen = pick(load_ledger(spark, args.ledger), args.n)
        chosen.show(truncate=False)
        if args.out:
            save_report(chosen, args.out)
    return 0


def main() -> int:
    spark = SparkSession.builder.appName("scoreloom").getOrCreate()
    try:
        return run(spark, arguments())
    finally:
        spark.stop()


if __name__ == "__main__":
    raise SystemExit(main())
