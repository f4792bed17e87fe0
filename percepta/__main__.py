"""Command line: the four jobs on passenger CSV files.

    python -m percepta export  --train data/train.csv --out data/split
    python -m percepta prepare --train data/train.csv
    python -m percepta train   --train data/train.csv --score data/test.csv --out result/result.csv
    python -m percepta cv      --train data/train.csv --score data/test.csv --out result/result.csv

``--master`` defaults to the one given by ``spark-submit`` (or ``local[*]``
when run directly). Reports are printed; predictions and exports are files.
"""

from __future__ import annotations

import argparse
import sys

from percepta import defaults as D


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="percepta")
    p.add_argument("--master", default=None)
    p.add_argument("--shuffle-partitions", type=int, default=None)
    p.add_argument("--format", choices=["csv", "parquet"], default="csv", help="input file format")
    sub = p.add_subparsers(dest="job", required=True)

    ex = sub.add_parser("export", help="constant fill, index, seeded split, headerless CSV")
    ex.add_argument("--train", required=True)
    ex.add_argument("--out", required=True)
    ex.add_argument("--seed", type=int, default=None)
    ex.add_argument("--files", type=int, default=None)
    ex.add_argument("--mode", default="errorifexists")

    pr = sub.add_parser("prepare", help="moments, features, 80/20 split; shows the training rows")
    pr.add_argument("--train", required=True)
    pr.add_argument("--fit-on", choices=["all", "train"], default="all")

    for name, helptext in (("train", "single MLP fit"), ("cv", "grid search with K-fold CV")):
        t = sub.add_parser(name, help=f"{helptext}, report, score, CSV with header")
        t.add_argument("--train", required=True)
        t.add_argument("--score", default=None)
        t.add_argument("--out", default=None)
        t.add_argument("--mode", default="errorifexists")
        t.add_argument("--infer-schema", action="store_true")
        if name == "train":
            t.add_argument("--max-iter", type=int, default=D.MLP_MAX_ITER)
            t.add_argument("--fit-on", choices=["all", "train"], default="all")
        else:
            t.add_argument("--folds", type=int, default=D.CV_FOLDS)
            t.add_argument("--parallelism", type=int, default=4)
    return p


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)

    from percepta.operators import model
    from percepta.plans import jobs
    from percepta.session import build_session
    from percepta.sources.csv import read_input
    from percepta.spec import PASSENGER_SCHEMA

    spark = build_session(master=args.master, shuffle_partitions=args.shuffle_partitions)
    if args.job == "export":
        raw = read_input(spark, args.train, args.format, PASSENGER_SCHEMA)
        for path in jobs.constant_fill_export(
            raw, args.out, seed=args.seed, files=args.files, mode=args.mode
        ):
            print(path)
    elif args.job == "prepare":
        raw = read_input(spark, args.train, args.format, PASSENGER_SCHEMA)
        prepared = jobs.prepare(raw, fit_on=args.fit_on)
        print(prepared.features.moments)
        prepared.train.show(truncate=False)
    elif args.job == "train":
        res = jobs.fit_evaluate_score(
            spark,
            args.train,
            args.score,
            args.out,
            classifier=model.mlp(max_iter=args.max_iter),
            fit_on=args.fit_on,
            mode=args.mode,
            infer_schema=args.infer_schema,
            input_format=args.format,
        )
        res.report.show(truncate=False)
    else:
        res = jobs.cv_evaluate_score(
            spark,
            args.train,
            args.score,
            args.out,
            folds=args.folds,
            parallelism=args.parallelism,
            mode=args.mode,
            infer_schema=args.infer_schema,
            input_format=args.format,
        )
        res.summary.show(truncate=False)
        res.report.show(truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
