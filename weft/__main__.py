"""Command line: ``python -m weft train|predict|validate ...``."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="weft")
    commands = parser.add_subparsers(dest="command", required=True)
    for name in ("prepare", "block", "features", "train", "predict"):
        sub = commands.add_parser(name)
        sub.add_argument("--work", required=True)
        sub.add_argument("--a", required=True)
        sub.add_argument("--b", nargs="+", required=True)
        if name in ("prepare", "block", "features", "train"):
            sub.add_argument("--truth", required=name == "train")
        if name in ("block", "features"):
            sub.add_argument("--sample", type=float, default=1.0)
            sub.add_argument("--seed", type=int, default=7)
            sub.add_argument("--top-name", type=int)
            sub.add_argument("--top-address", type=int)
        if name in ("features", "predict"):
            sub.add_argument("--country")
    commands.choices["train"].add_argument("--neg-frac", type=float, default=1.0)
    commands.choices["train"].add_argument("--rounds", type=int, default=60)
    commands.choices["train"].add_argument("--depth", type=int, default=5)
    commands.choices["train"].add_argument("--states", nargs="+")
    commands.choices["predict"].add_argument("--model", required=True)
    commands.choices["predict"].add_argument("--out", required=True)
    commands.choices["predict"].add_argument("--stage", choices=["first", "second"], default="second")
    check = commands.add_parser("validate")
    check.add_argument("matches")
    check.add_argument("candidates")
    check.add_argument("--required", required=True)
    check.add_argument("--check-ids", nargs="+")
    args = parser.parse_args(argv)
    spark = SparkSession.builder.appName("weft").getOrCreate()

    from weft.operators.decide import recall_report, truth_pairs
    from weft.operators.validate import validate_files
    from weft.plans import pipeline
    from weft.sources import files

    if args.command == "validate":
        code, messages = validate_files(spark, args.matches, args.candidates, args.required, args.check_ids)
        print("\n".join(messages) or "no issues")
        return code
    if args.command == "train":
        print(pipeline.train(spark, args.work, args.a, args.b, args.truth, args.states, neg_frac=args.neg_frac, rounds=args.rounds, depth=args.depth))
    elif args.command == "predict":
        pipeline.predict(spark, args.work, args.model, args.a, args.b, args.out, args.stage, args.country)
    else:
        a, b = pipeline.prepare(spark, args.work, args.a, args.b, args.truth)
        if args.command != "prepare":
            pairs = pipeline.block(spark, args.work, a, b, args.sample, args.seed, args.top_name, args.top_address)
            if args.command == "features":
                pipeline.compare(spark, args.work, a, b, pairs, args.country)
            elif args.truth:
                truth = truth_pairs(files.read_truth(spark, args.truth))
                print(recall_report(pairs, truth.join(pairs.select("a_id").distinct(), "a_id", "left_semi") if args.sample < 1 else truth).first().asDict())
    return 0


if __name__ == "__main__":
    sys.exit(main())
