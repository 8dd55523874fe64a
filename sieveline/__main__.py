"""Command line: run a pipeline, list operators, evaluate an annotated file."""

from __future__ import annotations

import argparse
import json


def _session():
    from pyspark.sql import SparkSession

    return SparkSession.builder.appName("sieveline").getOrCreate()


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="sieveline")
    sub = parser.add_subparsers(dest="command", required=True)
    run = sub.add_parser("run")
    run.add_argument("config")
    run.add_argument("--limit", type=int)
    run.add_argument("--resume", action="store_true")
    run.add_argument("--output-dir")
    run.add_argument("--fused", action="store_true", help="no checkpoint per operator")
    sub.add_parser("list-ops")
    ev = sub.add_parser("eval")
    ev.add_argument("--input", required=True)
    ev.add_argument("--output-dir", default="outputs/eval")
    ev.add_argument("--sweep")
    ev.add_argument("--sweep-target", default="any")
    ev.add_argument("--sweep-steps", type=int, default=20)
    pre = sub.add_parser("preflight", help="check a folder of training sets before a run")
    pre.add_argument("folder")
    pre.add_argument("--groups", nargs="+", default=["a_dirty", "b_cleaned", "c_random"])
    pre.add_argument("--prefix", default="")
    pre.add_argument("--probe", type=int, default=50)
    pre.add_argument("--seed", type=int, default=0)
    args = parser.parse_args(argv)

    if args.command == "list-ops":
        import sieveline.operators  # noqa: F401
        from sieveline.registry import get_op, list_ops

        for name in list_ops():
            op = get_op(name)
            print(f"{name:26s} {op.stage:11s} {(op.__doc__ or '').strip().splitlines()[0]}")
        return 0
    if args.command == "run":
        from sieveline.plans.pipeline import Pipeline

        report = Pipeline.from_yaml(args.config).run(_session(), args.limit, args.resume, per_op=not args.fused, output_dir=args.output_dir)
        print(json.dumps({k: report[k] for k in ("config", "n_input", "n_output", "overall_drop_rate")}))
        return 0
    if args.command == "preflight":
        from sieveline.plans import preflight

        found = preflight.check(_session(), args.folder, args.groups, args.prefix, args.probe, args.seed)
        print(preflight.to_text(found))
        return preflight.tallies(found)["FAIL"]
    from sieveline.plans import evaluate as E
    from sieveline.schema import as_samples
    from sieveline.sources.jsonl import read_jsonl

    rows = as_samples(read_jsonl(_session(), args.input))
    swept = [r.asDict() for r in E.sweep(E.sweep_rows(rows, args.sweep, args.sweep_target), args.sweep_steps).orderBy("threshold").collect()] if args.sweep else None
    E.write(rows.sparkSession, E.evaluate(rows), args.output_dir, swept)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
