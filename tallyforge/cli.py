"""Command line: runs the stages of a configuration."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from tallyforge.config import SPLITS, load_yaml
from tallyforge.plans.pipeline import STAGES, Pipeline
from tallyforge.session import get_spark


def arguments(argv: Sequence[str] | None = None) -> argparse.Namespace:
    """All stages of the configuration's way run unless some are named; ``--no-STAGE`` leaves one out."""
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--config", required=True)
    parser.add_argument("--out", required=True)
    parser.add_argument("--split", choices=[*SPLITS, "all"], default="train")
    parser.add_argument("--region", help="resample this region only")
    parser.add_argument("--component", help="make histograms of and resample this component only")
    for stage in STAGES:
        parser.add_argument(f"--{stage.replace('_', '-')}", dest=f"do_{stage}", action=argparse.BooleanOptionalAction, default=None)
    args = parser.parse_args(argv)
    args.stages = [s for s in STAGES if getattr(args, f"do_{s}")] or None
    args.left_out = [s for s in STAGES if getattr(args, f"do_{s}") is False]
    args.splits = list(SPLITS) if args.split == "all" else [args.split]
    return args


def main(argv: Sequence[str] | None = None) -> int:
    args = arguments(argv)
    config, spark = load_yaml(args.config), get_spark("tallyforge")
    for split in args.splits:
        pipeline = Pipeline(spark, config, args.out, split)
        pipeline.run([s for s in args.stages or pipeline.stages if s not in args.left_out], args.region, args.component)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
