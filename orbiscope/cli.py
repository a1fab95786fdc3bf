"""Command line: one subcommand per stage; prints a JSON report; exit 0 all ready, 1 any failed, 2 bad arguments."""

from __future__ import annotations

import argparse
import json
import os
import sys

from orbiscope.config import STAGES, Config, options

#: Stages that run a model: the argument that takes its factory, and the setting that names its device.
MODELS = {
    "parse-semantic": ("parser", "semantic_device"),
    "detect-dynamic": ("detector", "grounding_device"),
    "refine-masks": ("refiner", "sam2_device"),
}


def build_parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="orbiscope", description="Panoramic frame stages on Spark")
    stages = parser.add_subparsers(dest="stage", required=True)
    for stage in STAGES:
        sub = stages.add_parser(stage)
        sub.add_argument("--sequence", action="append", default=[], help="only this sequence; may be repeated")
        if stage in MODELS:
            sub.add_argument("--model", default="", help="module:factory of the model; called with the settings and the device")
        for s in options(stage):
            if s.flag:
                sub.add_argument(f"--{s.spelled}", dest=s.name, action="store_const", const=not s.default, default=s.default)
            elif s.repeated:
                sub.add_argument(f"--{s.spelled}", dest=s.name, action="append", default=[])
            else:
                sub.add_argument(f"--{s.spelled}", dest=s.name, type=type(s.default), default=s.default)
    return parser


def config_of(args: argparse.Namespace) -> Config:
    given = {s.name: getattr(args, s.name) for s in options(args.stage)}
    settings = {k: tuple(v) if isinstance(v, list) else v for k, v in given.items() if v != []}
    for root in ("dataset_root", "output_root"):
        if "://" not in settings[root]:
            settings[root] = os.path.abspath(os.path.expanduser(settings[root]))
    return Config(**settings)


def missing_commands(config: Config) -> str:
    """Why inpainting cannot start, '' if it can."""
    if config.dry_run:
        return ""
    if config.force_single_frame_fallback and not config.lama_command:
        return "inpaint-sequence requires --lama-command when --force-single-frame-fallback is used"
    if not config.propainter_command and not config.lama_command:
        return "inpaint-sequence requires --propainter-command or --lama-command unless --dry-run is used"
    return ""


def models(args: argparse.Namespace, config: Config) -> dict:
    """The model that the command line names for its stage.  Without one a stand-in runs, and says so."""
    if args.stage not in MODELS:
        return {}
    name, device = MODELS[args.stage]
    if not args.model:
        print(f"{args.stage}: no --model given, a stand-in that goes by gray values and boxes is used", file=sys.stderr)
        return {}
    from orbiscope.plans.backends import plugin

    return {name: plugin(args.model, config, getattr(config, device))}


def main(argv: list[str] | None = None, spark=None) -> int:
    args = build_parser().parse_args(argv)
    config = config_of(args)
    if args.stage == "inpaint-sequence" and (error := missing_commands(config)):
        print(json.dumps({"error": error}, indent=2, sort_keys=True))
        return 2
    if args.stage == "inpaint-sequence":
        from orbiscope.operators.windows import check_settings

        check_settings(config.inpaint_window_size, config.inpaint_window_stride)
    from orbiscope.plans.runner import Run, report

    if spark is None:
        from pyspark.sql import SparkSession

        spark = SparkSession.builder.appName(f"orbiscope {args.stage}").getOrCreate()
    run = Run(spark, config, args.sequence)
    sequences, frames = run.run(args.stage, **models(args, config))
    found = report(run, args.stage, sequences, frames)
    run.release()
    print(json.dumps(found, indent=2, sort_keys=True))
    return 0 if found["failed_sequences"] == 0 else 1


if __name__ == "__main__":
    sys.exit(main())
