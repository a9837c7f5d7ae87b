"""Runs one stage: ``python -m cohortflow <stage> --option value ...``."""

from __future__ import annotations

import argparse
import inspect
import sys

from cohortflow.plans import stages
from cohortflow.session import build_session, ship_package

STAGES = {
    "land": stages.land_sources,
    "cohort": stages.build_cohort,
    "labels": stages.make_labels,
    "features": stages.rolling_features,
    "merge": stages.merge_training_table,
    "train": stages.train_classifier,
    "calibrate": stages.calibrate_model,
    "evaluate": stages.evaluate_model,
    "monitor": stages.monitor,
    "explain": stages.explain_high_risk,
    "retrain": stages.decide_retraining,
    "log-run": stages.log_run,
    "compare-runs": stages.compare_logged_runs,
}
NUMBERS = {
    "min_age": int, "prediction_window_days": int, "lookback_days": int, "seed": int,
    "validation_split": float, "calibration_split": float, "threshold": float, "max_age_days": int, "buckets": int,
}
NOT_OPTIONS = ("spark", "stratify")


def _threshold(text: str) -> tuple[str, float]:
    name, value = text.split("=")
    return name, float(value)


def _parameter(text: str) -> tuple[str, object]:
    """A model parameter: a number if it reads as one."""
    name, value = text.split("=")
    for kind in (int, float):
        try:
            return name, kind(value)
        except ValueError:
            continue
    return name, value


def parser() -> argparse.ArgumentParser:
    """Options are the stage functions' own parameters."""
    top = argparse.ArgumentParser(prog="cohortflow", description=__doc__)
    commands = top.add_subparsers(dest="stage", required=True)
    for name, function in STAGES.items():
        command = commands.add_parser(name)
        for option in inspect.signature(function).parameters.values():
            if option.kind is option.VAR_KEYWORD:
                command.add_argument("--params", nargs="+", type=_parameter, default=[], metavar="NAME=VALUE")
                continue
            if option.name in NOT_OPTIONS:
                continue
            flag = "--" + option.name.replace("_", "-")
            required = option.default is option.empty
            default = None if required else option.default
            if option.name == "thresholds":
                command.add_argument(flag, nargs="+", type=_threshold, metavar="NAME=VALUE")
            elif option.name == "protected":
                command.add_argument(flag, nargs="*", default=default)
            else:
                kind = NUMBERS.get(option.name, str)
                command.add_argument(flag, type=kind, required=required, default=default)
    return top


def main(arguments: list[str] | None = None) -> int:
    options = vars(parser().parse_args(arguments))
    stage = STAGES[options.pop("stage")]
    if "thresholds" in options:
        options["thresholds"] = dict(options["thresholds"] or stages.defaults.THRESHOLDS)
    return stage(ship_package(build_session()), **dict(options.pop("params", ())), **options) or 0


if __name__ == "__main__":
    sys.exit(main())
