"""Command line: ``run``, ``bundle``, ``split-files`` and ``submit-script``."""

from __future__ import annotations

import argparse
import json
import os
from datetime import datetime


def _run(args: argparse.Namespace) -> int:
    from pyspark.sql import SparkSession

    from .operators.tracks import make_tracker
    from .plans.models import state_by_threshold
    from .plans.pipelines import Settings, get_pipeline, run_report
    from .sources.bundle import read_config
    from .sources.files import write_tables
    from .sources.tiff import FOCUS_PIXEL_SIZE, PIXEL_SIZE, read_planes, save_tiffs

    began, config = datetime.now(), read_config(args.config)
    pipeline, _ = get_pipeline(config["pipeline"])
    spark = SparkSession.builder.appName(config["pipeline"]).getOrCreate()
    planes = read_planes(spark, config["input"], config.get("channels", 1), config.get("slices", 1), config.get("pattern", "*.tif*"), FOCUS_PIXEL_SIZE if config["pipeline"] == "out_of_focus" else PIXEL_SIZE)
    if args.worklist:
        with open(args.worklist, encoding="utf-8") as f:
            names = [os.path.basename(x.strip()).split(".tif")[0] for x in f if x.strip()]
        planes = planes.where(planes["movie"].isin(names))
    s = Settings(**config.get("settings", {}))
    if "tracker" in config:
        s.tracker = make_tracker(**config["tracker"])
    if bar := config.get("state_threshold"):
        s.state = lambda df: state_by_threshold(df, "rel_mean_intensity", float(bar))
    result = pipeline(planes.where("error IS NULL").drop("pixel_size", "error"), s)
    write_tables(result.objects, result.summary if result.summary is not None else result.objects.limit(0), config["output"])
    if config.get("export_labels") and result.labels is not None:
        save_tiffs(result.labels, config["output"], "_labels.tiff", config.get("labels_type", "uint16")).collect()
    if config.get("export_planes") and result.planes is not None:
        save_tiffs(result.planes, config["output"], "_transformed.tiff", "float32").collect()
    bad = planes.where("error IS NOT NULL").select("movie", "error").collect()
    with open(os.path.join(config["output"], "run_log.json"), "w", encoding="utf-8") as f:
        json.dump({"pipeline": config["pipeline"], "started": began.isoformat(timespec="seconds"), "seconds": round((datetime.now() - began).total_seconds(), 1), "movies": [r.asDict() for r in run_report(result).orderBy("movie").collect()] if "frame" in result.objects.columns else [], "errors": [r.asDict() for r in bad]}, f, indent=1)
    return 0


def _bundle(args: argparse.Namespace) -> int:
    from .sources.bundle import write_bundle

    print(write_bundle(args.info, args.output, args.date))
    return 0


def _split(args: argparse.Namespace) -> int:
    names = sorted(n for n in os.listdir(args.folder) if args.pattern in n and n.endswith(args.extension))
    size = -(-len(names) // args.blocks) or 1
    for i in range(0, len(names), size):
        with open(os.path.join(args.output, f"worklist_{i // size}.txt"), "w", encoding="utf-8") as f:
            f.writelines((os.path.join(args.folder, n) if args.full_path else n) + "\n" for n in names[i : i + size])
    return 0


def _script(args: argparse.Namespace) -> int:
    run = os.path.join(os.path.dirname(os.path.abspath(__file__)), "run.py")
    lines = ["#!/bin/bash", f"#SBATCH --job-name={args.name}", f"#SBATCH --nodes={args.nodes}", f"#SBATCH --mem={args.memory}", f"#SBATCH --time={args.time}"]
    print("\n".join([*lines, f"spark-submit --name {args.name} --num-executors {args.nodes} --executor-memory {args.memory} {run} run --config {args.config}"]))
    return 0


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="stackrill", description=__doc__)
    sub = parser.add_subparsers(required=True)
    p = sub.add_parser("run")
    p.add_argument("--config", required=True)
    p.add_argument("--worklist")
    p.set_defaults(f=_run)
    p = sub.add_parser("bundle")
    p.add_argument("info")
    p.add_argument("output")
    p.add_argument("--date", action="store_true")
    p.set_defaults(f=_bundle)
    p = sub.add_parser("split-files")
    p.add_argument("folder")
    p.add_argument("output")
    p.add_argument("--blocks", type=int, default=1)
    p.add_argument("--pattern", default="")
    p.add_argument("--extension", default="")
    p.add_argument("--full-path", action="store_true")
    p.set_defaults(f=_split)
    p = sub.add_parser("submit-script")
    p.add_argument("--config", required=True)
    p.add_argument("--name", default="stackrill")
    p.add_argument("--nodes", type=int, default=1)
    p.add_argument("--memory", default="32g")
    p.add_argument("--time", default="08:00:00")
    p.set_defaults(f=_script)
    args = parser.parse_args(argv)
    return args.f(args)


if __name__ == "__main__":
    raise SystemExit(main())
