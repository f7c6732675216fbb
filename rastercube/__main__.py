"""Command lines: python -m rastercube build | verify | masks."""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from rastercube import config as settings
from rastercube.operators import landcover, verify
from rastercube.plans import build as dataset
from rastercube.plans import masks


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="rastercube", description=__doc__)
    sub = p.add_subparsers(dest="command", required=True)
    b = sub.add_parser("build", help="rasters and a boundary to a dataset")
    b.add_argument("--config", required=True)
    b.add_argument("--mode", choices=("full", "test"), default="full")
    b.add_argument("--test-months", type=int, default=13, help="months that a test build uses, one more than a sequence at least")
    b.add_argument("--overwrite", action="store_true")
    v = sub.add_parser("verify", help="check samples of an earlier build against its cube")
    v.add_argument("--config", required=True)
    v.add_argument("--per-split", type=int, default=5)
    m = sub.add_parser("masks", help="urban and rural masks on a reference grid")
    for name in ("land-cover", "study-boundary", "reference-grid", "output-dir"):
        m.add_argument(f"--{name}", required=True)
    m.add_argument("--rural-buffer-km", type=float, default=5.0)
    m.add_argument("--urban-class", type=int, default=landcover.URBAN)
    m.add_argument("--no-clip-to-boundary", dest="clip", action="store_false")
    m.add_argument("--overwrite", action="store_true")
    return p


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName("rastercube").getOrCreate()
    try:
        if args.command == "masks":
            made = masks.build(spark, masks.MaskConfig(args.land_cover, args.study_boundary, args.reference_grid, args.output_dir, args.rural_buffer_km * 1000, args.urban_class, clip=args.clip, overwrite=args.overwrite))
            print(json.dumps(made.metadata, indent=2, default=str))
            return 0
        config = settings.load(args.config)
        if args.command == "build":
            config = config.override(test_months=args.test_months) if args.mode == "test" else config
            made, shares = dataset.from_rasters(spark, config, args.overwrite), (0.0, 0.5, 1.0)
        else:
            made = dataset.open_dataset(spark, config, spark.read.parquet(f"{config.paths.output_dir}/cube"))
            shares = (0.0, 0.25, 0.5, 0.75, 1.0)[: max(1, args.per_split)]
        print(json.dumps(verify.require(dataset.verify_dataset(made, shares)), indent=2, default=str))
        return 0
    except (landcover.MaskError, verify.VerifyError) as e:
        print(e, file=sys.stderr)
        return 1


if __name__ == "__main__":
    sys.exit(main())
