"""python -m spanwright annotate ROOT OUT | score REF PRED OUT | query NAME SF_DIR OUT"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="spanwright")
    commands = parser.add_subparsers(dest="command", required=True)
    for name, args in (("annotate", ("root", "out")), ("score", ("ref", "pred", "out")), ("query", ("name", "sf_dir", "out"))):
        own = commands.add_parser(name)
        for a in args:
            own.add_argument(a)
    args = parser.parse_args(argv)
    spark = SparkSession.builder.appName("spanwright").getOrCreate()
    if args.command == "query":
        from . import catalog

        if args.name not in catalog.QUERIES:
            print(f"no query {args.name}; there are {', '.join(catalog.QUERIES)}", file=sys.stderr)
            return 2
        catalog.QUERIES[args.name](spark, args.sf_dir).write.mode("overwrite").parquet(args.out)
        return 0
    from .plans.study import annotate, scores
    from .sources import dataset as D

    if args.command == "annotate":
        D.check_storage(D.dataset_info(spark, args.root))
        frames = D.with_task(D.frame_shards(spark, args.root), D.tasks(spark, args.root))
        own = frames.select(F.col("episode_index").alias("episode"), F.col("timestamp").alias("t"), F.col("frame_index").alias("event_id"), F.col("task").alias("label"))
        from .operators.spans import run_length_spans

        out, bad = annotate(own, run_length_spans(own, drop_blank=True))
        out.write.mode("overwrite").parquet(f"{args.out}/frames")
        bad.write.mode("overwrite").json(f"{args.out}/violations")
        return int(not bad.where("severity = 'error'").isEmpty())
    ref, pred = spark.read.parquet(args.ref), spark.read.parquet(args.pred)
    scores(ref.select("episode").distinct(), pred, ref).write.mode("overwrite").parquet(args.out)
    return 0


if __name__ == "__main__":
    sys.exit(main())
