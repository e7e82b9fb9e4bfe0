"""Command line: ``python -m topicweave --source feed.jl --output out/ [--k 6 ...]``.

Runs the batch topic job with the session the environment provides
(``spark-submit`` on a cluster).  Options left out keep the defaults; a value
of 0 (for example ``--seed 0``) is honoured.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from topicweave.plans.run import JobConfig, run_topic_job


def main(argv: list[str] | None = None) -> dict[str, str]:
    p = argparse.ArgumentParser(prog="topicweave")
    p.add_argument("--source", required=True, help="JSON-lines offer feed")
    p.add_argument("--output", required=True, help="base output folder")
    p.add_argument("--k", type=int)
    p.add_argument("--iteration", type=int, dest="max_iter")
    p.add_argument("--seed", type=int)
    p.add_argument("--version")
    p.add_argument("--ngram", type=int)
    p.add_argument("--optimizer", choices=["online", "em"])
    args = p.parse_args(argv)
    cfg = JobConfig(output_base=args.output, source_json=args.source).with_overrides(
        k=args.k, max_iter=args.max_iter, seed=args.seed, version=args.version,
        ngram=args.ngram, optimizer=args.optimizer,
    )
    spark = SparkSession.builder.appName("topicweave").getOrCreate()
    paths = run_topic_job(spark, cfg)
    print(json.dumps(paths))
    return paths


if __name__ == "__main__":
    main()
