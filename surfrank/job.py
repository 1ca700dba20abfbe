"""Batch job: rank the pages of an edge list and write ``id<TAB>rank`` files.

    spark-submit [--py-files surfrank.zip] rank_job.py --input edges/ --output ranks/ \\
        [--teleport 0.2] [--epsilon 1e-4] [--max-iter 300|none] [--preset script] \\
        [--partitions N] [--id-type string|long] [--format text|parquet] [--ordered] \\
        [--checkpoint-dir hdfs:///tmp/ranks] [--initial saved-ranks/] [--history steps/] \\
        [--save-matrix m/] [--progress run/ [--resume]] [--reproducible] [--single-file]
    spark-submit rank_job.py --matrix m/ --output ranks/ ...

``rank_job.py`` stands beside the package.  The result is written by the
executors to ``--output``; nothing is funnelled through the driver.  The log
tells how many lines were edges, comments, blank or malformed.  ``--matrix``
ranks from what ``--save-matrix`` wrote; ``--resume`` goes on where a run with the
same ``--progress`` folder ended.  Exit
codes: 0 converged; 1 failure, including a missing input; 3 the cap on steps
ended the run, and the newest vector was written.
"""

from __future__ import annotations

import argparse
import logging
import sys

from pyspark.sql import Observation, SparkSession

from .plans.layout import LinkMatrix
from .plans.rank import PRESETS, rank
from .sources.edges import read_edges, read_vector
from .sources.sinks import write_ranks


NOT_CONVERGED = 3


def _cap(text: str) -> int | str | None:
    return text if text == "preset" else None if text == "none" else int(text)


def parse_args(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(description="Rank pages of a tab-separated edge list.")
    source = p.add_mutually_exclusive_group(required=True)
    source.add_argument("--input", nargs="+", help="edge file(s), folder(s) or globs")
    source.add_argument("--matrix", help="folder that --save-matrix wrote")
    p.add_argument("--save-matrix", default=None, help="keep the matrix of the edges in this folder")
    p.add_argument("--progress", default=None, help="shared folder for the vector and history of the last step")
    p.add_argument("--resume", action="store_true", help="go on from the last step in --progress")
    p.add_argument("--reproducible", action="store_true", help="the same bits for any partitioning")
    p.add_argument("--single-file", action="store_true", help="one ordered text file, joined by the file system")
    p.add_argument("--output", required=True, help="result folder")
    p.add_argument("--preset", choices=sorted(PRESETS), default="script")
    p.add_argument("--teleport", "-t", type=float, default=None)
    p.add_argument("--epsilon", "-e", type=float, default=None)
    p.add_argument("--max-iter", type=_cap, default="preset", help="cap on steps, or none")
    p.add_argument("--checkpoint-dir", default=None, help="folder that all executors share")
    p.add_argument("--initial", default=None, help="start vector: ranks saved as parquet")
    p.add_argument("--partitions", type=int, default=None, help="partitions of matrix and vector")
    p.add_argument("--id-type", choices=("string", "long"), default="string")
    p.add_argument("--on-malformed", choices=("raise", "drop"), default="raise")
    p.add_argument("--format", choices=("text", "parquet"), default="text")
    p.add_argument("--ordered", action="store_true", help="sort the output by id")
    p.add_argument("--history", default=None, help="optional folder for the per-step history (parquet)")
    return p.parse_args(argv)


def main(argv: list[str] | None = None) -> int:
    args = parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s")
    spark = SparkSession.builder.appName("surfrank").getOrCreate()
    if args.checkpoint_dir:
        spark.sparkContext.setCheckpointDir(args.checkpoint_dir)
    log = logging.getLogger("surfrank")
    result = matrix = None
    try:
        if args.matrix:
            matrix = LinkMatrix.load(spark, args.matrix)
        else:
            report = Observation()
            matrix = LinkMatrix.build(read_edges(spark, args.input, args.id_type, args.on_malformed, report), args.partitions)
            log.info("read %s", ", ".join(f"{n} {k}" for k, n in report.get.items()))
            if args.save_matrix:
                matrix.save(args.save_matrix)
        result = rank(
            matrix=matrix,
            teleport=args.teleport,
            epsilon=args.epsilon,
            max_iter=args.max_iter,
            reproducible=args.reproducible,
            progress=args.progress,
            resume=args.resume,
            preset=args.preset,
            initial=read_vector(spark, args.initial) if args.initial else None,
        )
        write_ranks(result.ranks, args.output, args.format, args.ordered or args.single_file, args.single_file)
        if args.history:
            result.history.write.mode("overwrite").parquet(args.history)
        log.info(
            "ranked %d pages in %d steps (converged: %s)", result.n, result.iterations, result.converged
        )
        return 0 if result.converged else NOT_CONVERGED
    except Exception as exc:  # noqa: BLE001 - report and fail the job
        print(f"surfrank: {exc}", file=sys.stderr)
        return 1
    finally:
        if result is not None:
            result.release()
        if matrix is not None:
            matrix.unpersist()
        spark.stop()


if __name__ == "__main__":
    sys.exit(main())
