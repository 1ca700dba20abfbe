"""The convergence loop (R1-R5): repeat the rank step until the L1 change is small.

Step ``k`` (1-based) computes from ``v[k-1]``::

    y[k] = (1 - t) * M v[k-1]
    v[k] = y[k] + (1 - sum(y[k])) / n
    delta[k] = sum(|v[k] - v[k-1]|)

and stops when ``delta[k] < epsilon`` (strict) or ``k == max_iter``.  With
``compare_first=False`` step 1 is not compared, so at least two steps run.
The vector returned is ``v[k]``, the newest one.

Execution per step is one Spark job:

* ``sum(y[k])`` is known before the step: column sums of ``M`` are 1 for
  every non-sink source, so ``sum(y[k]) = (1 - t) * (mass of v[k-1] on
  non-sink vertices)``;
* the step's plan merges the cached matrix with the previous vector
  (partition-local), sums contributions per target with partial aggregation
  (the only shuffle, of target and sum), and joins the sums to the previous
  vector in place, so vertices without in-links keep their row;
* the job writes the new vector as a reliable checkpoint
  (``spark.checkpoint.dir``) and observes on the way ``delta[k]``, the vector's sum
  and the non-sink mass needed by step ``k + 1``.  A vector that does not sum to 1
  fails the run.

The checkpoint is the next step's input: the previous vector is used twice per
step, so without a cut the logical plan would double with every step.  A lost
executor never recomputes more than one step.

The three scalars are exact sums (``functions.exact``): they depend on the vector
alone, not on its partitions.  With ``reproducible=True`` the contributions are
summed that way too, as two whole numbers per target instead of a double; then
ranks, history and the number of steps have the same bits for every number of
partitions, every order of edges and every retry.

With ``progress`` a run leaves a folder behind that tells where it stands: the
vector of a step as Parquet, then a manifest (settings, history, non-sink mass)
renamed into place.  ``resume=True`` goes on from the last manifest.
"""

from __future__ import annotations

import json
import logging
import time
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exact import UNIT, exact_sum, joined_sql, limbs_sql, unit_weights
from ..functions.values import local_rows
from ..session import checkpoint_dir, drop_checkpoint, handed
from ..sources import files
from .layout import LinkMatrix

log = logging.getLogger(__name__)

# Fixed values of the three variants of the original tool (teleport rate,
# convergence threshold, step cap or None, whether step 1 is compared with the start vector).
PRESETS = {
    "script": {"teleport": 0.2, "epsilon": 1e-4, "max_iter": 300, "compare_first": False},
    "notebook": {"teleport": 0.2, "epsilon": 1e-10, "max_iter": 300, "compare_first": False},
    "cluster": {"teleport": 0.15, "epsilon": 1e-5, "max_iter": None, "compare_first": True},
}

# how far the sum of a vector may be from 1 by rounding
MASS_TOLERANCE = 1e-6

HISTORY_SCHEMA = T.StructType(
    [
        T.StructField("iteration", T.IntegerType(), False),
        T.StructField("vector_sum", T.DoubleType(), True),
        T.StructField("l1_delta", T.DoubleType(), True),
    ]
)


@dataclass
class StepStats:
    iteration: int
    vector_sum: float
    l1_delta: float | None
    seconds: float


@dataclass
class RankResult:
    ranks: DataFrame
    history: DataFrame
    iterations: int
    converged: bool
    steps: list[StepStats] = field(default_factory=list)
    strategy: str = ""
    n: int = 0
    hubs: int = 0  # sources that took the hub path (broadcast of their own ranks)
    _written: DataFrame | None = field(default=None, repr=False)

    def release(self) -> None:
        """Delete the checkpoint files behind ``ranks``, which cannot be read any more."""
        if self._written is not None:
            drop_checkpoint(self._written)
            self._written = None


def rank(
    edges: DataFrame | None = None,
    teleport: float | None = None,
    epsilon: float | None = None,
    max_iter: int | None | str = "preset",
    compare_first: bool | None = None,
    num_partitions: int | None = None,
    initial: DataFrame | None = None,
    strategy: str = "partitioned",
    max_hot: int | None = None,
    hot_min_rows: int = 10_000,
    preset: str = "script",
    encode_ids: bool | None = None,
    matrix: LinkMatrix | DataFrame | None = None,
    reproducible: bool = False,
    progress: str | None = None,
    resume: bool = False,
) -> RankResult:
    """Rank the vertices of ``edges(src, dst)``; see the module doc for the semantics.

    ``preset`` ("script", "notebook", "cluster") supplies teleport,
    epsilon, max_iter and compare_first where they are not given;
    ``max_iter=None`` runs until convergence.  ``RankResult.converged`` tells
    whether a cap ended the run.  Edges with a null end fail.
    ``initial`` is an optional start vector ``(id, rank)`` with unique ids
    (ids it lacks start at 0).  ``strategy`` picks the per-step join:
    "partitioned", or "broadcast" (fails if the vector exceeds the session's
    broadcast threshold).  ``encode_ids`` runs the loop on bigint ids and
    decodes the result with one join; without it a run does so where ids are text and
    entries many (``layout.ENCODED_FROM``).

    ``matrix`` takes the place of ``edges``: a ``LinkMatrix`` (built before, or
    loaded from where ``LinkMatrix.save`` wrote it; it stays usable), or a relation
    ``(src, dst, w)``.  ``progress`` is a folder that all executors share;
    ``resume=True`` goes on from what a run with the same matrix, teleport, start and
    ``compare_first`` left there, or begins anew if there is nothing.
    """
    p = PRESETS[preset]
    teleport = p["teleport"] if teleport is None else float(teleport)
    epsilon = p["epsilon"] if epsilon is None else float(epsilon)
    max_iter = p["max_iter"] if max_iter == "preset" else max_iter
    compare_first = p["compare_first"] if compare_first is None else bool(compare_first)
    if not 0.0 <= teleport <= 1.0:
        raise ValueError("teleport must be in [0, 1]")
    if max_iter is not None and max_iter < 1:
        raise ValueError("max_iter must be at least 1")
    if (edges is None) == (matrix is None):
        raise ValueError("rank takes either edges or a matrix")
    if resume and progress is None:
        raise ValueError("resume needs the progress folder of the earlier run")
    given = edges if edges is not None else matrix.cold if isinstance(matrix, LinkMatrix) else matrix
    spark = initial.sparkSession if initial is not None else given.sparkSession
    if isinstance(matrix, LinkMatrix) and initial is None:
        spark = matrix.owner or spark
    checkpoint_dir(spark)
    if initial is not None and not initial.groupBy("id").count().filter("count > 1").isEmpty():
        raise ValueError("the start vector has an id twice")
    if isinstance(matrix, LinkMatrix):
        lm = matrix
    else:
        make = LinkMatrix.build if matrix is None else LinkMatrix.from_matrix
        lm = make(given, num_partitions, strategy, max_hot, hot_min_rows, encode_ids=encode_ids)
    try:
        if lm.n == 0:
            schema = T.StructType(
                [T.StructField("id", lm.id_type), T.StructField("rank", T.DoubleType())]
            )
            empty = spark.createDataFrame([], schema)
            return RankResult(empty, spark.createDataFrame([], HISTORY_SCHEMA), 0, True, [], lm.strategy, 0)
        kept = _Progress(spark, progress, resume, lm, teleport, compare_first, initial) if progress else None
        if initial is not None:
            initial = handed(initial, lm.session)
            if lm.dictionary is not None:
                initial = initial.join(lm.dictionary, "id").select(F.col("vid").alias("id"), "rank")
        result = _iterate(lm, teleport, epsilon, max_iter, compare_first, initial, reproducible, kept)
        if lm.dictionary is not None:
            # back to the original ids: one join on unique keys, written out so
            # the result does not depend on the caches dropped below
            decoded = result.ranks.select(F.col("id").alias("vid"), "rank").join(lm.dictionary, "vid")
            result.ranks = decoded.select("id", "rank").checkpoint(eager=True)
            if result._written is not None:
                drop_checkpoint(result._written)
            result._written = result.ranks
        result.ranks = handed(result.ranks, spark)
        result.history = _history(spark, result.steps)
        return result
    finally:
        if lm is not matrix:
            lm.unpersist()


def _history(spark: SparkSession, steps: list[StepStats]) -> DataFrame:
    return local_rows(spark, [(s.iteration, s.vector_sum, s.l1_delta) for s in steps], HISTORY_SCHEMA)


class _Progress:
    """The folder of a run: ``step-<k>`` (vector as Parquet) and ``manifest-<k>.json``, k with ten digits.

    A manifest is renamed into place after its vector is written, so the last
    manifest always belongs to a whole vector; older pairs go afterwards.
    """

    def __init__(self, spark, path, resume, lm, teleport, compare_first, initial) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        # what must agree for a later run to go on; matrices are told apart by their counts
        self.facts = {
            "teleport": teleport, "compare_first": compare_first, "given_start": initial is not None,
            "n": lm.n, "n_sinks": lm.n_sinks, "entries": lm.entries, "encoded": lm.dictionary is not None,
        }
        self.found: dict | None = None
        if resume and (told := self._manifests()):
            self.found = json.loads(files.read_text(spark, f"{self.path}/{told[-1]}"))
            differs = {k for k, v in self.facts.items() if self.found["facts"][k] != v}
            if differs:
                raise ValueError(f"the run in {path} had another {', '.join(sorted(differs))}")
        elif not resume:
            files.remove(spark, self.path)

    def _manifests(self) -> list[str]:
        return [n for n in files.names(self.spark, self.path) if n.startswith("manifest-") and n.endswith(".json")]

    def vector(self, lm: LinkMatrix) -> DataFrame:
        """``(id, rank, sink)`` of the last step; ids of an encoded run are those of the dictionary."""
        kept = lm.session.read.parquet(f"{self.path}/{self.found['vector']}")
        if lm.dictionary is not None:
            kept = kept.join(lm.dictionary, "id").select(F.col("vid").alias("id"), "rank")
        return start_vector(lm, kept)

    def step(
        self, lm: LinkMatrix, vec: DataFrame, steps: list[StepStats], live_mass: float, weights: tuple[int, ...]
    ) -> None:
        k = steps[-1].iteration
        name = f"step-{k:010d}"
        out = vec.select("id", "rank")
        if lm.dictionary is not None:
            out = out.select(F.col("id").alias("vid"), "rank").join(lm.dictionary, "vid").select("id", "rank")
        out.write.mode("overwrite").parquet(f"{self.path}/{name}")
        done = [[s.iteration, s.vector_sum, s.l1_delta, s.seconds] for s in steps]
        told = {"vector": name, "live_mass": live_mass, "weights": weights, "facts": self.facts, "steps": done}
        files.write_text(self.spark, f"{self.path}/manifest-{k:010d}.json", json.dumps(told))
        for old in files.names(self.spark, self.path):
            if old.startswith(("step-", "manifest-")) and not old.startswith((name, f"manifest-{k:010d}")):
                files.remove(self.spark, f"{self.path}/{old}")


def start_vector(lm: LinkMatrix, initial: DataFrame | None) -> DataFrame:
    """``(id, rank, sink)`` over all vertices: uniform, or taken from ``initial``."""
    base = lm.vertices.select("id", (F.col("entries") == 0).alias("sink"))
    if initial is None:
        return base.select("id", F.lit(1.0 / lm.n).alias("rank"), "sink")
    given = initial.select("id", F.col("rank").cast("double").alias("_r"))
    return base.join(given, "id", "left").select(
        "id", F.coalesce("_r", F.lit(0.0)).alias("rank"), "sink"
    )


def next_vector(
    lm: LinkMatrix, prev: DataFrame, teleport: float, shift: float, weights: tuple[int, ...] | None = None
) -> DataFrame:
    """``(id, rank, prev, sink)`` of the next step; ``shift`` = ``(1 - sum(y)) / n``.

    ``prev`` is ``(id, rank, sink)``.  ``weights``: sum contributions exactly, with
    these limbs.  The vector's own columns go through without a qualifier: a
    checkpoint of the result then tells its partitioning by the columns it has.
    """
    views = lm.register()
    prev.createOrReplaceTempView(views["prev"])
    sql, total = sums_sql(lm, views["prev"], weights)
    rank = f"{1.0 - teleport!r}D * coalesce({total}, 0.0D) + {shift!r}D as rank"
    sums = lm.session.sql(sql).hint("merge")
    return prev.join(sums, "id", "left").selectExpr("id", rank, "rank as prev", "sink")


def sums_sql(lm: LinkMatrix, prev: str, weights: tuple[int, ...] | None = None) -> tuple[str, str]:
    """SQL of the sums per target ``(id, ...)`` and of the double they stand for."""
    parts = lm.contribution_sql(prev)
    if weights is None:
        return f"select id, sum(c) as c from ({parts}) group by id", "c"
    limbs = ", ".join(f"{x} as c{i}" for i, x in enumerate(limbs_sql("c", weights)))
    names = [f"c{i}" for i in range(len(weights))]
    sums = ", ".join(f"sum({c}) as {c}" for c in names)
    return f"select id, {sums} from (select id, {limbs} from ({parts})) group by id", joined_sql(names, weights)


def _scalars(weights: tuple[int, ...]) -> list[Column]:
    """What a step tells of its ``(id, rank, prev, sink)``: L1 change, mass on vertices with out-links, sum."""
    live = F.when(F.col("sink"), 0.0).otherwise(F.col("rank"))
    change = F.abs(F.col("rank") - F.col("prev"))
    return [exact_sum(x, weights).alias(name) for name, x in (("l1", change), ("live", live), ("total", F.col("rank")))]


def _iterate(
    lm: LinkMatrix,
    teleport: float,
    epsilon: float,
    max_iter: int | None,
    compare_first: bool,
    initial: DataFrame | None,
    reproducible: bool,
    kept: _Progress | None,
) -> RankResult:
    n = lm.n
    steps: list[StepStats] = []
    written: DataFrame | None = None  # checkpointed DataFrame behind ``vec``
    weights = UNIT
    if kept and kept.found:
        steps = [StepStats(*s) for s in kept.found["steps"]]
        vec = written = kept.vector(lm).checkpoint(eager=True)
        live_mass, weights = kept.found["live_mass"], tuple(kept.found["weights"])
    elif initial is None:
        vec = start_vector(lm, None)
        live_mass = (n - lm.n_sinks) / n
    else:
        vec = written = start_vector(lm, initial).checkpoint(eager=True)
        norm = float(vec.agg(F.sum(F.abs("rank"))).collect()[0][0] or 0.0)
        # steps bring any vector nearer to the ranks: entries sum to at most norm + 2, changes to twice that
        weights = unit_weights(norm + 2.0)
        live_mass = float(vec.agg(exact_sum(F.when(~F.col("sink"), F.col("rank")), weights)).collect()[0][0] or 0.0)
    scalars = _scalars(weights)
    k = steps[-1].iteration if steps else 0
    converged = bool(steps) and steps[-1].l1_delta is not None and steps[-1].l1_delta < epsilon
    while not converged and (max_iter is None or k < max_iter):
        k += 1
        t0 = time.perf_counter()
        y_sum = (1.0 - teleport) * live_mass
        shift = (1.0 - y_sum) / n
        # one job computes the step, writes it and observes the scalars; the next
        # step starts from the written files, so plan and lineage stay as they are
        told = Observation()
        raw = next_vector(lm, vec, teleport, shift, weights if reproducible else None)
        nxt = raw.observe(told, *scalars).select("id", "rank", "sink").checkpoint(eager=True)
        row = told.get
        compared = compare_first or k > 1
        delta = float(row["l1"]) if compared else None
        live_mass = float(row["live"] or 0.0)
        total = float(row["total"])
        if not abs(total - 1.0) < MASS_TOLERANCE:
            raise RuntimeError(f"step {k}: the ranks sum to {total!r}, not 1")
        y_sum = total - n * shift  # as measured
        # the new vector is written now; the previous one is read by nothing
        if written is not None:
            drop_checkpoint(written)
        written = vec = nxt
        steps.append(StepStats(k, y_sum, delta, time.perf_counter() - t0))
        if kept:
            kept.step(lm, vec, steps, live_mass, weights)
        log.info("step %d: vector sum %.17g, l1 change %s", k, y_sum, delta)
        if delta is not None and delta < epsilon:
            converged = True
            break
    if not converged:
        log.warning("stopped at the cap of %s steps before convergence", max_iter)
    result = RankResult(vec.select("id", "rank"), None, k, converged, steps, lm.strategy, n, lm.n_hubs)
    result._written = written
    return result
