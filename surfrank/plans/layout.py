"""Physical layout of the transition matrix for repeated multiplication.

``LinkMatrix.build`` turns an edge DataFrame into:

* ``vertices``: ``(id, out_degree, entries)``, out_degree counts edge rows
  (0 = sink), entries counts distinct targets (matrix rows per source);
* ``cold``: matrix entries of ordinary sources, hash-partitioned by
  ``src`` into ``num_partitions`` and cached; the per-step join with the
  vector (hash-partitioned by ``id`` into the same number) is then local;
* ``hot``: entries of hub sources (at most ``max_hot`` of them, a proven
  bound), cached in the balanced layout of the pair aggregation; per step
  they join a broadcast copy of the hubs' vector entries (a semi join of the
  vector with the hub table), so no task receives a hub's whole row set;
* scalars: vertex and sink counts, edge rows, matrix entries.

All of it lives in a session of its own (``session``), whose settings fit the
loop; the caller's session keeps its settings.  The layout is also the handle of
repeated products: ``multiply`` and ``rank_step`` take it in place of a matrix and
then neither count nor lay out anything again.

``save`` writes the layout: entries bucketed and sorted by ``src``, vertices
bucketed by ``id``, hub tables, and last a manifest with the scalars.  ``load``
reads it back; bucketed scans report the partitioning the steps need, so nothing
is shuffled.  ``from_matrix`` lays out a plain relation ``(src, dst, w)``.

Strategy ``broadcast`` ships the whole vector to every task instead.  It
is used only when asked for.  No broadcast is estimated above the session's
broadcast threshold (``spark.sql.autoBroadcastJoinThreshold``): a larger vector
goes in slices by the hash of the id, each joined with the entries of its own
sources, which lie together in their partitions.  The build fails where one row
is above the threshold or more than ``MAX_SLICES`` slices were needed, as all
slices of a step are in flight at once.
"""

from __future__ import annotations

import json
import math
import uuid
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.skew import hot_threshold, split_join
from ..session import broadcast_budget, checkpoint_dir, child_session, drop_checkpoint, handed, scoped_conf
from ..sources import files
from ..sources.edges import complete_edges

STRATEGIES = ("partitioned", "broadcast")
# estimated bytes per broadcast vector row besides the id: rank double + row overhead
_ROW_OVERHEAD = 8 + 24
# matrix entries per partition of the loop, where no number of partitions is given:
# at most so many (about 50 MB), and as few as this while there are idle cores
ROWS_PER_PARTITION = 2_097_152
FEW_ROWS = 32_768
# matrix entries from which a run encodes text ids, where it is not told whether to
ENCODED_FROM = 1 << 19
# how far the weights of a source may be from 1 by rounding
WEIGHT_TOLERANCE = 1e-9
MANIFEST = "matrix.json"


def _partitions(entries: int, rows_per_partition: int, cores: int) -> int:
    """Partitions for ``entries``: one per ``rows_per_partition``, or one per core while each gets ``FEW_ROWS``."""
    return max(1, math.ceil(entries / rows_per_partition), min(cores, math.ceil(entries / FEW_ROWS)))


# slices of a vector that strategy "broadcast" ships in one step at most, and the room for
# slices that get more than their share of the ids
MAX_SLICES = 64
SLICE_ROOM = 1.1
FILE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# the parts of a saved layout that are bucketed, and by what
BUCKETED = {"cold": "src", "vertices": "id"}


def _name(part: str) -> str:
    return f"surfrank_{part}_{uuid.uuid4().hex}"


def _fitted(session: SparkSession, parts: int) -> SparkSession:
    """The layout's own session with the settings of the loop.

    AQE would merge the partitions of a step's shuffle and so bring a second
    shuffle; buckets must be read as partitions, in the order they were sorted in.
    """
    settings = {
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.shuffle.partitions": str(parts),
        # a step's shuffle goes with the step, not whenever the driver happens to collect its garbage
        FILE_CLEANUP: "true",
        "spark.sql.sources.bucketing.enabled": "true",
        "spark.sql.sources.bucketing.autoBucketedScan.enabled": "false",
        "spark.sql.legacy.bucketedTableScan.outputOrdering": "true",
    }
    for key, value in settings.items():
        session.conf.set(key, value)
    return session


def _hashed(pairs: DataFrame, verts: DataFrame, parts: int):
    """Pairs and vertices keyed by a 64-bit hash of the id, if no two vertices share one, else None.

    The vertex table tells that exactly: it is laid out by the hash, so equal ones
    meet in a partition.  No pair is joined or shuffled for the new keys.  Returns
    pairs, vertices, the ``(id, vid)`` dictionary and the written table behind both.
    """
    key = F.xxhash64("id").alias("vid")
    with scoped_conf(verts.sparkSession, {"spark.sql.adaptive.enabled": "false"}):
        laid = _written(
            verts.select(key, "id", "out_degree", "entries", "in_entries").repartition(parts, "vid").sortWithinPartitions("vid")
        )
    if not laid.groupBy("vid").count().filter("count > 1").isEmpty():
        laid.unpersist()
        drop_checkpoint(laid)
        return None
    keyed = pairs.select(F.xxhash64("src").alias("src"), F.xxhash64("dst").alias("dst"), "copies")
    return keyed, laid.select(F.col("vid").alias("id"), "out_degree", "entries", "in_entries"), laid.select("id", "vid"), laid


def _slices(n: int, row_bytes: float, budget: int) -> int:
    """How many slices of a vector of ``n`` rows keep each broadcast within ``budget`` bytes."""
    size = n * row_bytes
    if size <= budget:
        return 1
    slices = math.ceil(SLICE_ROOM * size / budget) if row_bytes <= budget else MAX_SLICES + 1
    if slices > MAX_SLICES:
        raise ValueError(
            f"the vector has about {size:.0f} bytes, more than {MAX_SLICES} times spark.sql.autoBroadcastJoinThreshold "
            "or too much for a slice of it; use strategy='partitioned'"
        )
    return slices


def _slice_sql(key: str, slices: int) -> str:
    return f"pmod(hash({key}), {slices})"


def _encode(pairs: DataFrame, verts: DataFrame, threshold: int):
    """Re-key the pair and vertex tables with a unique bigint per vertex, where hashes are not unique.

    The vertex table is written as a reliable checkpoint first, so that
    ``monotonically_increasing_id`` (partition index and row position) gives
    the same number to a vertex whenever the plan is recomputed.  Pairs are
    re-keyed by two joins on the text id; hub sources and hub targets (at
    most ``max_hot`` each, by the entry-count threshold) join a broadcast
    copy of their dictionary rows, so no task gets a hub's whole row set.
    Returns pairs, vertices, the ``(id, vid)`` dictionary and the checkpoint.
    """
    fixed = verts.checkpoint(eager=True)
    numbered = fixed.select(
        F.monotonically_increasing_id().alias("vid"), "id", "out_degree", "entries", "in_entries"
    ).persist(StorageLevel.MEMORY_AND_DISK)
    dictionary = numbered.select("id", "vid")
    hot_src = fixed.filter(F.col("entries") >= threshold).select(F.col("id").alias("src"))
    hot_dst = fixed.filter(F.col("in_entries") >= threshold).select(F.col("id").alias("dst"))
    by_src = split_join(
        pairs, dictionary.select(F.col("id").alias("src"), F.col("vid").alias("src_vid")), "src", hot_src
    )
    both = split_join(
        by_src, dictionary.select(F.col("id").alias("dst"), F.col("vid").alias("dst_vid")), "dst", hot_dst
    )
    encoded = both.select(F.col("src_vid").alias("src"), F.col("dst_vid").alias("dst"), "copies").persist(
        StorageLevel.MEMORY_AND_DISK
    )
    new_verts = numbered.select(F.col("vid").alias("id"), "out_degree", "entries", "in_entries").persist(
        StorageLevel.MEMORY_AND_DISK
    )
    encoded.count()  # fill the cache before the text-keyed pairs are dropped
    verts.unpersist()
    return encoded, new_verts, numbered, fixed


def _written(df: DataFrame) -> DataFrame:
    """Reliable checkpoint, then cached; materialized by the first step."""
    return df.checkpoint(eager=True).persist(StorageLevel.MEMORY_AND_DISK)


@dataclass
class LinkMatrix:
    vertices: DataFrame
    cold: DataFrame
    hot: DataFrame | None
    hubs: DataFrame | None  # (id) of the hub sources
    n_hubs: int
    n: int
    n_sinks: int
    edge_rows: int | None  # None where the matrix was given
    entries: int
    num_partitions: int
    strategy: str
    id_type: T.DataType
    session: SparkSession
    owner: SparkSession | None = None  # the session it was made from; results go there
    dictionary: DataFrame | None = None
    slices: int = 1  # of the vector, under strategy "broadcast"
    _tables: list = field(default_factory=list, repr=False)
    _cached: list = field(default_factory=list, repr=False)
    _views: dict = field(default_factory=dict, repr=False)

    @classmethod
    def build(
        cls,
        edges: DataFrame,
        num_partitions: int | None = None,
        strategy: str = "partitioned",
        max_hot: int | None = None,
        hot_min_rows: int = 10_000,
        rows_per_partition: int = ROWS_PER_PARTITION,
        encode_ids: bool | None = False,
    ) -> "LinkMatrix":
        """Build and cache the layout.  ``num_partitions`` defaults to one partition
        per ``rows_per_partition`` matrix entries, so it grows with the data; a given
        number is multiplied until no partition has more than that on average.
        ``encode_ids``: run the loop on bigint ids (None: where ids are text and
        entries many).  An edge with a null end fails the build."""
        if strategy not in STRATEGIES:
            raise ValueError(f"strategy must be one of {STRATEGIES}")
        # duplicates merged before anything else; partial aggregation per task
        pairs = complete_edges(edges.select("src", "dst")).groupBy("src", "dst").agg(F.count(F.lit(1)).alias("copies"))
        return cls._laid_out(
            edges.sparkSession, pairs, False, num_partitions, strategy, max_hot, hot_min_rows, rows_per_partition, encode_ids
        )

    @classmethod
    def from_matrix(
        cls,
        matrix: DataFrame,
        num_partitions: int | None = None,
        strategy: str = "partitioned",
        max_hot: int | None = None,
        hot_min_rows: int = 10_000,
        rows_per_partition: int = ROWS_PER_PARTITION,
        encode_ids: bool | None = False,
    ) -> "LinkMatrix":
        """Lay out a transition matrix ``(src, dst, w)``, for example of ``read_matrix``.

        The vertices are the ids at either end.  Entries of equal coordinates are
        added up; weights must not be negative or null, and those of a source must sum to 1.
        """
        if strategy not in STRATEGIES:
            raise ValueError(f"strategy must be one of {STRATEGIES}")
        weight = F.when((F.col("w") >= 0) & ~F.isnan("w"), F.col("w")).otherwise(F.raise_error(F.lit("a weight is negative or missing")))
        rows = complete_edges(matrix.select("src", "dst", F.col("w").cast("double").alias("w")))
        pairs = rows.withColumn("w", weight.cast("double")).groupBy("src", "dst").agg(F.sum("w").alias("copies"))
        return cls._laid_out(
            matrix.sparkSession, pairs, True, num_partitions, strategy, max_hot, hot_min_rows, rows_per_partition, encode_ids
        )

    @classmethod
    def _laid_out(cls, owner: SparkSession, pairs: DataFrame, *options) -> "LinkMatrix":
        held: list[DataFrame] = []
        try:
            lm = cls._build(pairs, *options, held)
            lm.owner = owner
            return lm
        except BaseException:
            for df in held:
                df.unpersist()
            raise

    @classmethod
    def _build(
        cls, pairs, weighted, num_partitions, strategy, max_hot, hot_min_rows, rows_per_partition, encode_ids, held
    ) -> "LinkMatrix":
        id_type = pairs.schema["src"].dataType
        source = pairs.persist(StorageLevel.MEMORY_AND_DISK)
        held.append(source)
        source.count()  # the edges are read here, once, under the caller's settings and observations
        spark = child_session(pairs.sparkSession)
        spark.conf.set(FILE_CLEANUP, "true")
        pairs = handed(source, spark)
        one, zero = F.lit(1).cast("long"), F.lit(0).cast("long")
        none = F.lit(0).cast(pairs.schema["copies"].dataType)
        tagged = pairs.select(
            F.col("src").alias("id"), F.col("copies").alias("o"), one.alias("e"), zero.alias("i")
        ).union(pairs.select(F.col("dst").alias("id"), none, zero, one))
        verts = (
            tagged.groupBy("id")
            .agg(F.sum("o").alias("out_degree"), F.sum("e").alias("entries"), F.sum("i").alias("in_entries"))
            .persist(StorageLevel.MEMORY_AND_DISK)
        )
        held.append(verts)
        id_bytes = (
            F.avg(F.octet_length(F.col("id")))
            if isinstance(id_type, T.StringType)
            else F.lit(8.0)
        )
        row = verts.agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.when(F.col("entries") == 0, 1).otherwise(0)).alias("sinks"),
            F.max(F.when(F.col("entries") > 0, F.abs(F.col("out_degree") - 1))).alias("off"),
            F.sum("out_degree").alias("edge_rows"),
            F.sum("entries").alias("entries"),
            F.max("entries").alias("max_entries"),
            F.max("in_entries").alias("max_in_entries"),
            id_bytes.alias("id_bytes"),
        ).collect()[0]
        n = int(row["n"])
        entries = int(row["entries"] or 0)
        if encode_ids is None:
            encode_ids = isinstance(id_type, T.StringType) and entries >= ENCODED_FROM
        if weighted and float(row["off"] or 0.0) > WEIGHT_TOLERANCE:
            raise ValueError(f"the weights of a source differ from a sum of 1 by {row['off']!r}")
        if num_partitions:
            parts = int(num_partitions) * max(1, math.ceil(entries / (int(num_partitions) * rows_per_partition)))
        else:
            parts = _partitions(entries, rows_per_partition, spark.sparkContext.defaultParallelism)
        if max_hot is None:
            max_hot = max(1024, 2 * parts)
        threshold = hot_threshold(entries, max_hot, hot_min_rows)
        slices = 1
        if strategy == "broadcast":
            row_bytes = (8.0 if encode_ids else float(row["id_bytes"] or 8.0)) + _ROW_OVERHEAD
            slices = _slices(n, row_bytes, broadcast_budget(spark))

        dictionary = laid = None
        cached_extra = []
        if encode_ids and n and (hashed := _hashed(pairs, verts, parts)):
            verts.unpersist()
            pairs, verts, dictionary, laid = hashed
            held.append(laid)
        elif encode_ids and n:
            pairs, verts, dictionary, fixed = _encode(pairs, verts, threshold)
            source.unpersist()
            source = pairs
            held += [pairs, verts, dictionary]
            cached_extra = [dictionary, fixed]

        # at most max_hot vertices can reach the threshold, so this table may be broadcast
        hubs, n_hubs = None, 0
        if (row["max_entries"] or 0) >= threshold:
            # a few rows that every step reads: one task, not one per partition
            hubs = verts.filter(F.col("entries") >= threshold).select("id", "out_degree").coalesce(1).checkpoint(eager=True)
            n_hubs = hubs.count()
        by_source = pairs if hubs is None else pairs.join(
            F.broadcast(hubs.select(F.col("id").alias("src"))), "src", "left_anti"
        )
        sliced = [F.expr(_slice_sql("src", slices)).alias("slice")] if slices > 1 else []
        # a partition lies by slice, then source, so that a scan for a slice passes over the other batches
        by_src = Window.partitionBy(*["slice"] * len(sliced), "src")
        cold = (
            by_source.repartition(parts, "src")
            .select("src", "dst", "copies", *sliced)
            .select(
                "src",
                "dst",
                (F.col("copies") / F.sum("copies").over(by_src)).cast("double").alias("w"),
                *["slice"] * len(sliced),
            )
        )
        hot = None
        if hubs is not None:
            hub_degree = hubs.select(F.col("id").alias("src"), "out_degree")
            hot = (
                pairs.join(F.broadcast(hub_degree), "src")
                # fresh column ids: cold and hot derive from the same pair table, and a
                # step reading both would otherwise miss the cache of one of them
                .select(
                    F.col("src").alias("src"),
                    F.col("dst").alias("dst"),
                    (F.col("copies") / F.col("out_degree")).cast("double").alias("w"),
                    *sliced,
                )
                .coalesce(parts)  # no crumbs where the caller's shuffles have more partitions
            )
        # The matrix is written once to the checkpoint folder and cached from
        # there: steps plan against a flat relation (not the build lineage), and
        # a lost executor re-reads its blocks instead of rebuilding them from
        # the edge source.  The checkpoint keeps the hash partitioning by src.
        # Planned without AQE so the written matrix reports HashPartitioning(src, parts);
        # the pair table is cached already, so the edge source is not re-run here.
        with scoped_conf(spark, {"spark.sql.adaptive.enabled": "false"}):
            cold = _written(cold)
            hot = _written(hot) if hot is not None else None
            # as many partitions as the matrix, whatever the caller's number for shuffles: the start
            # vector comes from here, and a vector laid out otherwise would shuffle the matrix in every step
            if laid is None:
                laid = _written(verts.repartition(parts, "id").sortWithinPartitions("id"))
                verts.unpersist()
                verts = laid
        source.unpersist()
        cached = [laid, cold] + ([hot, hubs] if hot is not None else []) + cached_extra
        return cls(
            vertices=verts,
            cold=cold,
            hot=hot,
            hubs=hubs.select("id") if hubs is not None else None,
            n_hubs=n_hubs,
            n=n,
            n_sinks=int(row["sinks"] or 0),
            edge_rows=None if weighted else int(row["edge_rows"] or 0),
            entries=entries,
            num_partitions=parts,
            strategy=strategy,
            id_type=id_type,
            session=_fitted(spark, parts),
            dictionary=dictionary,
            slices=slices,
            _cached=cached,
        )

    def save(self, path: str) -> None:
        """Write the layout below ``path``, which ``load`` reads; a layout there is replaced.

        The manifest goes first and comes last, so a folder with one is whole.
        """
        spark, parts = self.session, self.num_partitions
        files.remove(spark, f"{path}/{MANIFEST}")
        entries = ("src", "dst", "w")
        kept = {"cold": self.cold.select(*entries), "vertices": self.vertices.select("id", "out_degree", "entries")}
        for name, key in BUCKETED.items():
            # entries lie by source already; vertices take one exchange
            df = kept[name] if name == "cold" else kept[name].repartition(parts, key)
            table = _name(name)
            files.remove(spark, f"{path}/{name}")
            writer = df.write.format("parquet").bucketBy(parts, key).sortBy(key)
            writer.option("path", f"{path}/{name}").saveAsTable(table)
            spark.sql(f"drop table {table}")
        plain = {"hot": self.hot and self.hot.select(*entries), "hubs": self.hubs, "dictionary": self.dictionary}
        for name, df in plain.items():
            if df is not None:
                df.write.mode("overwrite").parquet(f"{path}/{name}")
        facts = {k: getattr(self, k) for k in ("n", "n_sinks", "n_hubs", "edge_rows", "entries", "num_partitions", "strategy", "slices")}
        facts["id_type"] = self.id_type.simpleString()
        facts["columns"] = {k: [[f.name, f.dataType.simpleString()] for f in kept[k].schema.fields] for k in BUCKETED}
        facts["tables"] = [k for k, df in plain.items() if df is not None]
        files.write_text(spark, f"{path}/{MANIFEST}", json.dumps(facts))

    @classmethod
    def load(cls, spark: SparkSession, path: str, strategy: str | None = None) -> "LinkMatrix":
        """A layout that ``save`` wrote.  Nothing is shuffled or computed: buckets are the loop's partitions."""
        if not files.exists(spark, f"{path}/{MANIFEST}"):
            raise ValueError(f"{path} holds no whole matrix: {MANIFEST} is missing")
        checkpoint_dir(spark)
        facts = json.loads(files.read_text(spark, f"{path}/{MANIFEST}"))
        work = _fitted(child_session(spark), facts["num_partitions"])
        strategy, tables, bucketed = strategy or facts["strategy"], [], {}
        slices = facts.get("slices", 1) if strategy == "broadcast" else 1

        def cut(df: DataFrame, name: str) -> DataFrame:
            return df.withColumn("slice", F.expr(_slice_sql("src", slices))) if slices > 1 and name in ("cold", "hot") else df

        for name, key in BUCKETED.items():
            tables.append(_name(name))
            columns = ", ".join(f"`{c}` {t}" for c, t in facts["columns"][name])
            place = f"{path}/{name}".replace("\\", "\\\\").replace("'", "\\'")
            work.sql(
                f"create table {tables[-1]} ({columns}) using parquet clustered by (`{key}`) sorted by (`{key}`) "
                f"into {facts['num_partitions']} buckets location '{place}'"
            )
            bucketed[name] = cut(work.table(tables[-1]), name).persist(StorageLevel.MEMORY_AND_DISK)
        plain = {k: cut(work.read.parquet(f"{path}/{k}"), k).persist(StorageLevel.MEMORY_AND_DISK) for k in facts["tables"]}
        id_type = T._parse_datatype_string(facts["id_type"])
        scalars = ("n", "n_sinks", "n_hubs", "edge_rows", "entries", "num_partitions")
        return cls(
            vertices=bucketed["vertices"],
            cold=bucketed["cold"],
            hot=plain.get("hot"),
            hubs=plain.get("hubs"),
            strategy=strategy,
            slices=slices,
            id_type=id_type,
            session=work,
            owner=spark,
            dictionary=plain.get("dictionary"),
            _tables=tables,
            _cached=[*bucketed.values(), *plain.values()],
            **{k: facts[k] for k in scalars},
        )

    def multiply(self, vec: DataFrame, value: str = "rank") -> DataFrame:
        """``M v`` as ``(id, y)``, one row per id of ``vec``, in the session of ``vec``."""
        if self.dictionary is not None:
            raise ValueError("a matrix with encoded ids multiplies no vector of the original ids")
        given = handed(vec.select("id", F.col(value).alias("rank")), self.session)
        base = given.select("id", F.lit(0.0).alias("c"))
        sums = self.contributions(given).unionByName(base).groupBy("id").agg(F.sum("c").alias("y"))
        return handed(sums, vec.sparkSession)

    def matrix(self) -> DataFrame:
        """All entries ``(src, dst, w)``."""
        entries = ("src", "dst", "w")
        cold = self.cold.select(*entries)
        return cold if self.hot is None else cold.unionByName(self.hot.select(*entries))

    def register(self) -> dict[str, str]:
        """Temp views of the cached parts for the per-step SQL; names are unique per matrix."""
        if not self._views:
            tag = uuid.uuid4().hex[:12]
            self._views = {"cold": f"_surfrank_cold_{tag}", "prev": f"_surfrank_prev_{tag}"}
            self.cold.createOrReplaceTempView(self._views["cold"])
            if self.hot is not None:
                self._views["hot"] = f"_surfrank_hot_{tag}"
                self._views["hubs"] = f"_surfrank_hubs_{tag}"
                self.hot.createOrReplaceTempView(self._views["hot"])
                self.hubs.createOrReplaceTempView(self._views["hubs"])
        return self._views

    def contribution_sql(self, prev: str) -> str:
        """SQL of ``(id, c)``: one product ``w * prev.rank`` per matrix entry, keyed by target.

        ``prev`` names a view ``(id, rank, ...)``.  Partitioned: ordinary
        sources join the previous vector inside each partition (both sides
        hash-partitioned alike and sorted, a merge that needs no memory for
        either), hubs join a broadcast copy of their own (bounded) vector
        entries, the semi join of ``prev`` with the hub table.
        Broadcast: every entry meets a broadcast copy of the whole vector, or of the
        slice of it that holds the entry's source.
        """
        v = self.register()
        # renamed, so that the step's second use of the vector is no self join: the analyzer
        # would give that use new columns, whose partitioning it does not always carry over
        vec = f"(select id as source, rank as x from {prev})"
        if self.strategy == "broadcast":
            parts = []
            for matrix in [v["cold"]] + ([v["hot"]] if self.hot is not None else []):
                for k in range(self.slices):
                    part = f"(select * from {vec} where {_slice_sql('source', self.slices)} = {k})" if self.slices > 1 else vec
                    mine = f" where m.slice = {k}" if self.slices > 1 else ""
                    parts.append(
                        f"select /*+ BROADCAST(p) */ m.dst as id, m.w * p.x as c "
                        f"from {matrix} m join {part} p on m.src = p.source{mine}"
                    )
            return " union all ".join(parts)
        parts = [
            f"select /*+ MERGE(p) */ m.dst as id, m.w * p.x as c "
            f"from {v['cold']} m join {vec} p on m.src = p.source"
        ]
        if self.hot is not None:
            hubs = f"(select /*+ BROADCAST(u) */ p.id, p.rank from {prev} p left semi join {v['hubs']} u on p.id = u.id)"
            parts.append(
                f"select /*+ BROADCAST(h) */ m.dst as id, m.w * h.rank as c from {v['hot']} m join "
                f"{hubs} h on m.src = h.id"
            )
        return " union all ".join(parts)

    def contributions(self, vec: DataFrame, value: str = "rank") -> DataFrame:
        """DataFrame form of ``contribution_sql`` for a vector ``(id, <value>)``."""
        v = self.register()
        vec.select("id", F.col(value).alias("rank")).createOrReplaceTempView(v["prev"])
        return self.cold.sparkSession.sql(self.contribution_sql(v["prev"]))

    def unpersist(self) -> None:
        """Let go of caches, checkpoints and catalog entries; files that ``save`` wrote stay."""
        spark = self.session
        for name in self._views.values():
            spark.catalog.dropTempView(name)
        self._views = {}
        for df in self._cached:
            df.unpersist()
            drop_checkpoint(df)
        self._cached = []
        for table in self._tables:
            spark.sql(f"drop table if exists {table}")
        self._tables = []
