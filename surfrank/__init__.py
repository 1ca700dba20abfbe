"""surfrank: random-surfer link ranking on Spark DataFrames.

Sources read edge lists, operators build vertices, degrees and the
transition matrix, and ``rank`` runs the convergence loop.  Every
operator maps DataFrames to DataFrames and runs on the executors.
"""

from .operators.blocks import assign_block, block_matrix, index_matrix, unblock
from .operators.graph import (
    count_vertices,
    decode_vector,
    index_edges,
    lookup,
    out_degree,
    vertex_count,
    vertex_index,
    vertex_table,
    vertices,
    with_out_degree,
)
from .operators.matrix import (
    abs_difference,
    damp,
    initial_vector,
    l1_distance,
    multiply,
    rank_step,
    redistribute,
    transition_matrix,
    vector_sum,
)
from .plans.layout import LinkMatrix
from .plans.rank import PRESETS, RankResult, rank
from .sources.edges import complete_edges, read_edges, read_matrix, read_table_edges, read_vector
from .session import release_checkpoints
from .sources.sinks import write_edges, write_ranks

__all__ = [
    "LinkMatrix",
    "PRESETS",
    "RankResult",
    "abs_difference",
    "assign_block",
    "block_matrix",
    "complete_edges",
    "count_vertices",
    "damp",
    "decode_vector",
    "index_edges",
    "index_matrix",
    "initial_vector",
    "l1_distance",
    "lookup",
    "multiply",
    "out_degree",
    "rank",
    "rank_step",
    "read_edges",
    "read_matrix",
    "read_table_edges",
    "read_vector",
    "redistribute",
    "release_checkpoints",
    "transition_matrix",
    "unblock",
    "vector_sum",
    "vertex_count",
    "vertex_index",
    "vertex_table",
    "vertices",
    "with_out_degree",
    "write_edges",
    "write_ranks",
]
