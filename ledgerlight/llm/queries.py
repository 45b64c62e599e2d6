"""The queries of this package, and SQL where it can express one."""

from __future__ import annotations

from .chat import OP4_SQL, op4_prefix_targets
from .decontaminate import op7_positional_index
from .line_dedup import OP12_SQL, op12_line_bitmaps
from .packing import op6_configuration_packing
from .periodic_runs import op13_periodic_runs
from .rules import op9_decision_list
from .shards import op5_histogram_shards
from .simhash import op10_pigeonhole_simhash
from .substrings import OP2_SQL, op2_relative_lz
from .token_counts import op8_overlap_counts
from .token_file import op1_packed_tokens
from .toxicity import op3_kneser_ney
from .whitening import op11_cholesky_jacobi

QUERIES = {
    "op1_packed_tokens": op1_packed_tokens,
    "op2_relative_lz": op2_relative_lz,
    "op3_kneser_ney": op3_kneser_ney,
    "op4_prefix_targets": op4_prefix_targets,
    "op5_histogram_shards": op5_histogram_shards,
    "op6_configuration_packing": op6_configuration_packing,
    "op7_positional_index": op7_positional_index,
    "op8_overlap_counts": op8_overlap_counts,
    "op9_decision_list": op9_decision_list,
    "op10_pigeonhole_simhash": op10_pigeonhole_simhash,
    "op11_cholesky_jacobi": op11_cholesky_jacobi,
    "op12_line_bitmaps": op12_line_bitmaps,
    "op13_periodic_runs": op13_periodic_runs,
}
ORACLES = {"op2_relative_lz": OP2_SQL, "op4_prefix_targets": OP4_SQL, "op12_line_bitmaps": OP12_SQL}
