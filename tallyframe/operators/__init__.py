"""Table operators: each takes and returns a DataFrame."""

from tallyframe.operators.aggregate import (
    avg_by,
    avg_rate_by,
    band_share,
    correlation,
    distinct_count,
    frequency,
    mean_vs_percentiles,
    rate_vs_overall,
    row_count,
    share_of_total,
    top_n,
)
from tallyframe.operators.distinct import Extent, distinct_by_column, distinct_counts
from tallyframe.operators.heavy import heavy_hitters, top_n_heavy
from tallyframe.operators.profile import (
    column_profile,
    describe_shape,
    null_profile,
    period_profile,
    sample_rows,
)
from tallyframe.operators.quality import (
    all_of,
    any_negative_by,
    any_of,
    apply_rules,
    content_checksums,
    out_of_domain,
    reconcile,
    reconcile_contents,
    reconcile_load,
    violations_by,
)
from tallyframe.operators.rank import mix_within_top, rank_counted, top_k_per_group
from tallyframe.operators.recode import mode_of, recode_to_mode, recoded_frequency
from tallyframe.operators.selection import select_ranks
from tallyframe.operators.sketches import distinct_from_sketches, stated_error, write_distinct_sketches

__all__ = [
    "Extent",
    "all_of",
    "any_negative_by",
    "any_of",
    "apply_rules",
    "avg_by",
    "avg_rate_by",
    "band_share",
    "column_profile",
    "content_checksums",
    "correlation",
    "describe_shape",
    "distinct_by_column",
    "distinct_count",
    "distinct_counts",
    "distinct_from_sketches",
    "frequency",
    "heavy_hitters",
    "mean_vs_percentiles",
    "mix_within_top",
    "mode_of",
    "null_profile",
    "out_of_domain",
    "rank_counted",
    "period_profile",
    "rate_vs_overall",
    "reconcile",
    "reconcile_contents",
    "reconcile_load",
    "recode_to_mode",
    "recoded_frequency",
    "select_ranks",
    "stated_error",
    "top_n_heavy",
    "write_distinct_sketches",
    "row_count",
    "sample_rows",
    "share_of_total",
    "top_k_per_group",
    "top_n",
    "violations_by",
]
