"""Relational operators that Spark lacks or that need care at scale."""

from larkspan.operators.antijoin import not_in
from larkspan.operators.asof import asof_join
from larkspan.operators.closure import transitive_closure
from larkspan.operators.frequent import count_min, frequent_items, merge_count_min
from larkspan.operators.merge import merge_partitions
from larkspan.operators.overlap import overlap_join
from larkspan.operators.quantiles import exact_quantiles
from larkspan.operators.ranges import interval_join, point_in_range_join
from larkspan.operators.reshape import melt, qualify, spread
from larkspan.operators.scan import whole_rank, whole_scan
from larkspan.operators.skew import salted_join
from larkspan.operators.windows import exclude, exclude_current_row, exclude_peers, gap_fill, groups_frame, sessionize

__all__ = [
    "asof_join", "count_min", "exact_quantiles", "exclude", "exclude_current_row", "exclude_peers", "frequent_items", "gap_fill", "groups_frame", "interval_join", "melt", "merge_count_min",
    "merge_partitions", "not_in", "overlap_join", "point_in_range_join", "qualify", "salted_join", "sessionize", "spread", "transitive_closure", "whole_rank", "whole_scan",
]
