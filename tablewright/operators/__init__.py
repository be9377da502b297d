"""Table operators: profile, clean, align, encode, order, split, model,
evaluate, distribution."""

from tablewright.operators.align import conform_to, same_width, split_tagged, tag_union
from tablewright.operators.clean import (
    blank_to_null, bound_counts, cast_columns, drop, drop_sparse_columns, fill_constant,
    iqr_bounds, project, rename, rows_missing, sentinels_to_null, trim_outliers_bound,
    trim_outliers_iqr, trim_outliers_ratio, where, where_in,
)
from tablewright.operators.distribution import box_summary, density, histogram, sample_n
from tablewright.operators.encode import (
    label_extend, label_fit, label_inverse, label_transform, levels, one_hot, one_hot_names,
    one_hot_vector,
)
from tablewright.operators.evaluate import (
    compare_joined, compare_predictions, diff_tables, differing_rows, extremes_by, rmse,
    with_error,
)
from tablewright.operators.ordered import interpolate_linear, quantiles, sorted_rank, with_row_id
from tablewright.operators.profile import (
    ambiguous_keys, column_info, column_kinds, compare_means, count_where, describe,
    distinct_size, head, keep_by_frequency, null_ratio, null_report, rare_values,
    shape, value_counts,
)
from tablewright.operators.split import holdout_mask, holdout_split, period_split

__all__ = [n for n in dir() if not n.startswith("_")]
