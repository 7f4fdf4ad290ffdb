from perigee.operators.cursor import late_rows, latest_date, latest_rows, newer_than
from perigee.operators.features import assemble, split_keyed, split_random
from perigee.operators.flatten import (
    clean_rows,
    encode_label,
    flatten,
    reject_counts,
    rejects,
    with_day,
    with_month,
    with_reason,
)
from perigee.operators.model import (
    LinearModel,
    accumulate,
    accuracy,
    as_linear,
    fit,
    plain_vectors,
    refit,
    score,
    score_linear,
    score_table,
)
from perigee.operators.newton import Newton
from perigee.operators.report import (
    bounded_grid,
    confusion_counts,
    display_rows,
    export_new,
    export_scored,
    report_rows,
    scatter_grid,
    scatter_points,
)

__all__ = [
    "LinearModel",
    "Newton",
    "accumulate",
    "accuracy",
    "as_linear",
    "assemble",
    "bounded_grid",
    "clean_rows",
    "confusion_counts",
    "display_rows",
    "encode_label",
    "export_new",
    "export_scored",
    "fit",
    "flatten",
    "late_rows",
    "latest_date",
    "latest_rows",
    "newer_than",
    "plain_vectors",
    "refit",
    "reject_counts",
    "rejects",
    "report_rows",
    "scatter_grid",
    "scatter_points",
    "score",
    "score_linear",
    "score_table",
    "split_keyed",
    "split_random",
    "with_day",
    "with_month",
    "with_reason",
]
