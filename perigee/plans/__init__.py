from perigee.plans.publishing import fan_out_step
from perigee.plans.state import (
    StatePaths,
    latest_batch,
    merge,
    read_cursor,
    read_ledger,
    read_model,
    read_rows,
    read_scored,
    read_train,
    shared_root,
    shuffles_dropped,
)
from perigee.plans.step import process_batch, run_available, run_every
from perigee.plans.summary import run_summary

__all__ = [
    "StatePaths",
    "fan_out_step",
    "latest_batch",
    "merge",
    "process_batch",
    "read_cursor",
    "read_ledger",
    "read_model",
    "read_rows",
    "read_scored",
    "read_train",
    "run_available",
    "run_every",
    "run_summary",
    "shared_root",
    "shuffles_dropped",
]
