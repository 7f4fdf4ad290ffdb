from perigee.sources.envelopes import (
    date_counts,
    envelope_dates,
    envelope_rejects,
    explode_envelope,
    fan_out,
    read_envelopes,
    unpublished,
)
from perigee.sources.messages import encode, message_stream, publish, read_messages
from perigee.sources.tables import delete, exists, flat_files, landed_files, latest_stored_date, read_flat, read_to_score, register_flat, rows_of_files, write_flat
from perigee.sources.windows import feed_windows, pending_windows, windows_over

__all__ = [
    "date_counts",
    "delete",
    "encode",
    "envelope_dates",
    "envelope_rejects",
    "exists",
    "explode_envelope",
    "fan_out",
    "feed_windows",
    "flat_files",
    "landed_files",
    "latest_stored_date",
    "message_stream",
    "pending_windows",
    "publish",
    "read_envelopes",
    "read_flat",
    "read_messages",
    "read_to_score",
    "register_flat",
    "rows_of_files",
    "unpublished",
    "windows_over",
    "write_flat",
]
