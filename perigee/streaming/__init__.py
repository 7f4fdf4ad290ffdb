from perigee.streaming.fan_out_stream import MESSAGE, REJECT, once, read_fanned, start_fan_out
from perigee.streaming.flat_stream import AVAILABLE_NOW, LIVE, run_flat_stream, write_flat_stream
from perigee.streaming.step_stream import start_step_stream

__all__ = [
    "AVAILABLE_NOW",
    "LIVE",
    "MESSAGE",
    "REJECT",
    "once",
    "read_fanned",
    "run_flat_stream",
    "start_fan_out",
    "start_step_stream",
    "write_flat_stream",
]
