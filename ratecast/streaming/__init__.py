from ratecast.streaming.gap_fill import stream_gap_fill, stream_to_filled_table, with_open_ends  # noqa: F401
from ratecast.streaming.streams import (  # noqa: F401
    event_time,
    run_to_table,
    stream_hourly_mean,
    stream_to_hourly_table,
)
