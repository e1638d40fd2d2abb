from ratecast.sources.tables import read_table  # noqa: F401
from ratecast.sources.fixtures import (  # noqa: F401
    oracle_requests,
    ticks_from_events,
)
