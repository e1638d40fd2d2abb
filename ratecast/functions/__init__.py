from ratecast.functions.columns import (  # noqa: F401
    date_str,
    epoch_ntz,
    epoch_offset,
    epoch_seconds,
    from_epoch_seconds,
    ieee_divide,
    interpolate_or_fill,
    json_array,
    json_scalar,
    linear_interpolate,
    nan_to_null,
    variant_scalar,
    tumble_interval,
    tumble_seconds,
)
