from tallyproof.functions.columns import (
    any_null,
    is_blank,
    joined_stamp,
    null_safe,
    surrogate_key,
    traffic_light,
    zero_pad,
)
from tallyproof.functions.sizing import checkpoint_folder, settle, settle_small

__all__ = [
    "any_null",
    "checkpoint_folder",
    "is_blank",
    "joined_stamp",
    "null_safe",
    "settle",
    "settle_small",
    "surrogate_key",
    "traffic_light",
    "zero_pad",
]
