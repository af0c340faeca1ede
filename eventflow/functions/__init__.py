from eventflow.functions.time import (
    epoch_us, from_epoch_us, to_instant, to_ntz, flatten_window, interval_us,
)
from eventflow.functions.expressions import (
    fizzbuzz, entity_id, warn_message, share_percent,
)

__all__ = [
    "epoch_us", "from_epoch_us", "to_instant", "to_ntz", "flatten_window",
    "interval_us", "fizzbuzz", "entity_id", "warn_message", "share_percent",
]
