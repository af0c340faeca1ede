from eventflow.sources.literal import from_rows, number_sequence
from eventflow.sources.views import cart_events, catalog_events, server_events, rules_from_events
from eventflow.sources.tables import read_table

__all__ = [
    "from_rows", "number_sequence", "cart_events", "catalog_events",
    "server_events", "rules_from_events", "read_table",
]
