"""Named queries over the driver tables and their SQL oracles."""

from eventflow.plans.registry import QUERIES, ORACLE, query

# importing the modules registers their queries
from eventflow.plans import batch as _batch  # noqa: F401,E402
from eventflow.plans import stream as _stream  # noqa: F401,E402
from eventflow.plans import io as _io  # noqa: F401,E402

__all__ = ["QUERIES", "ORACLE", "query"]
