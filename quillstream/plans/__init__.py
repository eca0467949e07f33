"""The queries over the driver's tables, with their SQL."""

from quillstream.plans import cards, days, registry, scalars, snapshots, states, stored, weblinks  # noqa: F401
from quillstream.plans.base import ORACLE, QUERIES  # noqa: F401
