"""All registered queries."""

from fieldcatch.workload import checks, jobs, many, relations, scalars  # noqa: F401
from fieldcatch.workload.registry import ORACLES, QUERIES  # noqa: F401
