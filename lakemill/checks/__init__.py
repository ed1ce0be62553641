"""Registered jobs over the test tables, each with its comparison query."""

from lakemill.checks import domains, events, files, hospital, profiling, trips  # noqa: F401
from lakemill.checks.registry import JOBS, ORACLES, runner  # noqa: F401
