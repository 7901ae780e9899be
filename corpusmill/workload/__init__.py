"""Named queries over the test tables, each with SQL that must give the same rows."""

from corpusmill.workload import documents, points, records, tables  # noqa: F401
from corpusmill.workload.base import REGISTRY

__all__ = ["REGISTRY"]
