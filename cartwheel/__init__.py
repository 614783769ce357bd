"""cartwheel: batch order loading, checking and summarising on Spark.

Sources return lazy DataFrames, operators are DataFrame -> DataFrame
functions built from Spark's own expressions, sinks write and report what
they wrote, and the jobs in ``cartwheel.plans`` chain them with quality
gates.
"""

from . import functions, operators, plans, schema, sinks, sources
from .session import build_session, scratch_path, scratch_root

__all__ = [
    "build_session",
    "functions",
    "operators",
    "plans",
    "schema",
    "scratch_path",
    "scratch_root",
    "sinks",
    "sources",
]
