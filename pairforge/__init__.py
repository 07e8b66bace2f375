"""Preference- and instruction-data curation as Spark jobs.

Sub-packages: ``functions`` (column expressions), ``sources`` (readers and
writers), ``operators`` (table-to-table steps), ``plans`` (end-to-end jobs),
``streaming`` (incremental jobs).
"""

from pairforge.session import build_session, scratch_path, tune

__all__ = ["build_session", "scratch_path", "tune"]
