"""riverbend: event-stream operators on Spark DataFrames.

Every operator is a function ``DataFrame(s) -> DataFrame(s)`` that works the
same on a batch table (``spark.read``) and, where Spark allows it, on a
streaming one (``spark.readStream``).  Sources and sinks are attached by the
caller; nothing here reads from or writes to a fixed location.
"""

from riverbend.session import build_session, scratch_dir

__all__ = ["build_session", "scratch_dir"]
