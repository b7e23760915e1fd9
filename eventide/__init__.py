"""eventide: streaming event metrics on Spark.

Every operator is a plain ``DataFrame -> DataFrame`` function built from
native column expressions, so the same code runs on a bounded table and on a
streaming DataFrame. Sources build the record envelope, sinks commit results
and offsets, ``plans`` composes whole jobs.
"""

from eventide.session import build_session, checkpoint_root

__all__ = ["build_session", "checkpoint_root"]
