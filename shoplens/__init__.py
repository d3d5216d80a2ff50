"""shoplens: user-behaviour and ad-click analytics as PySpark DataFrame jobs.

Layout
------
sources/    table scans, adapter views over the test tables, stream sources
functions/  column-expression helpers (id lists, tokens, time labels, JSON)
operators/  reusable DataFrame -> DataFrame building blocks
plans/      the batch jobs (category top-10, page jumps, area top-3, ad jobs)
streaming/  Structured Streaming drivers (ban filter, running counts, windows)
sinks/      catalog, JDBC, keyed-snapshot and topic writers
"""

from shoplens.session import get_session, checkpoint_root  # noqa: F401
