"""Event-table analytics on PySpark.

Column-parameterised DataFrame operators for profiling, cleaning and
describing large event tables (trips, tickets), plus the two analyses
built from them (``tallyframe.plans``). Every operator takes and returns
a DataFrame and leaves planning to Catalyst.
"""

from tallyframe.session import build_session, shared_dir

__all__ = ["build_session", "shared_dir"]
