"""metricfold: metric-update analytics on Spark.

Typed gauge/counter updates are read as DataFrames or streams, admitted by
explicit rules, folded into keyed state (gauge = last write wins, counter =
running sum), upserted batch by batch, looked up, listed, snapshotted and
audited. Host samples are merged, reshaped to long form and counted per poll
window. Every operator is a ``DataFrame -> DataFrame`` function built from
Spark built-ins; see README.md for the operator map.
"""

from metricfold.session import build_session, checkpoint_root

__all__ = ["build_session", "checkpoint_root"]
