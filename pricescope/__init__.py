"""pricescope: prediction-market analytics expressed as Spark DataFrame plans.

Layout
------
sources/     table loaders, landed-feed readers, test-fixture derivations
functions/   column-expression helpers (no Python UDFs)
operators/   the analytic operators: lookback, move statistics, ranked
             queries, snapshots, ingest/upsert, alerts, cookbook, overview
plans/       the query registry used by ``__spark_entry__`` and its SQL oracles
streaming/   Structured Streaming drivers (foreachBatch ingest + snapshot + alerts)
"""

from pricescope.session import build_session, checkpoint_root  # noqa: F401
from pricescope.venues import PROB, TICK, Venue  # noqa: F401

__all__ = ["build_session", "checkpoint_root", "Venue", "TICK", "PROB"]
