"""tidemark: incremental ingest, contract validation and mart building on Spark.

Every operator is a ``DataFrame -> DataFrame`` function over the Spark
DataFrame API; only :mod:`tidemark.plans.stages` writes tables.
"""

from tidemark.session import build_session, ensure_checkpoint_dir

__all__ = ["build_session", "ensure_checkpoint_dir"]
