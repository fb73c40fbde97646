"""Jobs over the driver tables, each with the SQL that checks it."""

from . import feature_jobs, ingest_jobs, interval_jobs, sequence_jobs, store_jobs, summary_jobs  # noqa: F401
from .registry import CHECKS, JOBS  # noqa: F401
