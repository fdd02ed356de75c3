from . import catalog, jobs, reports
from .jobs import Lake, run_nightly

__all__ = ["catalog", "jobs", "reports", "Lake", "run_nightly"]
