"""Monthly trip records as a star schema on Spark."""

from tripmart.plans import REPORTS, LoadQuality, PipelineResult, all_reports, load, open_star, run

__all__ = ["REPORTS", "LoadQuality", "PipelineResult", "all_reports", "load", "open_star", "run"]
