from tripmart.plans.pipeline import LoadQuality, PipelineResult, load, open_star, run
from tripmart.plans.reports import REPORTS, all_reports

__all__ = ["REPORTS", "LoadQuality", "PipelineResult", "all_reports", "load", "open_star", "run"]
