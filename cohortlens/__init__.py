"""cohortlens: customer segmentation and retention analytics on Spark.

Every analysis is a DataFrame transformation: per-customer metrics, RFM
scores and named segments, segment / at-risk summaries, monthly cohort
retention, acquisition-quarter lifetime value, month-3 churn and flat BI
extracts.  Global rankings (NTILE, exact quantiles, medians) run
distributed, never on a single task.
"""

from cohortlens.session import build_session, checkpoint_dir, stable

__all__ = ["build_session", "checkpoint_dir", "stable"]
