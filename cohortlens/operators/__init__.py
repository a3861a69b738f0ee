"""DataFrame operators: metrics, ranking/scoring, segments, cohorts, LTV,
churn, extracts and BI sheets."""
