"""scorewright — nightly customer churn scoring and its analytics, written as Spark jobs.

Layout:
    sources/    scans, the adapter from the driver's tables, sinks
    functions/  column expressions shared by every operator
    operators/  ETL, features, model, scoring, quality gates, store, monitor
    plans/      end-to-end jobs and the derived run history
    llm/        training-data operators; nothing else here imports them
"""

from scorewright.config import JobConfig

__all__ = ["JobConfig"]
