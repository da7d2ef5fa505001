from almanac.plans.answers import (
    ingest,
    month_means,
    rank_by_max,
    rank_first_seen,
    run_job,
    trend,
    write_answers,
)
from almanac.plans.changed import ingest_changed, known_files, list_files

__all__ = ["ingest", "ingest_changed", "known_files", "list_files", "month_means", "rank_by_max", "rank_first_seen", "run_job", "trend", "write_answers"]
