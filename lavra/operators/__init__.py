"""DataFrame → DataFrame operators."""

from .dedup import distinct_rows, keep_first
from .grid import apply_header, header_hits, header_rows, pick_sheet, sheet_headers
from .joins import null_safe_join
from .ledger import (batch_ids, commit_keys, contiguous_watermark, latest_variant,
                     outcome_status, override_merge, pending, pending_with_refresh,
                     read_ledger, reset_ledger, number_rows, select_sources, stale_commits)
from .project import (coalesce_variants, col_or_null, eq_in_filter, flatten_json, keyword_filter, positional_rename,
                      project_or_null, union_by_name, with_lineage)
from .reports import coverage, diagnosis, grouped_report, preview, window_diagnostics
from .widen import read_drifting, union_widened, widening_report
from .windows import monthly_periods, monthly_windows, weekly_windows, window_key, window_plan

__all__ = [n for n in dir() if not n.startswith("_")]
