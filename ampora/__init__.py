"""ampora: regional energy and weather analytics as Spark DataFrame operators.

Every public operator takes and returns a ``pyspark.sql.DataFrame`` and is
built from built-in Spark SQL expressions, so the whole flow (document scan,
flatten, monthly rollup, append + dedup, staging, mart join, analysis) runs
distributed from scan to write.
"""

__version__ = "0.1.0"

from ampora.operators.aggregate import daily_to_monthly
from ampora.operators.analysis import (curated_extract, energy_weather_corr, filter_options,
                                       metric_labels, monthly_detail, period_bounds,
                                       present_correlation, present_detail, present_summary,
                                       scatter_pairs, series_long, share_kpi, slice_filter,
                                       slice_kpis, summary_stats, with_relationship,
                                       with_weather_value)
from ampora.operators.coverage import (coverage_gaps, coverage_grid, extract_completeness,
                                       range_violations, select_regions, unknown_regions)
from ampora.operators.dedup import dedup_latest
from ampora.operators.flatten import (balance_envelope, balance_violations, flatten_balance,
                                      flatten_weather, measure_violations, weather_violations)
from ampora.operators.merge import merge_balance_years, merge_weather_years
from ampora.operators.models import curate, mart_energy_weather, stage_balance, stage_weather
from ampora.operators.quality import not_null_report, observed, observed_report
from ampora.session import build_session, scale_conf
from ampora.sinks.tables import drop_old_versions
from ampora.sinks.writers import (append_load, append_load_table, create_staging_view,
                                  dedup_rewrite, dedup_table, save_mart, upsert_latest,
                                  write_landing, write_mart, write_named_documents,
                                  write_processed, write_routes)
from ampora.sources.catalog import load_regions, region_catalog
from ampora.sources.config import label_rows, relationship_rows
from ampora.sources.documents import (latest_document, parse_documents, payload_errors,
                                      read_daily_csv, routed_documents, scan_documents,
                                      scan_named_documents, split_documents,
                                      split_error_payloads)

__all__ = [n for n in dir() if not n.startswith("_")]
