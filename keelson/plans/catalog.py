"""The registry: query name -> callable(spark, sf_dir) and name -> oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from keelson.plans import batch, streams
from keelson.plans.oracle import ORACLE

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "row_count": batch.row_count,
    "head_ordered": batch.head_ordered,
    "avg_by_group": batch.avg_by_group,
    "nested_avg": batch.nested_avg,
    "top_n_rows": batch.top_n_rows,
    "top_one": batch.top_one,
    "top_sum": batch.top_sum,
    "revenue_by": batch.revenue_by,
    "top_revenue": batch.top_revenue,
    "pair_count_join": batch.pair_count_join,
    "pair_count": batch.pair_count,
    "match_count_like": batch.match_count_like,
    "match_count_ci": batch.match_count_ci,
    "json_avg": batch.json_avg,
    "trailing_avg": batch.trailing_avg,
    "profile_outlier": batch.profile_outlier,
    "velocity_score": batch.velocity_score,
    "window_counts": batch.window_counts,
    "cdc_decode": batch.cdc_decode,
    "profile_sigma": batch.profile_sigma,
    "trailing_avg_key": batch.trailing_avg_key,
    "cube_level": batch.cube_level,
    "token_search_all": batch.token_search_all,
    "join_count": batch.join_count,
    "velocity_alerts_day": batch.velocity_alerts_day,
    "cube_counts": batch.cube_counts,
    "token_search": batch.token_search,
    "csv_roundtrip": batch.csv_roundtrip,
    "skew_report": batch.skew_report,
    "window_counts_stream": streams.window_counts_stream,
    "running_counts_stream": streams.running_counts_stream,
    "profile_stream": streams.profile_stream,
    "velocity_stream": streams.velocity_stream,
    "velocity_stream_tails": streams.velocity_stream_tails,
    "summary_merge": streams.summary_merge,
    "ingest_table": streams.ingest_table,
    "cdc_velocity_alerts": streams.cdc_velocity_alerts,
    "cdc_profile_alerts": streams.cdc_profile_alerts,
    "profile_chunked": batch.profile_chunked,
    "velocity_chunked": batch.velocity_chunked,
    "velocity_burst": batch.velocity_burst,
    "sql_view_revenue": batch.sql_view_revenue,
    "save_table_roundtrip": batch.save_table_roundtrip,
    "profile_stream_batches": streams.profile_stream_batches,
    "velocity_stream_batches": streams.velocity_stream_batches,
    "cdc_agents_both": streams.cdc_agents_both,
    "cdc_undecodable": streams.cdc_undecodable,
    "crash_windows_append": streams.crash_windows_append,
    "restart_stream": streams.restart_stream,
    "progress_rows": streams.progress_rows,
    "summary_compacted": streams.summary_compacted,
    "token_search_stream": streams.token_search_stream,
    "late_repair": streams.late_repair,
    "velocity_state_list": streams.velocity_state_list,
    "profile_state_list": streams.profile_state_list,
    "trailing_avg_panes": streams.trailing_avg_panes,
    "progress_log": streams.progress_log,
    "skew_top_keys": batch.skew_top_keys,
    "cube_route": batch.cube_route,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return {k: v for k, v in ORACLE.items() if k in QUERIES}
