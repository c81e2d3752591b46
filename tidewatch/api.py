"""Public API under the names of the build plan (one import for users).

Every function takes DataFrames (plus plain parameters) and returns DataFrames.
"""

from tidewatch.functions import (char_wb_ngrams, counter_or_zero, is_relevant, item_id, parse_counter,  # noqa: F401
                                 summary_from_parts)
from tidewatch.operators._util import window_filter as history_window  # noqa: F401
from tidewatch.operators.analysis import (day_keywords, day_texts, default_analysis, dimension_map,  # noqa: F401
                                          history_records, parse_analysis, parse_documents, with_default)
from tidewatch.operators.backfill import similarity_backfill, sliding_statistics, sliding_vocabulary  # noqa: F401
from tidewatch.operators.counters import (chart_table, counter_growth, counter_state, counter_totals,  # noqa: F401
                                          daily_series, new_entities, star_series, top_growth, top_values)
from tidewatch.operators.detectors import (TrendParams, overall_novelty, signal_order, trend_measures,  # noqa: F401
                                           trend_signals)
from tidewatch.operators.ingest import dedup_capped as ingest, ingest_stats, run_totals, with_item_id  # noqa: F401
from tidewatch.operators.keywords import keyword_lists, keyword_report, keyword_trends  # noqa: F401
from tidewatch.operators.reports import (digest_lines, evidence_rows, reference_list, render,  # noqa: F401
                                         report_bundle, run_summary, token_totals)
from tidewatch.operators.rolling import advance, state_vocabulary, update_state  # noqa: F401
from tidewatch.operators.shift import novelty_series, text_shift  # noqa: F401
from tidewatch.operators.vectors import day_members, merge_scopes, tfidf_similarity as day_similarity  # noqa: F401
from tidewatch.operators.vectors import term_counts as char_ngrams, tfidf_weights as tfidf, vocabulary  # noqa: F401
from tidewatch.operators.vectors import with_combined  # noqa: F401
from tidewatch.plans.daily_run import RunPaths, daily_run  # noqa: F401
from tidewatch.plans.reports import bundle, metrics_report, trend_report  # noqa: F401
from tidewatch.sources.harvest import (as_items, catalog_frame, harvest_api, harvest_blocks, harvest_feed,  # noqa: F401
                                       harvest_links, harvest_repo_blocks, paper_texts, papers_from_feeds, snapshot)
from tidewatch.sources.harvest import rejected_feeds, rejected_lists, rejected_pages  # noqa: F401
from tidewatch.sources.registry import append_ids, merge as merge_registry, read_ids  # noqa: F401
from tidewatch.sources.store import (append_registry, append_run_log, read_days, read_json_history,  # noqa: F401
                                     read_registry, write_days, write_latest_json)
from tidewatch.streaming.capped import accepted as stream_accepted, run_capped_stream, write_candidates  # noqa: F401
from tidewatch.streaming.streams import (ingest_batches, stream_daily_keywords as stream_daily,  # noqa: F401
                                         stream_dedup)
from tidewatch.streaming.trends import (keyword_trends_by_day, merge_masks, read_masks,  # noqa: F401
                                        run_keyword_stream)


def flatten_analysis(docs):
    """``(day_texts, day_keywords)`` of analysis documents."""
    return day_texts(docs), day_keywords(docs)
