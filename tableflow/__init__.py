"""Move tables between stores with Spark, and prove the result."""

from .operators.checks import (
    assign_ids,
    check_not_null,
    check_primary_key,
    check_unique,
    orphan_rows,
    orphan_summary,
)
from .operators.compare import compare_counts, compare_keys, exists_in, failures, row_counts, store_counts
from .operators.conform import align, conform, flag, rejects
from .operators.content import compare_content
from .operators.identity import assign_ids_again, known_ids
from .operators.loadorder import load_order, strong_components
from .operators.mapping import (
    ColumnRule,
    clean_defaults,
    column_rules,
    fit_row_width,
    fit_row_width_least,
    map_types,
    normalise_stats,
    schema_of,
)
from .operators.paging import number_rows, page_bounds, page_slice, with_pages
from .operators.profile import number_widths, text_widths
from .operators.profilestate import merged_profile, profile_again, profile_parts
from .operators.references import foreign_keys, identity_columns, identity_count, key_columns, ordered_list, ordered_parts
from .operators.report import count_by_kind, elapsed, object_status, run_summary, transfer_report, transfer_status
from .operators.resume import transfer_resumed
from .operators.text import normalise_text, rewrite_code, rewrite_text, strip_definition, text_between, valid_only
from .operators.transfer import copy_table, load_common_columns, transfer
from .plans.migrate import Plan, Reference, Run, TablePlan, run
from .session import fresh_path, materialise, shared_folder
from .sources.catalogue import catalogue_of, column_catalogue, common_columns, measured_catalogue
from .sources.names import name_list, read_name_list, restrict_to_list
from .sources.store import (
    Store,
    append,
    parquet_store,
    read_pages,
    read_ranges,
    read_table,
    read_tables,
    recover,
    replace,
    save_csv,
    save_log,
    truncate_load,
    tuple_cuts,
    tuple_predicates,
)

__all__ = [name for name in dir() if not name.startswith("_")]
