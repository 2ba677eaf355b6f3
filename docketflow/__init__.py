"""Spark jobs for regulatory filings: listings, annual reports, documents, text."""

from .functions.fields import (
    clean_cik,
    coerce_year,
    month_name,
    normalize_cik,
    normalize_form,
    parse_date,
    period_quarter,
    period_year,
)
from .functions.text import split_lines, strip
from .functions.urls import absolute_url, accession_parts, fetch_target, fix_viewer_url
from .operators.annual import (
    add_filing_year,
    add_month_year,
    drop_sentinel_dates,
    filter_annual,
    keep_annual_forms,
    normalize_keys,
    require_columns,
    select_filings,
)
from .operators.index import is_data_line, parse_index, strip_all
from .operators.order import (
    assign_part,
    first_batches,
    first_n,
    nth_record,
    ordered,
    row_index,
    running_total,
    union_all,
)
from .operators.outcomes import (
    clean_pages,
    outcome_records,
    pick_document,
    resolve_attempts,
    resolve_documents,
    snake_columns,
)
from .operators.periods import pending, plan_periods, quarter_list, year_list, years_table
from .operators.summary import (
    batch_counts,
    count_distinct,
    describe_text,
    monthly_counts,
    profile,
    shape,
    status_counts,
    year_preview,
)
from .plans.jobs import annual_job, clean_job, documents_job, fetch_job, index_job
from .schemas import FETCHED, FILING, FILING_ORDER, RESPONSE, check_schema
from .session import build_session, staged, work_path
from .sources.index_files import scan_index, unreadable_files
from .sources.tables import (
    compact,
    document_keys,
    list_parts,
    may_write,
    output_exists,
    scan_documents,
    scan_parts,
    scan_table,
    write_documents,
    write_parts,
    write_table,
)
from .streaming.jobs import stream_clean, stream_fetch, stream_filter
