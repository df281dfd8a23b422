from ledgerlark.sources.readers import (
    as_sales_lines,
    load_raw,
    load_with_quarantine,
    read_lines,
    read_text_rows,
)
from ledgerlark.sources.schema import SALES_LINES
from ledgerlark.sources.sets import read_set, set_counts, write_set
from ledgerlark.sources.sinks import (
    CSV_OPTIONS,
    append_lines,
    write_chart_frames,
    write_csv,
    write_json,
    write_summaries,
)
from ledgerlark.sources.star import sales_lines, table

__all__ = [
    "CSV_OPTIONS",
    "SALES_LINES",
    "append_lines",
    "as_sales_lines",
    "load_raw",
    "load_with_quarantine",
    "read_lines",
    "read_set",
    "read_text_rows",
    "sales_lines",
    "set_counts",
    "table",
    "write_chart_frames",
    "write_csv",
    "write_json",
    "write_set",
    "write_summaries",
]
