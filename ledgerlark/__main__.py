"""``python -m ledgerlark --data lines.csv --output results``"""

import argparse

from ledgerlark.plans.report import run_report
from ledgerlark.session import build_session

if __name__ == "__main__":
    parser = argparse.ArgumentParser(description="Sales report")
    parser.add_argument("--data", required=True, help="sales lines: a file, a folder or a table")
    parser.add_argument("--format", help="csv, parquet, orc, json or table; else by suffix")
    parser.add_argument("--multi-line", action="store_true", help="CSV with line breaks inside quotes")
    parser.add_argument("--output", required=True, help="folder for summaries and chart data")
    options = parser.parse_args()
    run_report(build_session(), options.data, options.output, options.format, options.multi_line)
