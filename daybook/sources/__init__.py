from daybook.sources.io import (  # noqa: F401
    append_table, as_view, lines_of, read_csv, read_jdbc, read_lines, read_parquet,
    read_table, spread, string_schema, write_bucketed, write_parquet,
)
from daybook.sources.quarantine import csv_rejects, placed_lines  # noqa: F401
from daybook.sources.sizing import file_sizes, write_sized  # noqa: F401
from daybook.sources.session import DEFAULT_CONF, build_session, checkpoint_dir  # noqa: F401
