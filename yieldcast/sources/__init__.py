from yieldcast.sources.files import load, read_raw_csv, read_parquet, resolve_format, write_table  # noqa: F401
from yieldcast.sources.fixture import raw_records  # noqa: F401
