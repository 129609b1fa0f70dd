from .storage import Stages, broadcast_if_small, content_mark, join_catalogue, shared_dir
from .tables import (
    Inputs, load_inputs, read_submission, read_tables, table_sizes, write_csv, write_parquet,
)

__all__ = [
    "Inputs", "Stages", "broadcast_if_small", "content_mark", "join_catalogue", "load_inputs", "read_submission",
    "read_tables", "shared_dir", "table_sizes", "write_csv", "write_parquet",
]
