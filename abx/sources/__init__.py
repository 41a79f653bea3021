from abx.sources.fixtures import listings, userlog, users
from abx.sources.tables import experiments_frame, read_csv, read_parquet, read_table, rows_to_frame

__all__ = ["listings", "userlog", "users", "experiments_frame", "read_csv", "read_parquet",
           "read_table", "rows_to_frame"]
