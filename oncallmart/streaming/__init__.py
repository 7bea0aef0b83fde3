"""The Silver job as an incremental load of newly arrived Bronze files."""
