"""File readers, incremental loading, table access and export."""
