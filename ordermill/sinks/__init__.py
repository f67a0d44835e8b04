"""Writers: run-date partitions and warehouse tables."""
