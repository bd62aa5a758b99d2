"""Jobs: ingest, gap check, table maintenance."""
