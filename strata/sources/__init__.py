"""Sources and sinks: table contracts (contracts), CSV ingest (csv), staged table
swap, append and audit log (tables)."""
