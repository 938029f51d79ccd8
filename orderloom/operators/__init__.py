"""DataFrame operators: staging, dedupe, lookups, rollups, upsert, history, incremental, quality."""
