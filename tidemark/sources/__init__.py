"""Sources and sinks: table scans past a cursor, saved API pages, JSON arrays, JSONL landing."""
