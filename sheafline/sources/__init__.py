"""Table, CSV and page readers, and file sinks."""
