"""Table, file, raw-export and topic sources and sinks."""
