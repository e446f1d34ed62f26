"""Sources and sinks: registry, landed pages, archive tables, documents."""
