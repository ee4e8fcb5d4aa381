"""Sources and sinks: meter files, topic messages, point tables, test tables."""
