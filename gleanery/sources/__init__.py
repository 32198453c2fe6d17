"""Sources and sinks: message transports, migrated page folders, keyed tables."""
