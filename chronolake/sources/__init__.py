"""Sources and sinks: feed documents, the fixture pulls, the log store and the catalog."""
