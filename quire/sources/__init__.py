"""Sources and sinks: table loaders, tolerant scans, partition discovery, extraction."""
