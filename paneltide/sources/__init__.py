"""Sources and sinks: table readers, the driver-table mapping, stream adapters."""
