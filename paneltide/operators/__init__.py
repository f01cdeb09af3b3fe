"""DataFrame -> DataFrame operators over the indicator panel."""
