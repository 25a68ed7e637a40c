"""DataFrame -> DataFrame operators of the monitoring model."""
