"""DataFrame -> DataFrame operators of the forecast."""
