"""Input schemas, readers, cleansers, sinks and test fixtures."""
