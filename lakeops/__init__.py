"""Data-platform operators for Spark tables and streams."""
