"""lakeride."""
