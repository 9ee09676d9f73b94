"""DataFrame -> DataFrame transforms and reports."""
