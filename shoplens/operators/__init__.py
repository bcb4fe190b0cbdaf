"""DataFrame operators of the reports, grouped by subject."""
