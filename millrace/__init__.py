"""DataFrame operators for text, revision histories, film records, cohorts and pixels."""
