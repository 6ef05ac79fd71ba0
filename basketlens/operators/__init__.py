"""DataFrame -> DataFrame operators; see README for the SURVEY §2 mapping."""
