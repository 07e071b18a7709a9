"""Queries that run the engine over the star-schema test tables, with the SQL they must equal."""
