"""Plans: the batch route from documents to tables, and queries on fixtures."""
