"""Models composed from operators: bronze, silver, gold, reports, audit, retrieval."""
