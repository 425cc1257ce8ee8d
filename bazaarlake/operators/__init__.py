"""Row-set operators: cleaning, de-duplication, upsert and quality checks."""
