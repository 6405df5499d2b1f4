"""DataFrame to DataFrame operators: scores, tiers, checks, schemas, documents, reports."""
