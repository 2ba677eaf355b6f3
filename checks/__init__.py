"""The given tables recast as filings, and every operator's query with its SQL check."""
