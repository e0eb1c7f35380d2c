"""DataFrame operators: filters, projections, deduplication, members, lookups, regions, checks."""
