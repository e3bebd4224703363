"""DataFrame operators: staging, lookups, as-of join, pricing rules, rollups."""
