"""Table-building plans: staging, dimensions, facts, the declared checks and the whole star."""
