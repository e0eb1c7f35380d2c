"""Column expressions: cleaning rules, keys, calendar attributes and planar geometry."""
