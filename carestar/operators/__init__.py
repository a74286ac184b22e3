"""Operators: surrogate keys, calendar, dimensions, lookups and pre-aggregates, fact,
bridges, rejects, readmission interval join, quality checks, audit, size-checked joins."""
