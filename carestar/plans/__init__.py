"""Plans: the lazy star build, the four questions, the full-refresh pipeline, the comparison
report, and the catalog of registered queries."""
