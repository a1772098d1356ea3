"""Ready-made compositions of the operators, and the query catalogue."""
