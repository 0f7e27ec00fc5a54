"""Column expressions and the distributed statistics that the operators share."""
