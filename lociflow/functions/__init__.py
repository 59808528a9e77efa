"""Column expressions: alleles, identifiers, names, numbers, statistics."""
