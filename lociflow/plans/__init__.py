"""Registered queries with their equivalent SQL."""

from lociflow.plans import causal, compounds, drugs, genes, problems, signatures, variants

_MODULES = (problems, variants, causal, drugs, compounds, genes, signatures)

#: name -> query(spark, folder of the tables)
REGISTRY = {name: query for module in _MODULES for name, query in module.QUERIES.items()}
#: name -> equivalent SQL
ORACLES = {name: sql for module in _MODULES for name, sql in module.SQL.items()}
