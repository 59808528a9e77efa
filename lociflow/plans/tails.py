"""Tail probabilities as SQL text, from power series, for the queries' equivalent SQL."""

from __future__ import annotations


def chi2_upper_sql(x: str, df: str) -> str:
    """Upper tail of chi-squared: 1 minus the series of the regularised lower incomplete gamma function."""
    s, h = f"(({df}) / 2.0)", f"(({x}) / 2.0)"
    terms = f"list_sum(list_transform(range(0, 600), lambda i: exp(({s} + i) * ln({h}) - {h} - lgamma({s} + i + 1))))"
    return f"CASE WHEN ({x}) IS NULL OR ({df}) < 1 THEN NULL WHEN ({x}) <= 0 THEN 1.0 WHEN ({x}) > 900 THEN 0.0 ELSE greatest(1 - {terms}, 0.0) END"


def normal_two_sided_sql(z: str) -> str:
    """Two-sided p of a normal z, as the upper tail of its square."""
    return chi2_upper_sql(f"({z}) * ({z})", "1")


def normal_upper_sql(z: str) -> str:
    """One-sided p of a normal z."""
    both = normal_two_sided_sql(z)
    return f"CASE WHEN ({z}) > 0 THEN ({both}) / 2 ELSE 1 - ({both}) / 2 END"


def _beta_series(x: str, a: str, b: str) -> str:
    front = f"exp({a} * ln({x}) + {b} * ln(1 - {x}) + lgamma({a} + {b}) - lgamma({a} + 1) - lgamma({b}))"
    ratio = f"exp(lgamma({a} + 1) + lgamma({a} + {b} + i + 1) - lgamma({a} + {b}) - lgamma({a} + i + 2) + (i + 1) * ln({x}))"
    return f"{front} * (1 + list_sum(list_transform(range(0, 200), lambda i: {ratio})))"


def t_two_sided_sql(t: str, df: str) -> str:
    """Two-sided p of Student's t, by the series of the regularised incomplete beta function on its quick side."""
    square = f"(({t}) * ({t}))"
    x, y, a = f"(({df}) / (({df}) + {square}))", f"({square} / (({df}) + {square}))", f"(({df}) / 2.0)"
    sides = f"WHEN {x} <= 0.5 THEN {_beta_series(x, a, '0.5')} ELSE 1 - {_beta_series(y, '0.5', a)}"
    return f"CASE WHEN ({t}) IS NULL OR ({df}) < 1 THEN NULL WHEN ({t}) = 0 THEN 1.0 WHEN isinf({t}) THEN 0.0 {sides} END"
