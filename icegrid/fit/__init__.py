"""Least-squares fit of a reference surface and its change, tile by tile.

The surface is z0(x, y) + dz(x, y, t), both linear between grid nodes, plus one bias per
group of points. Spark sums the normal equations of all points of all tiles; what is left is
one small linear system per tile, whose size is set by the grid and not by the points.
"""

from icegrid.fit.design import FitSpec, bias_groups, design_rows, normal_equations
from icegrid.fit.errors import fit_errors
from icegrid.fit.robust import edge_priors, evaluate, robust_fit, sigma_extra
from icegrid.fit.solve import solution_tables, solve_tiles

__all__ = [
    "FitSpec", "bias_groups", "design_rows", "edge_priors", "evaluate", "fit_errors",
    "normal_equations", "robust_fit", "sigma_extra", "solution_tables", "solve_tiles",
]
