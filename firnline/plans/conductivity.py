"""Distribution of the spring conductance."""

from ..operators.density import GRID_POINTS, component_curves, component_peaks, grid_end, kernel_density
from ..operators.filters import day_slice
from ..operators.mixture import gaussian_mixture


def conductivity_mixture(spring, k, first=None, last=None, column="slt", points=GRID_POINTS, n_init=10, seed=0):
    """Components (with peak height) and the density grid with all component curves."""
    rows = spring if first is None else day_slice(spring, "ts", first, last)
    components = gaussian_mixture(rows, column, k, n_init=n_init, seed=seed)
    end = grid_end(rows, column)
    curves = component_curves(components, end, points=points)
    return (
        components.join(component_peaks(curves), "component"),
        kernel_density(rows, column, end, points=points),
        curves,
    )
