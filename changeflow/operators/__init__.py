"""DataFrame operators: filtering, resolution, state reduction, latest state."""
