"""Column-parametric operators: `DataFrame -> DataFrame`."""
