"""Soil rollup operators: DataFrame(s) + parameters -> DataFrame."""
