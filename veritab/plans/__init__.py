"""Composed runs built from the operators (monitor run, preprocessing flow, EDA report)."""
