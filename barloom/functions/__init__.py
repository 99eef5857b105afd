"""Column expressions and the forecasting kernels."""
