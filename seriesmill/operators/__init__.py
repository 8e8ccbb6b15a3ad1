"""Forecasting operators: DataFrame in, DataFrame out."""
