"""Forecasters. Each takes the series state and a fold table and returns forecasts."""
