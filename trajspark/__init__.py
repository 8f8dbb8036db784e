"""Trajectory-to-training-row expansion, token/cost sizing and model comparison on Spark."""
