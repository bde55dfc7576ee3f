"""Trajectory analytics and training-data operators expressed as Spark plans."""
