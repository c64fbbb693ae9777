"""Whole computations: hourly features, street analysis, model inputs."""
