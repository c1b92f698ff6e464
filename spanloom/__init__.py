"""Spanloom: entity mining and corpus analytics as lazy PySpark DataFrame plans."""
