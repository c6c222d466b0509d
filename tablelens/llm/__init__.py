"""Operators for training-data pipelines; each module states its method and its defined cases."""
