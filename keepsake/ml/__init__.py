"""Churn model: training set, splits, metrics, boosted trees, batch scores."""
