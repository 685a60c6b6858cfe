"""Operators for training-data pipelines; optional, nothing else imports this package."""
