"""Whole plans: pipelines, reports, evaluation, noise, training sets."""
