"""Classifiers on named columns."""
