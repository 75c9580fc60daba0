"""Normalization of arriving documents."""
