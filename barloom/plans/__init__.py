"""Whole-pipeline compositions that materialise every layer."""
