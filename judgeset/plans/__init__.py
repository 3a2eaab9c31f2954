"""Whole workloads made of operators."""
