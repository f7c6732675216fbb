"""Builds and queries made of the operators."""
