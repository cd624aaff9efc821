"""Whole runs made of the operators."""
