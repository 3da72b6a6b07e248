"""Whole jobs that chain the operators: accidents, vehicles, publications, glucose."""
