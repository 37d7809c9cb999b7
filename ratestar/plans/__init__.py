"""Metric views of the star and the catalog of ready-made questions."""
