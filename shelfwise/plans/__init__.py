"""Composite plans: the five marts, the layer pipeline and the query registry."""
