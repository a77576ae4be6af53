"""Composed jobs over stored layers."""
