"""Distributed operators."""
