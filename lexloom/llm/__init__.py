"""Operators on texts for training corpora; nothing outside this subpackage imports it."""
