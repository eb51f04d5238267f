"""Operators for language-model training data. Nothing outside this folder and its tests imports it."""
