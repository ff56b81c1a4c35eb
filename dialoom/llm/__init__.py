"""Operators for training text of language models. Nothing outside this subpackage imports it."""
