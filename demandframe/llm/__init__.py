"""Operators for preparing language-model training text. Nothing outside this subpackage imports it but the entry file."""
