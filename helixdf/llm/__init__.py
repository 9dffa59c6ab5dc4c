"""Operators for preparing training text, each an ordinary DataFrame-in, DataFrame-out function."""
