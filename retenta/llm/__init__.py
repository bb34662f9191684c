"""Operators for training corpora: each in a module of its own, their queries in `queries`."""
