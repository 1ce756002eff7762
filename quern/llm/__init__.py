"""Operators for corpora of texts and vectors. Nothing outside this folder imports them."""
