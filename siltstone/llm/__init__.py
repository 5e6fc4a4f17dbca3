"""Operators for preparing training data of language models. Nothing else in siltstone imports this package."""
