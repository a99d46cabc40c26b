"""Operators that prepare question banks and documents for language-model training."""
