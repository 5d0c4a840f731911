"""Operators for preparing training data: fingerprints to packed token sequences."""
