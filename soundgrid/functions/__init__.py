"""Scalar expressions: depth encoding, charting rules, tile arithmetic."""
