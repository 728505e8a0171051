"""Operators over DataFrames of pixels, tiles, files and features."""
