"""Operators on DataFrames: each returns a lazy DataFrame unless it says otherwise."""
