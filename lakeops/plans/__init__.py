"""Marts built from the operators; dates, thresholds and lists are arguments."""
