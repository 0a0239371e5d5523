"""Typed staging, dimensions, facts, quality tests and business measures over raw tables.

The documented but never coded layer of the capability list; definitions are
this library's.  Money is decimal, so sums do not depend on row order.
"""
