"""Listing-lifecycle analytics on PySpark.

Raw listing snapshots go in, lifecycle spells and marts come out; see the README for a tour.
"""
