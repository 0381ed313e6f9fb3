"""Listing-market analytics expressed as Spark DataFrame transformations."""
