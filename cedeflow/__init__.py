"""Monthly reinsurance reports for annuity and life blocks, as Spark DataFrames.

Every report is a function from DataFrames and a small configuration to a lazy
DataFrame.  Nothing here collects, caches or runs Python per row.
"""
