"""Operators over DataFrames: filters, versions, paging, upsert, rules, outliers."""
