"""Campaign-finance batch jobs as plain functions on Spark DataFrames.

sources    read delimited bulk text, HTML code tables and staged files
functions  column expressions: code labels, typing, dates, ZIP codes
operators  frame steps: renames, lookups, loads with a tolerance, refreshes
plans      the twelve models and the order they build in
"""
