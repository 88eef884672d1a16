"""Spark analytics jobs: term ranking, posting clusters, time-use surveys and relational reports.

Every job takes and returns DataFrames, creates no session of its own and runs on built-in
expressions only.
"""
