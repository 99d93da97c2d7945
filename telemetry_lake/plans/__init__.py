"""The user-level jobs: plain functions from input DataFrames to result DataFrames.

Callers read the inputs and write the results, so the same plan serves a job, a notebook
and a test.
"""
