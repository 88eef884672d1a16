"""Whole jobs from input to result, and the table-shaped inputs the registered queries use."""
