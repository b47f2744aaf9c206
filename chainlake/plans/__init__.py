"""Whole flows, the views over the test tables, and the registered queries."""
