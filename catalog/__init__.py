"""Queries over the test tables, each with the SQL that another engine must agree with."""
