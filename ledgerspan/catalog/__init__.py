"""Registered queries on the test tables and, for each, the SQL that must give the same rows."""
