"""Registered queries over the driver's test tables, each with the SQL that must give the same rows."""
