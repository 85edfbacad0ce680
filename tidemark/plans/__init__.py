"""The library's operators applied to the given tables, each with the SQL that gives the same rows."""
