"""The library run on the test tables, with the SQL each query must agree with."""
