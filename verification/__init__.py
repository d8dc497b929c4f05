"""One query per operator on the test tables, and the same result in SQL."""
