"""The operators wired to the test tables, and the SQL that says what they give."""
