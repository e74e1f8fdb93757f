"""Whole queries made of operators, with the SQL that they are checked against."""
