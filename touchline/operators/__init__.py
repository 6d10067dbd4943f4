"""Operators: lazy DataFrame -> DataFrame functions, no action inside."""
