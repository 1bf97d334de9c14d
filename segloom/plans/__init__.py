"""Registered queries and the SQL that states what they compute."""
