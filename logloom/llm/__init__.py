"""Training-data pipeline operators.

Nothing else in the library imports this subpackage; ``queries`` holds its
registered queries and their oracle SQL.
"""
