"""The supplied tables as device series, the registered queries on them, and their oracle SQL."""
