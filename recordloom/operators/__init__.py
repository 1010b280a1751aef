"""DataFrame operators: flatten, shred, key, merge, increment, relate, profile."""
