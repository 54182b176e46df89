"""Column functions: calendar, arrays, scores and keyed randomness."""
