"""Column functions: calendar, exact arithmetic, labels, null placement."""
