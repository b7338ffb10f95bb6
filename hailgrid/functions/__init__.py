"""Column-level helpers: calendar, exact money, typed time literals, size checks."""
