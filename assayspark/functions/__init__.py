"""Column expressions, aggregate expressions and probability tails."""
