"""Column expressions: text clean-up, rounding, price labels and job lifecycle."""
