"""Column expressions: cleaning, text, features, and small driver-side numerics."""
