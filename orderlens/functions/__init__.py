"""Column expressions: cleaning, derivations, exact money arithmetic."""
