"""Column -> Column building blocks: text rules, exact numerics, vector math."""
