"""Column functions: cleaning of dirty text and date arithmetic, all Catalyst expressions."""
