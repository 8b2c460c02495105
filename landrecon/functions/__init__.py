"""Column expressions. Each one fixes a NULL rule or a type rule of the source dialect."""
