"""Column functions: no state, no rows, all inside code generation."""
