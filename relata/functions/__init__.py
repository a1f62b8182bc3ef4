"""Column helpers. All of them are built-in expressions, so they stay inside code generation."""
