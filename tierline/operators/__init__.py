"""Table-agnostic operators: every one maps DataFrame(s) + parameters to a DataFrame."""
