"""End-to-end plans: stand-in inputs, silver and gold layers, odds analytics."""
