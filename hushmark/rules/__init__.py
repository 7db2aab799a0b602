"""Rule tables: plain data that the operators take as arguments."""
