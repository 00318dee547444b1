"""Plans: from pages to typed rows, from typed rows to training samples, and their evaluation."""
