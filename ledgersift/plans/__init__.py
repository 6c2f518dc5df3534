"""What users call: cleaning, profiling and feature retrieval."""
