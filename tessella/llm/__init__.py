"""Training-data operators: duplicates, canonical values, names, tokens, leakage, abuse."""
