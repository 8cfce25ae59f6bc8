"""Training-data operators: tokenising, scoring, extraction, filtering,
de-duplication, sharding. Nothing outside this folder (but for the entry
module's guarded import) depends on it."""
