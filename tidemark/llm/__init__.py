"""Training-corpus operators: cleaning, deduplication, decontamination, formatting, packing."""
