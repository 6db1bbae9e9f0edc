"""Training-data operators: cleaning, deduplication, tokenising and packing of text tables."""
