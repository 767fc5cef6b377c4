"""Training-data operators: tokens, secrets, decontamination, quality, vectors, dedup, BPE, language and PII."""
