"""Training-data operators: binary output, dedup, scans, language ID, quality, BPE, chat formatting."""
