"""Training-data operators: language identification, chat rendering, secret scans, near-duplicate joins, URL filters,
byte-level BPE, token counts, line dedup, vector search and benchmark decontamination."""
