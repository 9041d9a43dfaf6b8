"""Operations of a training-data pipeline: dedup, mixing, packing, privacy, secrets, toxicity, extraction."""
