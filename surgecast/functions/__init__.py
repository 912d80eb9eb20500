from surgecast.functions.hashing import hashed_uniform, key_text, sequence_seeds, sequence_uniform
from surgecast.functions.scalars import (
    AGE_BANDS,
    INVALID_AGE,
    age_band,
    band_from_interval_label,
    counted_days,
    date_from_file_name,
    parse_dmy,
)

__all__ = [
    "AGE_BANDS",
    "INVALID_AGE",
    "age_band",
    "band_from_interval_label",
    "counted_days",
    "date_from_file_name",
    "hashed_uniform",
    "key_text",
    "parse_dmy",
    "sequence_seeds",
    "sequence_uniform",
]
