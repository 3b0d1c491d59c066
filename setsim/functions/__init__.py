from setsim.functions.columns import (
    BLANK_PATTERN,
    bits_to_text,
    blank_to_null,
    bucket_hash,
    digest28,
    is_blank,
    n_words,
    nan_to_null,
    packed_intersection,
    packed_words,
    ring_window_bits,
    strict_whole_number,
    tanimoto,
    tanimoto_from_sizes,
)
from setsim.functions.keyfilter import key_filter

__all__ = [
    "BLANK_PATTERN", "bits_to_text", "blank_to_null", "bucket_hash", "digest28", "is_blank", "key_filter",
    "n_words", "nan_to_null", "packed_intersection", "packed_words", "ring_window_bits", "strict_whole_number", "tanimoto", "tanimoto_from_sizes",
]
