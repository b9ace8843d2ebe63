from daybook.functions.core import (  # noqa: F401
    GEOHASH_ALPHABET, OPEN_END, cosine_similarity, date_add_str, date_diff_days,
    euclidean_similarity, geohash, has_identity, hash_bucket, java_hash, not_blank,
    register_functions, squared_distance, to_day,
)
