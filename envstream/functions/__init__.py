"""Column expressions built from Spark's own functions."""

from envstream.functions.columns import (
    class_of,
    epoch_seconds,
    epoch_to_timestamp,
    first_description,
    fits_fact_id,
    md5_bucket,
    name_key,
    name_part,
    nearest_class,
    packed_fact_id,
    text_digest,
    wall_clock_epoch,
    wide_fact_id,
)

__all__ = [
    "class_of", "epoch_seconds", "epoch_to_timestamp",
    "first_description", "fits_fact_id", "md5_bucket", "name_key", "name_part", "nearest_class", "packed_fact_id",
    "text_digest", "wall_clock_epoch", "wide_fact_id",
]
