"""Column-level functions: built-in expressions only (JVM side, codegen'd)."""

from strata.functions.keys import hash_key, key_text
from strata.functions.parse import parse_event_time, category_level
from strata.functions.buckets import hash_fraction, weighted_bucket, uniform_choice

__all__ = ["hash_key", "key_text", "parse_event_time", "category_level",
           "hash_fraction", "weighted_bucket", "uniform_choice"]
