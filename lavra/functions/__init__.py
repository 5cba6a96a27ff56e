"""Column → Column functions: text, numbers, dates, classifiers, geometry, names."""

from .classify import first_match_regex, first_match_set
from .dates import parse_dayfirst, parse_iso, parse_two_formats
from .geo import first_ring_centroid
from .names import dedupe_names, rename_all, snake_ascii, snake_keep_accents
from .numbers import br_money, br_quantity, nullable_int, to_double
from .paths import extension, url_basename, url_host
from .text import (concat_skip_blank, cp1252_from_latin1, extract_optional_int, is_blank,
                   lower_contains_any, na_tokens_to_null, strip_unicode)

__all__ = [
    "first_match_regex", "first_match_set", "parse_dayfirst", "parse_iso", "parse_two_formats",
    "first_ring_centroid", "dedupe_names", "rename_all", "snake_ascii", "snake_keep_accents",
    "br_money", "br_quantity", "nullable_int", "to_double", "extension", "url_basename",
    "url_host", "concat_skip_blank", "cp1252_from_latin1", "extract_optional_int", "is_blank",
    "lower_contains_any", "na_tokens_to_null", "strip_unicode",
]
