from tidemark.functions.keys import is_uuid, random_uuid, uuid5
from tidemark.functions.text import (
    WHITE_SPACE,
    is_blank,
    merge_text,
    trim_unicode,
    truncate_chars,
)

__all__ = [
    "WHITE_SPACE",
    "is_blank",
    "is_uuid",
    "merge_text",
    "random_uuid",
    "trim_unicode",
    "truncate_chars",
    "uuid5",
]
