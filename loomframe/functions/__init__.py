from loomframe.functions.nested import flatten_struct, parse_json
from loomframe.functions.numeric import exact_sum, minutes_between, seconds_of
from loomframe.functions.text import (
    field,
    grep,
    has_words,
    rest_of_line,
    split_columns,
    split_literal,
    token,
    tokens,
    word_lengths,
    words,
)

__all__ = [
    "exact_sum",
    "field",
    "flatten_struct",
    "grep",
    "has_words",
    "minutes_between",
    "parse_json",
    "rest_of_line",
    "seconds_of",
    "split_columns",
    "split_literal",
    "token",
    "tokens",
    "word_lengths",
    "words",
]
