"""Column expressions; every one of them stays inside whole-stage code generation."""

from .disclosure import count_pct, count_text, pct_text, split_count_pct, suppress_cell, suppressed_count, suppressed_count_pct
from .recode import any_of, band, clean_answer, clean_answer_stem_last, recode, strip_parts, yes_no
from .rounding import round_half_even, scaled_half_even
from .text import after_stem, answer_text, number_text, title_case

__all__ = [
    "after_stem", "answer_text", "any_of", "band", "clean_answer", "clean_answer_stem_last", "count_pct",
    "count_text", "number_text", "pct_text", "recode", "round_half_even", "scaled_half_even",
    "split_count_pct", "strip_parts", "suppress_cell", "suppressed_count", "suppressed_count_pct",
    "title_case", "yes_no",
]
