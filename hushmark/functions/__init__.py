from hushmark.functions.draws import digits_of, draw, draw_of, let, pick, text_array
from hushmark.functions.text import (
    bar,
    blank,
    contains_any,
    emoji_count,
    guess_language,
    issue_type,
    matches_labels,
    percent,
    question_marks,
    sentence_count,
    whole_words,
)

__all__ = [
    "bar", "blank", "contains_any", "digits_of", "draw", "draw_of", "emoji_count", "guess_language", "issue_type",
    "let", "matches_labels", "percent", "pick", "question_marks", "sentence_count", "text_array", "whole_words",
]
