"""Rules that send a machine annotation to human review.

Codes are ``type`` or ``type:variant``; the part before the colon is the issue
type that reports group by.
"""

from __future__ import annotations

LOW_CONFIDENCE = "low_confidence"
LOW_CONFIDENCE_TRANSACTIONAL = "low_confidence_transactional"
SAFETY_REVIEW = "safety_review"
SENSITIVE_INTENT = "sensitive_intent"
RESPONSE_TOO_LONG = "response_too_long"
TOO_MANY_EMOJI = "too_many_emoji"
TOO_MANY_QUESTIONS = "too_many_questions"

# Contradicting labels, code -> {dimension: labels}
CONSISTENCY_RULES = {
    "inconsistent:negative_feedback_friendly": {
        "primary_intent": ("NEGATIVE_FEEDBACK",),
        "message_tone": ("FRIENDLY",),
    },
    "inconsistent:compliment_frustrated": {
        "primary_intent": ("COMPLIMENT",),
        "message_tone": ("FRUSTRATED",),
    },
    "inconsistent:inappropriate_positive_tone": {
        "safety_level": ("LEVEL_3_INAPPROPRIATE",),
        "message_tone": ("FRIENDLY", "ENGAGED"),
    },
}

# Thresholds, wording patterns and the emoji range.
CONFIDENCE_REVIEW = 0.8
CONFIDENCE_TRANSACTIONAL = 0.7
MAX_SENTENCES = 3
MAX_EMOJI = 2
MAX_QUESTIONS = 1
TRANSACTIONAL_INTENT = "TRANSACTIONAL_INQUIRY"
RISKY_LEVELS = ("LEVEL_2_BORDERLINE", "LEVEL_3_INAPPROPRIATE")
SENSITIVE_INTENTS = ("HESITATION_OR_OBJECTION", "NEGATIVE_FEEDBACK")
SENTENCE_BREAK = "[.!?]+"
EMOJI = r"[\x{1F300}-\x{1FAF6}]"
# code -> pattern searched in the lower-cased response
WORDING_RULES = {
    "mentions_price": r"(?U)\$\d+",
    "mentions_platform": "fanvue|onlyfans",
    "makes_promise": "prometo|garantizo",
    "too_intimate": "amor|cariño|bebé",
}
TOP_CANDIDATES = 20
EXAMPLES_PER_ISSUE = 3
MISSING_TEXT = "N/A"
CORRECTION_FIELDS = ("primary_intent", "message_tone", "safety_level", "ideal_response", "notes")
