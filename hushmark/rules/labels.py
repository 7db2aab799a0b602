"""Label taxonomy, state machines and conflict rules."""

from __future__ import annotations

# Label names per dimension.
TAXONOMY = {
    "profile_id": ("PROFILE_1_DIRECTO", "PROFILE_2_HESITANTE", "PROFILE_3_DECEPCIONADO"),
    "customer_status": ("PROSPECT", "LEAD_QUALIFIED", "CUSTOMER", "CHURNED"),
    "primary_intent": (
        "GREETING", "TRANSACTIONAL_INQUIRY", "RELATIONAL_QUESTION",
        "HESITATION_OR_OBJECTION", "NEGATIVE_FEEDBACK", "SMALL_TALK",
        "COMPLIMENT", "PERSONAL_SHARE", "FANTASY_ROLEPLAY",
        "TECHNICAL_ISSUE", "GOODBYE",
    ),
    "message_tone": ("FRIENDLY", "ENGAGED", "SKEPTICAL", "FRUSTRATED", "DISMISSIVE"),
    "rapport_stage": (
        "ICE_BREAKER", "RAPPORT_BUILDING", "DEEP_EMOTION", "HIGH_INTENT", "CLOSING",
    ),
    "safety_level": (
        "LEVEL_0_SAFE", "LEVEL_1_FLIRT_SAFE", "LEVEL_2_BORDERLINE", "LEVEL_3_INAPPROPRIATE",
    ),
}
# The guidelines know one more lifecycle state than the label list.
GUIDELINE_TAXONOMY = TAXONOMY | {
    "customer_status": TAXONOMY["customer_status"] + ("LEAD_EXHAUSTED",)
}
# Dimensions compared between calibration sessions.
SESSION_DIMENSIONS = ("primary_intent", "message_tone", "safety_level")
# Dimensions profiled by the label report.
LABEL_DIMENSIONS = (
    "profile_id", "customer_status", "primary_intent", "rapport_stage", "safety_level",
)

# Allowed next states.
STAGE_EDGES = {
    "ICE_BREAKER": ("RAPPORT_BUILDING", "CLOSING"),
    "RAPPORT_BUILDING": ("DEEP_EMOTION", "HIGH_INTENT", "CLOSING"),
    "DEEP_EMOTION": ("HIGH_INTENT", "RAPPORT_BUILDING"),
    "HIGH_INTENT": ("CLOSING",),
    "CLOSING": (),
}
GUIDELINE_STAGE_EDGES = {
    "ICE_BREAKER": ("RAPPORT_BUILDING", "CLOSING"),
    "RAPPORT_BUILDING": ("DEEP_EMOTION", "HIGH_INTENT", "CLOSING", "ICE_BREAKER"),
    "DEEP_EMOTION": ("HIGH_INTENT", "RAPPORT_BUILDING", "CLOSING"),
    "HIGH_INTENT": ("CLOSING",),
    "CLOSING": ("ICE_BREAKER",),
}
STATUS_EDGES = {
    "PROSPECT": ("LEAD_QUALIFIED",),
    "LEAD_QUALIFIED": ("CUSTOMER", "LEAD_EXHAUSTED", "PROSPECT"),
    "LEAD_EXHAUSTED": ("CUSTOMER", "CHURNED", "LEAD_QUALIFIED"),
    "CUSTOMER": ("CHURNED",),
    "CHURNED": (),
}
# The edge that the guidelines allow only after a significant gap.
GAP_EDGES = (("CLOSING", "ICE_BREAKER"),)

# Conflict rules, code -> {dimension: labels}; a row conflicts when every dimension matches.
CONFLICT_RULES = {
    "negative_feedback_low_safety": {
        "primary_intent": ("NEGATIVE_FEEDBACK",),
        "safety_level": ("LEVEL_0_SAFE", "LEVEL_1_FLIRT_SAFE"),
    },
    "transactional_in_deep_emotion": {
        "primary_intent": ("TRANSACTIONAL_INQUIRY",),
        "rapport_stage": ("DEEP_EMOTION",),
    },
    "inappropriate_with_high_rapport": {
        "safety_level": ("LEVEL_3_INAPPROPRIATE",),
        "rapport_stage": ("HIGH_INTENT", "DEEP_EMOTION"),
    },
}

# Thresholds.
AGREEMENT_GATE = 0.9
REVIEW_RATE_GATE = 0.2
LARGEST_SHARE_GATE = 0.4
OTHER_SHARE_GATE = 0.05
RISK_SHARE_GATE = 0.05
SAFE_SHARE_ALERT = 0.95
MIN_DISTINCT_INTENTS = 5
MIN_LEVEL3_EXAMPLES = 10
OTHER_LABEL = "OTHER"
