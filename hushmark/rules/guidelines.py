"""Keyword and lifecycle rules stated by the labelling guidelines."""

from __future__ import annotations

# Alert words for level 2, the short replies, and the lifecycle limits.
LEVEL2_WORDS = ("sexy", "caliente", "fantasías", "juntos", "cama")
SHORT_REPLIES = ("ok", "ya")
MIN_OFFERS = 3
MIN_INTERACTIONS = 20
MAX_QUIET_DAYS = 7
MIN_SOFT_REJECTIONS = 2
QUALIFIED_STATUS = "LEAD_QUALIFIED"
MIN_MESSAGES = 3
MAX_MESSAGES = 50
VOCABULARY_LIMIT = 10_000

# Safety level per word list, lowest first.  The guidelines describe the level-3
# words without listing them: pass a list of your own.
SAFETY_WORDS = {
    "LEVEL_2_BORDERLINE": LEVEL2_WORDS,
    "LEVEL_3_INAPPROPRIATE": (),
}
# Heuristic intents by priority: the first list with a hit wins.
INTENT_WORDS = {
    "TRANSACTIONAL_INQUIRY": ("precio", "costo", "pago", "cuesta", "pagar", "price", "cost"),
    "HESITATION_OR_OBJECTION": ("no sé si", "pero", "vale la pena", "not sure", "but"),
}
GREETING_WORDS = ("hola", "hey", "buenas", "hello", "hi")
