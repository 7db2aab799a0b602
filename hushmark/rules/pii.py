"""Redaction rules, written for Java regular expressions.

Every pattern runs with ``(?iuU)``: case-insensitive, Unicode case folding,
Unicode classes.  A word character is a letter, a number or ``_``; combining
marks are not, so the class is spelled out instead of using ``\\b``, which in
Java counts marks (an emoji variation selector after a phone number would hide
the number).  ``WS`` adds the four separator controls that Java's ``\\s`` leaves
out.

No pattern has two adjacent repeats over overlapping classes, so a long run of
blanks or digits costs linear time.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from typing import NamedTuple

FLAGS = "(?iuU)"
WORD = r"[\p{L}\p{N}_]"
WS = r"[\s\x1c-\x1f]"
OPEN = rf"(?<!{WORD})"  # a word starts here (next character is a word character)
CLOSE = rf"(?!{WORD})"  # a word ends here (previous character is a word character)
EDGE = rf"(?:(?<={WORD})(?!{WORD})|(?<!{WORD})(?={WORD}))"  # either of the two

# The 40 given and family names, the street words, the phone and
# platform prefixes, and the replacement tokens.
NAME_BANK = (
    "John", "Mary", "David", "Jennifer", "Michael", "Sarah", "Robert", "Lisa",
    "James", "Emily", "Andrew", "Jessica", "Smith", "Johnson", "Brown", "Davis",
    "Wilson", "Miller", "Taylor", "Anderson", "Thompson", "White", "Martinez", "Garcia",
    "Juan", "María", "Carlos", "Ana", "Pedro", "Laura", "Miguel", "Isabel",
    "Pérez", "García", "López", "Martínez", "Sánchez", "Rodríguez", "Hernández", "González",
)
STREET_WORDS = (
    "Street", "St", "Avenue", "Ave", "Drive", "Dr", "Road", "Rd", "Boulevard", "Blvd",
    "Lane", "Ln", "Way", "Court", "Ct", "Plaza", "Place", "Pl",
    "Calle", "Avenida", "Av", "Privada", "Colonia",
)
STREET_ABBREVIATION = "Col."
PHONE_PREFIXES = ("Tel", "Cel", "Cell", "Phone", "WhatsApp")
PLATFORM_PREFIXES = ("IG", "Instagram", "Twitter", "FB", "Facebook", "Snap", "Snapchat")
AUDIT_NAMES = (
    "John Smith", "Mary Johnson", "David Brown", "Jennifer Davis",
    "Juan Pérez", "María García", "Carlos López", "Ana Martínez",
)
TOKENS = {
    "name": "[NAME_REMOVED]",
    "email": "[EMAIL_REMOVED]",
    "phone": "[PHONE_REMOVED]",
    "social": "[SOCIAL_REMOVED]",
    "address": "[ADDRESS_REMOVED]",
    "url": "[URL_REMOVED]",
}
DEFAULT_TOKEN = "[REMOVED]"
# Categories that take part in counts and totals; url is rewritten but not counted.
COUNTED = ("name", "email", "phone", "social", "address")


class PiiRule(NamedTuple):
    """One redaction step.

    ``needs`` holds substrings of which one must occur for the pattern to be able
    to match; ``needs_digit`` says a digit would do as well.  Both only save work.
    ``counted`` says whether matches take part in totals.
    """

    category: str
    pattern: str
    token: str
    needs: tuple[str, ...] = ()
    needs_digit: bool = False
    counted: bool = True


def any_of(words: Iterable[str]) -> str:
    return "(?:" + "|".join(re.escape(w) for w in words) + ")"


def _by_initial(words: Iterable[str]) -> str:
    """Alternatives grouped by first letter, so that most positions fail after one test each."""
    groups: dict[str, list[str]] = {}
    for word in words:
        groups.setdefault(word[0].upper(), []).append(re.escape(word[1:]))
    arms = (re.escape(initial) + "(?:" + "|".join(rest) + ")" for initial, rest in groups.items())
    return "(?:" + "|".join(arms) + ")"


def name_pattern(bank: Iterable[str] = NAME_BANK) -> str:
    """Any two bank entries next to each other; the look-ahead skips most words early."""
    bank = tuple(bank)
    initials = "[" + "".join(sorted({re.escape(name[0]) for name in bank})) + "]"
    one = _by_initial(bank)
    return FLAGS + OPEN + f"(?={initials})" + one + WS + "+" + one + CLOSE


def email_pattern() -> str:
    """Local part, at sign, domain, and a top level of at least two letters or bars.

    A run of local characters leads to the same at sign from wherever it is entered, so
    in a long run only its first word edge is worth a try (or the end of the last match).
    Without that, a long dotted or percent-encoded run is read again from every edge.
    """
    local, domain, top = "[A-Za-z0-9._%+-]", "[A-Za-z0-9.-]+", "[A-Z|a-z]{2,}"
    ends_soon = f"(?={local}{{1,64}}+(?!{local}))"
    first_edge = rf"(?={local})(?>(?<!{local})|{ends_soon}|\G|(?<!{EDGE}{local}{{1,64}}))"
    return FLAGS + EDGE + first_edge + local + "++@" + domain + r"\." + top + EDGE


def phone_pattern(prefixes: Iterable[str] = PHONE_PREFIXES) -> str:
    sep = "[-.]?"
    arms = (
        OPEN + rf"\d{{3}}{sep}\d{{3}}{sep}\d{{4}}" + CLOSE,
        rf"\(\d{{3}}\){WS}*\d{{3}}{sep}\d{{4}}",
        rf"\+\d{{1,3}}{WS}?\d{{3}}{WS}?\d{{3}}{WS}?\d{{4}}",
        # ten bare digits are already covered by the first arm without separators
        any_of(prefixes) + r":[\d\s\x1c-\x1f\-+()]+" + EDGE,
    )
    return FLAGS + "(?:" + "|".join(arms) + ")"


def social_pattern(platforms: Iterable[str] = PLATFORM_PREFIXES) -> str:
    return FLAGS + "(?:@[A-Za-z0-9_]+|" + any_of(platforms) + f":{WS}*" + "@?[A-Za-z0-9_.]+)"


def address_pattern(
    words: Iterable[str] = STREET_WORDS, abbreviation: str = STREET_ABBREVIATION
) -> str:
    """House number, letters and blanks up to the last street word, then to the full stop."""
    street = any_of(words) + CLOSE + "|" + re.escape(abbreviation) + f"(?={WORD})"
    return FLAGS + OPEN + r"\d+" + WS + r"[A-Za-z\s\x1c-\x1f]+(?:" + street + ")[^.]*"


def url_pattern() -> str:
    return FLAGS + r"""https?://[^\s\x1c-\x1f<>"{}|\\^`\[\]]+"""


# In the order they run: a later rule sees the text the earlier ones left.
PII_RULES = (
    PiiRule("name", name_pattern(), TOKENS["name"]),
    PiiRule("email", email_pattern(), TOKENS["email"], ("@",)),
    PiiRule("phone", phone_pattern(), TOKENS["phone"], (":",), True),
    PiiRule("social", social_pattern(), TOKENS["social"], ("@", ":")),
    PiiRule("address", address_pattern(), TOKENS["address"], (), True),
    PiiRule("url", url_pattern(), TOKENS["url"], ("://",), counted=False),
)
CATEGORIES = tuple(rule.category for rule in PII_RULES)


def select_rules(
    categories: Iterable[str], rules: tuple[PiiRule, ...] = PII_RULES
) -> tuple[PiiRule, ...]:
    """Keep the named categories, in rule order.  A plural is accepted; an unknown name is an error."""
    known = {rule.category for rule in rules}
    aliases = {"addresses": "address"} | {f"{c}s": c for c in known}
    wanted = {aliases.get(c, c) for c in categories}
    unknown = sorted(wanted - known)
    if unknown:
        raise ValueError(f"no rule for {', '.join(unknown)}; known: {', '.join(sorted(known))}")
    return tuple(rule for rule in rules if rule.category in wanted)
