"""How messages are seeded with fake personal data.

Values are generated, not listed: names pair two entries of the rules' name bank, and the other
kinds fill a few forms with drawn digits and words. A template is a choice of slots; every slot has
one carrier phrase per language. Some forms are ones that the redaction rules are known to miss (a
seven-digit number, an address whose number follows the street), so that recall is measured honestly.

In a form ``#`` is a drawn digit and ``{word}`` a drawn word.
"""

from __future__ import annotations

from itertools import combinations

# Language indicators, and the share of the seeding draw.
SPANISH_INDICATORS = (
    "hola", "que", "como", "estas", "gracias", "por", "para", "con", "los", "las",
)
SPANISH_AT_LEAST = 2
SEED_PERCENT = 25

# slot -> field of the recorded truth
TRUTH_FIELDS = {
    "name": "names",
    "email": "emails",
    "phone": "phones",
    "social": "socials",
    "address": "addresses",
}
# A template is two or three of the slots, in this order.
TEMPLATES = tuple(chosen for n in (2, 3) for chosen in combinations(TRUTH_FIELDS, n))
CARRIERS = {
    "en": {
        "name": "ask for ", "email": "write ", "phone": "ring ", "social": "look up ", "address": "deliver to ",
    },
    "es": {
        "name": "pregunta por ", "email": "escribe a ", "phone": "marca ", "social": "busca ", "address": "entrega en ",
    },
}
JOIN = "; "

FORMS = {
    "email": ("{word}##@example.com", "{word}.{word}@mail.example.org", "{word}_#@example.net", "{word}+list@correo.example.mx"),
    "phone": (
        "###-###-####", "(###) ###-####", "###.###.####", "##########", "+## ### ### ####",
        "Cell: ###-###-####", "###-####",
    ),
    "social": ("@{word}##", "IG: @{word}_{word}", "Snap: {word}###", "Twitter: @{word}#"),
}
ADDRESS_FORMS = {
    "en": ("## {word} Lane", "### {word} Boulevard", "# {word} Court"),
    "es": ("## {word} Plaza", "Calle {word} ###", "Avenida {word} ##"),
}
WORDS = (
    "kestrel", "juniper", "tidepool", "lantern", "quarry", "cobalt", "saffron", "bramble",
    "meridian", "thicket", "gannet", "ember",
)
