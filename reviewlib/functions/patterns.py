"""Regular expressions and the other values that decide results.

Whitespace is the Unicode set plus the four ASCII separators, word characters are letters,
numbers and ``_`` of any script, digits are ASCII. Use patterns through :func:`unicode`.
"""

from __future__ import annotations

from dataclasses import dataclass

# The characters that count as whitespace. WS goes inside brackets; with the
# (?U) flag \s is Unicode, and several times faster than the spelled-out set.
WS = r"\s\x1c\x1d\x1e\x1f"
WS_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def unicode(pattern: str, flags: str = "") -> str:
    return f"(?U{flags}){pattern}"


SPACES = f"[{WS}]+"
WORD = r"[\p{L}\p{N}_]"

# Emoji and pictograph blocks that are removed from messages.
EMOJI = (
    r"[\x{1F300}-\x{1F5FF}"  # symbols and pictographs
    r"\x{1F600}-\x{1F64F}"  # emoticons
    r"\x{1F680}-\x{1F6FF}"  # transport and maps
    r"\x{1F700}-\x{1F77F}"  # alchemical
    r"\x{1F780}-\x{1F7FF}"  # geometric shapes, extended
    r"\x{1F800}-\x{1F8FF}"  # arrows, supplement C
    r"\x{1F900}-\x{1F9FF}"  # symbols and pictographs, supplement
    r"\x{1FA00}-\x{1FA6F}"  # chess
    r"\x{1FA70}-\x{1FAFF}"  # symbols and pictographs, extended A
    r"\x{2700}-\x{27BF}"  # dingbats
    r"\x{2600}-\x{26FF}"  # miscellaneous symbols
    r"\x{2B00}-\x{2BFF}"  # miscellaneous arrows
    r"\x{FE0F}"  # variation selector 16
    r"\x{1F1E6}-\x{1F1FF}]"  # regional indicators (flags)
)

# Ratings. In a dump the 5 must end a word, in a message it need not.
DUMP_RATING = r"([0-9]+(?:[.,][0-9]+)?) */ *5\b"
MESSAGE_RATING = rf"([0-9]+(?:[.,][0-9]+)?)[{WS}]*/[{WS}]*5"
FIRST_NUMBER = r"([0-9]+(?:[.,][0-9]+)?)"
NUMERIC = (
    rf"^[{WS}]*[+-]?(?:(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:e[+-]?[0-9]+)?|inf|infinity)[{WS}]*\z"
)

# Message clean-up. The block of sub-ratings goes only when it is on the
# last line of the message.
SUBRATING_BLOCK = (
    rf"Comida:[{WS}]*[0-9]+(?:[.,][0-9]+)?[{WS}]*/[{WS}]*5[^\n]*\n?\z"
)
WEB_URL = rf"https?://[^{WS}]+"
ANY_URL = rf"http[^{WS}]+"
HAS_URL = r"https?://"
MENTION = rf"@{WORD}+"
HASHTAG = r"#[\p{L}\p{N}_-]+"

# Every emoji lies in here; looking at this one range first is faster.
EMOJI_RANGE = r"[\x{2600}-\x{10FFFF}]"

# Text made only of these characters is its own NFKC form.
NFKC_STABLE = (
    r"\x{00}-\x{9F}\x{A1}-\x{A7}\x{A9}\x{AB}-\x{AE}\x{B0}\x{B1}\x{B6}\x{B7}\x{BB}"
    r"\x{BF}-\x{131}"
)

# What the text vectoriser strips, and its two reserved ids.
PUNCTUATION = r"""[!"#$%&()*+,\-./:;<=>?@\[\\\]^_`{|}~']"""
PAD_ID, UNKNOWN_ID = 0, 1

# Classes in id order.
LABELS = ("negative", "neutral", "positive")

# The columns of a review table.
REVIEW_COLUMNS = ("name", "rating", "number_of_photos", "message")

# Cell texts a CSV reader takes for a missing value.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def owner_reply(owner: str) -> str:
    """Pattern for an owner's reply: ``<owner> (proprietário)`` to the end of the line.

    ``owner`` is itself a pattern.
    """
    return rf"{owner}[{WS}]*\(proprietário\)[^\n]*"


@dataclass(frozen=True)
class DumpFormat:
    """How a raw dump is read and its table written: encoding, header pattern, noise to drop,
    separator of the table. Comments in a dump are always separated by ``|``.

    A header is an author's name and what tells it from other text. ``header`` matches the
    latter, blanks before it included; it has two groups, number of reviews and number of
    photos, and must not match a ``|``. The name is what stands before it (at least one
    character) since the last line end, separator or header. Patterns ignore case.
    """

    # Header and noise of the dumps this reads by default.
    header: str = (
        rf"[{WS}]+(?:Local Guide·[{WS}]*)?"
        rf"([0-9]+)[{WS}]+avaliaç(?:ões|ão)"
        rf"(?:·([0-9]+)[{WS}]+fotos)?"
    )
    noise: tuple[str, ...] = (
        r"Passe o cursor para reagir",
        owner_reply(rf"Ofner[{WS}]*-[{WS}]*Perdizes"),
    )
    csv_separator: str = "|"
    encoding: str = "UTF-8"

    @property
    def header_regex(self) -> str:
        """``header`` where a name can precede it: not where the last match ended, and not
        after a line end or separator. Looking for this part finds the headers that looking
        for names would find, without trying every character as the start of a name."""
        return unicode(rf"(?<=[^|\n])(?!\G)(?:{self.header})", "i")
