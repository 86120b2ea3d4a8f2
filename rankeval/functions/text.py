"""Column expressions for text analysis (P2-P5).  All JVM-side, no UDFs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Word-break classes of the analyser, after lower-casing (Unicode word segmentation).
#  * EXTEND  marks and format characters stay with the character before them;
#  * JOIN    connectors (underscores) join letters, digits and Katakana, and are a word alone;
#  * letters run together; a MID_LETTER or MID_BOTH or an apostrophe between two letters belongs to the word, a double
#    quote between two Hebrew letters too, and a quote after a Hebrew letter;
#  * digits run together, and with letters; a MID_NUMBER or MID_BOTH or an apostrophe between two digits belongs to them;
#  * an ideograph or Hiragana sign is a word of its own, Katakana run together, letters of the scripts in WITHOUT_SPACES
#    run together apart from other letters;
#  * an emoji with its modifiers and joined emoji, a pair of regional indicators (a flag) and a keycap are words;
#  * a word longer than 255 characters is cut every 255 characters.
MAX_TOKEN_LENGTH = 255
MID_LETTER, MID_BOTH = r":·\x{0387}\x{055F}\x{05F4}\x{2027}\x{FE13}\x{FE55}\x{FF1A}", r".'\x{2018}\x{2019}\x{2024}\x{FE52}\x{FF07}\x{FF0E}"
MID_NUMBER = r",;\x{037E}\x{0589}\x{060C}\x{060D}\x{066C}\x{07F8}\x{2044}\x{FE10}\x{FE14}\x{FE50}\x{FE54}\x{FF0C}\x{FF1B}"
WITHOUT_SPACES = ("Thai", "Lao", "Myanmar", "Khmer")
KATAKANA_MARKS = r"\x{3031}-\x{3035}\x{309B}\x{309C}\x{30A0}\x{30FC}\x{FF70}"
CIRCLED = r"\x{24B6}-\x{24C1}\x{24C3}-\x{24E9}"
# Code points with the emoji property, without digits, marks like (c) and regional indicators.
EMOJI_RANGES = """
2049 2139 2194-2199 21A9-21AA 231A-231B 2328 23CF 23E9-23F3 23F8-23FA 24C2 25AA-25AB 25B6 25C0 25FB-25FE 2600-2604 260E 2611
2614-2615 2618 261D 2620 2622-2623 2626 262A 262E-262F 2638-263A 2640 2642 2648-2653 265F-2660 2663 2665-2666 2668 267B
267E-267F 2692-2697 2699 269B-269C 26A0-26A1 26A7 26AA-26AB 26B0-26B1 26BD-26BE 26C4-26C5 26C8 26CE-26CF 26D1 26D3-26D4
26E9-26EA 26F0-26F5 26F7-26FA 26FD 2702 2705 2708-270D 270F 2712 2714 2716 271D 2721 2728 2733-2734 2744 2747 274C 274E
2753-2755 2757 2763-2764 2795-2797 27A1 27B0 27BF 2934-2935 2B05-2B07 2B1B-2B1C 2B50 2B55 3297 3299
1F004 1F0CF 1F170-1F171 1F17E-1F17F 1F18E 1F191-1F19A 1F201-1F202 1F21A 1F22F 1F232-1F23A 1F250-1F251 1F300-1F321
1F324-1F393 1F396-1F397 1F399-1F39B 1F39E-1F3F0 1F3F3-1F3F5 1F3F7-1F4FD 1F4FF-1F53D 1F549-1F54E 1F550-1F567 1F56F-1F570
1F573-1F57A 1F587 1F58A-1F58D 1F590 1F595-1F596 1F5A4-1F5A5 1F5A8 1F5B1-1F5B2 1F5BC 1F5C2-1F5C4 1F5D1-1F5D3 1F5DC-1F5DE
1F5E1 1F5E3 1F5E8 1F5EF 1F5F3 1F5FA-1F64F 1F680-1F6C5 1F6CB-1F6D2 1F6D5-1F6D9 1F6DC-1F6E5 1F6E9 1F6EB-1F6EC 1F6F0
1F6F3-1F6FC 1F7E0-1F7EB 1F7F0 1F90C-1F93A 1F93C-1F945 1F947-1F9FF 1FA70-1FA7C 1FA80-1FAC6 1FAC8 1FACC-1FADD 1FADF-1FAEB
1FAEF-1FAFA"""
EMOJI = "".join("-".join(rf"\x{{{p}}}" for p in r.split("-")) for r in EMOJI_RANGES.split())

# Possessive quantifiers keep the matcher iterative, however long a run is.
_SPACELESS = "".join(rf"\p{{Is{x}}}" for x in WITHOUT_SPACES)
_EXTEND = r"[\p{M}\p{Cf}&&[^\x{200B}]]*+"
_JOIN = rf"(?:[\p{{Pc}}\x{{202F}}]{_EXTEND})"
_LETTER = rf"(?:[\p{{L}}\p{{Nl}}{CIRCLED}&&[^\p{{IsHan}}\p{{IsHiragana}}\p{{IsKatakana}}{KATAKANA_MARKS}{_SPACELESS}]]{_EXTEND})"
_HEBREW = r"[\p{L}&&\p{IsHebrew}]"
_LETTERS = (rf"{_LETTER}(?:{_LETTER}|[{MID_LETTER}{MID_BOTH}]{_EXTEND}(?={_LETTER})"
            rf"|(?<=\p{{IsHebrew}})(?:'|\"{_EXTEND}(?={_HEBREW})))*+")
_DIGIT = rf"(?:\p{{Nd}}{_EXTEND})"
_DIGITS = rf"{_DIGIT}(?:{_DIGIT}|[{MID_NUMBER}{MID_BOTH}]{_EXTEND}(?={_DIGIT}))*+"
_KATAKANA = rf"(?:[\p{{IsKatakana}}{KATAKANA_MARKS}]{_EXTEND})++"
_WORD = rf"(?:(?:{_LETTERS}|{_DIGITS})++|{_KATAKANA})"
_ONE_EMOJI = rf"[{EMOJI}](?:[\x{{1F3FB}}-\x{{1F3FF}}]|[\p{{M}}\p{{Cf}}&&[^\x{{200B}}\x{{200D}}]])*+"
_EMOJI = (rf"(?:[0-9#*]\x{{FE0F}}?\x{{20E3}}|[\x{{1F1E6}}-\x{{1F1FF}}]{{2}}"
          rf"|{_ONE_EMOJI}(?:\x{{200D}}++{_ONE_EMOJI})*+){_EXTEND}")
_CLASSES = (rf"{_EMOJI}|[\p{{IsHan}}\p{{IsHiragana}}]{_EXTEND}|(?:[\p{{L}}&&[{_SPACELESS}]]{_EXTEND})++"
            rf"|{_JOIN}*+{_WORD}(?:{_JOIN}++{_WORD})*+{_JOIN}*+|{_JOIN}++")
# Words that the classes cut the same way, found without them: a run of plain small letters or of ASCII digits, up to the end
# or a character that neither extends nor joins it.  Everything else is left to the classes, but for the ASCII characters
# with which no word starts.
_PLAIN_LETTERS = (r"[a-z\x{DF}-\x{F6}\x{F8}-\x{24F}\x{3B1}-\x{3C9}\x{430}-\x{45F}]++"
                  r"(?=[\x{0}-&(-\-/;-@\[-\^`{-\x{7F}]|[.:'](?:[\x{0}-@\[-`{-\x{7F}]|\z)|\z)")
_PLAIN_DIGITS = r"[0-9]++(?=[\x{0}-&(-+\-/:<-@\[-\^`{-\x{7F}]|[.,;'](?:[\x{0}-/:-\x{7F}]|\z)|\z)"
_NO_START = r"(?![\x{0}-\"$-)+-/:-@\[-\^`{-\x{7F}])"
TOKEN_PATTERN = rf"({_PLAIN_LETTERS}|{_PLAIN_DIGITS}|{_NO_START}(?:{_CLASSES}))"

# Fixed values of the one-byte length norm: lengths below 24 are exact, larger
# ones keep 4 significant bits of (length - 24).
NORM_EXACT_BELOW = 24
NORM_SIGNIFICANT_BITS = 4


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tokens(text: Column | str) -> Column:
    """Lower-case, split into word tokens.  Null text yields no tokens."""
    found = F.regexp_extract_all(F.lower(F.coalesce(_col(text), F.lit(""))), F.lit(TOKEN_PATTERN), 1)
    size = F.lit(MAX_TOKEN_LENGTH)

    def cut(w: Column) -> Column:
        starts = F.sequence(F.lit(0), F.floor((F.length(w) - 1) / size).cast("int"))
        return F.transform(starts, lambda i: w.substr(i * size + 1, size))

    def whole(words: Column) -> Column:
        return F.when(F.exists(words, lambda w: F.length(w) > size), F.flatten(F.transform(words, cut))).otherwise(words)

    # named by a lambda, so that the words of a text are found once
    return F.transform(F.array(found), whole)[0]


def query_echo(token_array: Column | str, field: str = "text") -> Column:
    """The parsed-query echo ``field:t1 field:t2 ...``."""
    return F.array_join(F.transform(_col(token_array), lambda t: F.concat(F.lit(field + ":"), t)), " ")


def length_norm(dl: Column | str) -> Column:
    """P5: document length after the lossy one-byte encoding, decoded again."""
    d = _col(dl).cast("bigint")
    x = d - F.lit(NORM_EXACT_BELOW)
    shift = F.greatest(F.length(F.bin(x)) - F.lit(NORM_SIGNIFICANT_BITS), F.lit(0))
    return (
        F.when(d < NORM_EXACT_BELOW, d)
        .otherwise(F.lit(NORM_EXACT_BELOW)
                   + F.call_function("shiftleft", F.call_function("shiftright", x, shift), shift))
        .cast("int")
    )
