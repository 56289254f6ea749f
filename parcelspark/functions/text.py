"""Text cleaning as column expressions (JVM regular expressions and translate; no Python rows)."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from parcelspark.functions.flags import as_column

# Elements removed with their content, elements without content, elements that may be empty, and
# attributes dropped from the tags that stay.
REMOVED_ELEMENTS = ["style", "script", "a"]
REMOVED_VOID_ELEMENTS = ["link", "img"]
EMPTIABLE_ELEMENTS = [
    "p", "div", "span", "li", "ul", "ol", "nav", "section", "article", "header", "footer", "main", "aside", "table",
    "tbody", "thead", "tr", "td", "th", "b", "i", "u", "em", "strong", "font", "center", "blockquote", "pre", "code",
    "h1", "h2", "h3", "h4", "h5", "h6", "figure", "figcaption", "picture", "form", "label", "button", "small",
]
REMOVED_ATTRIBUTES = ["src", "href", "alt", "title", "name", "id", "class"]

HTML_REMOVALS = (
    [rf"(?is)<{tag}\b[^<>]*>.*?</{tag}\s*>" for tag in REMOVED_ELEMENTS]
    + [rf"(?is)<{tag}\b[^<>]*>" for tag in REMOVED_VOID_ELEMENTS]
)
# a text in pieces: tags (a > inside quotes does not end one), and what is between
_VALUE = r"""(?:"[^"<>]*"|'[^'<>]*'|[^\s"'<>]+)"""
HTML_PIECES = r"(?s)<[^<>]*>|[^<]+|<"
# every attribute of a tag is matched as a whole; those that stay are put back
HTML_ATTRIBUTES = (rf"""(?is)\s+(?:{'|'.join(REMOVED_ATTRIBUTES)})(?:\s*=\s*{_VALUE}|(?=[\s/>]))"""
                   rf"""|(\s+[^\s=<>"']+(?:\s*=\s*{_VALUE})?)""")
HTML_EMPTY = rf"(?is)<({'|'.join(EMPTIABLE_ELEMENTS)})(?:\s[^<>]*)?>\s*</\1\s*>"
# tags with nothing but white space between
HTML_BARE = r"(?s)(?:<[^<>]*>\s*)+"


def _letter_map() -> tuple[str, str]:
    """Accented Latin letters and their base letters, by the compatibility decomposition of Unicode."""
    accented, base = [], []
    for start, end in ((0xA0, 0x250), (0x1E00, 0x1F00)):
        for code in range(start, end):
            plain = [c for c in unicodedata.normalize("NFKD", chr(code)) if not unicodedata.combining(c)]
            if len(plain) == 1 and plain[0].isascii() and plain[0] != chr(code) and plain[0].isprintable():
                accented.append(chr(code))
                base.append(plain[0])
    return "".join(accented), "".join(base)


ACCENTED, BASE = _letter_map()

# Characters that become several letters or have no decomposition.
SPELLED_OUT = {
    "ß": "ss", "Æ": "AE", "æ": "ae", "Œ": "OE", "œ": "oe", "Ø": "O", "ø": "o", "Þ": "Th", "þ": "th", "Ð": "D",
    "ð": "d", "Ł": "L", "ł": "l", "Đ": "D", "đ": "d", "ı": "i", "–": "-", "—": "-", "‘": "'", "’": "'", "“": '"',
    "”": '"', "…": "...", "€": "EUR",
}


# Latin spelling of Greek and Cyrillic small letters; capitals and accented ones follow by rule.
GREEK = {
    "α": "a", "β": "b", "γ": "g", "δ": "d", "ε": "e", "ζ": "z", "η": "e", "θ": "th", "ι": "i", "κ": "k", "λ": "l", "μ": "m", "ν": "n",
    "ξ": "x", "ο": "o", "π": "p", "ρ": "r", "σ": "s", "ς": "s", "τ": "t", "υ": "u", "φ": "ph", "χ": "ch", "ψ": "ps", "ω": "o",
}
CYRILLIC = {
    "а": "a", "б": "b", "в": "v", "г": "g", "д": "d", "е": "e", "ж": "zh", "з": "z", "и": "i", "й": "y", "к": "k", "л": "l", "м": "m",
    "н": "n", "о": "o", "п": "p", "р": "r", "с": "s", "т": "t", "у": "u", "ф": "f", "х": "kh", "ц": "ts", "ч": "ch", "ш": "sh",
    "щ": "shch", "ъ": "'", "ы": "y", "ь": "'", "э": "e", "ю": "yu", "я": "ya", "ђ": "dj", "є": "ye", "ѕ": "dz", "і": "i", "ј": "j",
    "љ": "lj", "њ": "nj", "ћ": "c", "џ": "dz", "ґ": "g",
}
# Blocks of compatibility forms (spaces and dashes, scripts above and below the line, letterlike signs, number forms,
# arrows aside, enclosed letters, ideographic space, ligatures, full-width forms).
COMPATIBLE = [(0x2000, 0x200B), (0x2010, 0x2016), (0x202F, 0x2030), (0x2070, 0x20A0), (0x2100, 0x2150), (0x2150, 0x2190),
              (0x2460, 0x2500), (0x3000, 0x3001), (0xFB00, 0xFB07), (0xFF01, 0xFF5F)]
#: Characters beyond ASCII; of them, combining marks, soft hyphens, joiners, direction marks, byte order marks, variation selectors.
NOT_ASCII = r"[^\x00-\x7F]"
WIDTHLESS = r"[\u0300-\u036F\u00AD\u200B-\u200F\u202A-\u202E\u2060-\u2064\uFE00-\uFE0F\uFEFF]"


def _script_map() -> tuple[str, str, dict[str, str]]:
    """Characters with one ASCII letter, those letters, and the characters that take several."""
    found: dict[str, str] = {}
    letters = GREEK | CYRILLIC
    letters |= {k.upper(): v.capitalize() for k, v in letters.items() if len(k.upper()) == 1 and k != "ς"}
    for start, end in [(0xA0, 0x250), (0x370, 0x530), (0x1E00, 0x2000), *COMPATIBLE]:
        for char in map(chr, range(start, end)):
            if char in letters:
                found[char] = letters[char]
                continue
            plain = [c for c in unicodedata.normalize("NFKD", char) if not unicodedata.combining(c)]
            spelled = "".join(letters.get(c, {"\u2044": "/", "\u2010": "-"}.get(c, c)) for c in plain)
            if spelled and spelled != char and spelled.isascii() and spelled.isprintable():
                found[char] = spelled
            elif unicodedata.category(char) == "Pd":
                found[char] = "-"
    known = set(ACCENTED) | set(SPELLED_OUT)
    one = {k: v for k, v in found.items() if len(v) == 1 and k not in known}
    return "".join(one), "".join(one.values()), {k: v for k, v in found.items() if len(v) > 1 and k not in known}


ONE_LETTER, ONE_LETTER_BASE, SEVERAL_LETTERS = _script_map()


def html_stripped(c: str | Column) -> Column:
    """Drop unwanted elements, listed attributes (with and without values, any number) and empty elements at any depth."""
    text = as_column(c)
    for pattern in HTML_REMOVALS:
        text = F.regexp_replace(text, pattern, "")
    opening = lambda t: t.rlike(r"^<[A-Za-z]")
    pieces = F.transform(F.regexp_extract_all(text, F.lit(HTML_PIECES), F.lit(0)),
                         lambda t: F.when(opening(t), F.regexp_replace(t, HTML_ATTRIBUTES, "$1")).otherwise(t))
    return _without_empty(F.array_join(pieces, ""))


def _without_empty(text: Column) -> Column:
    """``text`` without empty elements. One pass drops those that hold nothing; an element that holds only such ones goes a pass later.

    All of them stand in one stretch of tags without text, so the most closing tags in such a stretch bound the passes.
    """
    def closings(stretch: Column) -> Column:
        return F.size(F.split(stretch, "</")) - 1

    # worked out once a row: a column in an array of one
    def cleaned(t: Column) -> Column:
        stretches = F.transform(F.regexp_extract_all(t, F.lit(HTML_BARE), F.lit(0)), closings)
        passes = F.coalesce(F.array_max(stretches), F.lit(0))
        turns = F.when(passes > 0, F.sequence(F.lit(1), passes)).otherwise(F.array().cast("array<int>"))
        # a pass that changes nothing is the last: what follows only hands the text on
        start = F.struct(t.alias("text"), F.lit(True).alias("more"))

        def one(state: Column, _: Column) -> Column:
            less = F.when(state["more"], F.regexp_replace(state["text"], HTML_EMPTY, "")).otherwise(state["text"])
            return F.transform(F.array(less), lambda x: F.struct(x.alias("text"), (F.length(x) < F.length(state["text"])).alias("more")))[0]

        return F.aggregate(turns, start, one, lambda s: s["text"])

    return F.transform(F.array(text), cleaned)[0]


def scrubbed(c: str | Column) -> Column:
    """Plain ASCII with single spaces.

    Latin, Greek and Cyrillic letters and compatibility forms get their Latin spelling; marks that only change another
    letter and characters without width go, and so do characters of other scripts, but where a text has nothing else each becomes
    a question mark: a text that says something never becomes empty.
    """
    text = as_column(c)
    latin = F.translate(text, ACCENTED + ONE_LETTER, BASE + ONE_LETTER_BASE)
    plain = _if_needed(_if_needed(latin, lambda t: _replaced(t, SPELLED_OUT)), _spelled)
    return F.trim(F.regexp_replace(F.when(text.rlike(NOT_ASCII), plain).otherwise(text), r"\s+", " "))


def _if_needed(text: Column, step: Callable[[Column], Column]) -> Column:
    """``step`` of the texts that are not plain ASCII yet. A column in an array of one is worked out once, though it is used twice."""
    return F.transform(F.array(text), lambda t: F.when(t.rlike(NOT_ASCII), step(t)).otherwise(t))[0]


def _replaced(text: Column, table: Mapping[str, str]) -> Column:
    for char, spelled in table.items():
        text = F.replace(text, F.lit(char), F.lit(spelled))
    return text


def _spelled(text: Column) -> Column:
    """The rarer characters that take several letters, and the fallback for the rest."""
    def without_rest(t: Column) -> Column:
        left = F.regexp_replace(t, NOT_ASCII, "")
        return F.when(left.rlike(r"\S"), left).otherwise(F.regexp_replace(t, NOT_ASCII, "?"))

    return F.transform(F.array(F.regexp_replace(_replaced(text, SEVERAL_LETTERS), WIDTHLESS, "")), without_rest)[0]


def words_of(c: str | Column) -> Column:
    """Lower-case words of letters and digits."""
    return F.filter(F.split(F.lower(as_column(c)), "[^a-z0-9]+"), lambda w: w != "")


def ngrams_of(words: Column, n: int) -> Column:
    """Runs of ``n`` words; none when there are fewer. Shifted copies are zipped, so the cost is linear."""
    length = F.size(words) - F.lit(n - 1)

    def shifted(k: int) -> Column:
        return F.slice(words, k + 1, F.greatest(length, F.lit(0)))

    runs = shifted(0)
    for k in range(1, n):
        runs = F.zip_with(runs, shifted(k), lambda a, b: F.concat_ws(" ", a, b))
    return runs
