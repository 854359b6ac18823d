"""Text expressions. Everything here stays inside the JVM."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LEVEL_SEPARATOR = " | "

# ASCII spellings of characters that Unicode does not decompose.
ASCII_SPELLINGS = {
    "ß": "ss", "ẞ": "SS", "æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE",
    "ø": "o", "Ø": "O", "ł": "l", "Ł": "L", "đ": "d", "Đ": "D",
    "ð": "d", "Ð": "D", "þ": "th", "Þ": "Th", "ħ": "h", "Ħ": "H",
    "ı": "i", "ŋ": "ng", "Ŋ": "NG", "ŧ": "t", "Ŧ": "T", "ĸ": "k",
    "«": "<<", "»": ">>", "‹": "<", "›": ">", "‘": "'", "’": "'",
    "‚": ",", "‛": "'", "“": '"', "”": '"', "„": ",,", "‐": "-",
    "‑": "-", "‒": "-", "–": "-", "—": "--", "―": "--", "†": "+",
    "•": "*", "⁄": "/", "€": "EUR", "×": "x", "÷": "/", "¿": "?",
    "¡": "!", "°": "deg", "©": "(c)", "®": "(r)", "·": "*",
    "\u2028": "\n", "\u2029": "\n",
    "£": "GBP", "¥": "JPY", "¢": "c", "§": "SS", "¶": "P", "±": "+-", "¬": "!", "¦": "|", "¤": "$",
    # Greek
    "α": "a", "β": "b", "γ": "g", "δ": "d", "ε": "e", "ζ": "z", "η": "e", "θ": "th", "ι": "i", "κ": "k",
    "λ": "l", "μ": "m", "ν": "n", "ξ": "x", "ο": "o", "π": "p", "ρ": "r", "ς": "s", "σ": "s", "τ": "t",
    "υ": "u", "φ": "ph", "χ": "kh", "ψ": "ps", "ω": "o",
    # Cyrillic
    "а": "a", "б": "b", "в": "v", "г": "g", "д": "d", "е": "e", "ж": "zh", "з": "z", "и": "i", "й": "i",
    "к": "k", "л": "l", "м": "m", "н": "n", "о": "o", "п": "p", "р": "r", "с": "s", "т": "t", "у": "u",
    "ф": "f", "х": "kh", "ц": "ts", "ч": "ch", "ш": "sh", "щ": "shch", "ъ": "'", "ы": "y", "ь": "'",
    "э": "e", "ю": "iu", "я": "ia", "ё": "io", "є": "ie", "і": "i", "ї": "yi", "ґ": "g", "ђ": "dj",
    "ј": "j", "љ": "lj", "њ": "nj", "ћ": "c", "ќ": "k", "ў": "u", "џ": "dz", "ѓ": "gj", "ѕ": "dz",
}
# Capitals of the letters above are spelled alike with a capital first letter.
ASCII_SPELLINGS.update({k.upper(): v.capitalize() for k, v in list(ASCII_SPELLINGS.items())
                        if k.islower() and k.upper() not in ASCII_SPELLINGS and len(k.upper()) == 1})

# Code-point ranges covered by the transliteration table.
LATIN_RANGES = (
    (0x00A0, 0x024F),  # Latin-1 supplement, extended A and B
    (0x0300, 0x036F),  # combining marks
    (0x1E00, 0x1EFF),  # extended additional
    (0x2000, 0x20BF),  # punctuation, super- and subscripts, currency
    (0x2100, 0x218F),  # letter-like forms, fractions, Roman numerals
    (0x2460, 0x24FF),  # enclosed alphanumerics
    (0x0370, 0x03FF),  # Greek
    (0x0400, 0x04FF),  # Cyrillic
    (0x1F00, 0x1FFF),  # Greek extended
    (0x2190, 0x245F),  # symbols
    (0x3000, 0x303F),
    (0x3130, 0x33FF),  # compatibility letters, enclosed and squared forms
    (0xF900, 0xFAFF),  # compatibility ideographs
    (0xFB00, 0xFDFF),  # ligatures and presentation forms
    (0xFE10, 0xFE6F),  # small and vertical forms
    (0xFE70, 0xFEFC),
    (0xFF01, 0xFFEE),  # half- and full-width forms
)


def _ascii_form(char: str) -> str | None:
    """ASCII spelling, else the compatibility form if it differs, else None."""
    out = []
    whole = unicodedata.normalize("NFKC", char)
    for c in whole:
        if c in ASCII_SPELLINGS:
            out.append(ASCII_SPELLINGS[c])
            continue
        for d in unicodedata.normalize("NFKD", c):
            if not unicodedata.combining(d):
                out.append(ASCII_SPELLINGS.get(d, d))
    text = "".join(out)
    if text.isascii():
        return text
    return whole if whole != char else None


@lru_cache(maxsize=1)
def transliteration() -> tuple[str, str, dict[str, str]]:
    """(from, to, expansions): one-to-one characters, then one-to-many ones.

    Characters past the end of *to* are deleted, which is what ``translate``
    does with them and what combining marks need.
    """
    single, deleted, expanded = {}, [], {}
    for low, high in LATIN_RANGES:
        for code in range(low, high + 1):
            char = chr(code)
            form = _ascii_form(char)
            if form is None:
                continue
            if len(form) == 1:
                single[char] = form
            elif form == "":
                deleted.append(char)
            else:
                expanded[char] = form
    return "".join(single) + "".join(deleted), "".join(single.values()), expanded


def _is_ascii(col: Column) -> Column:
    return F.octet_length(col) == F.char_length(col)


_COVERED = "".join(f"\\u{low:04X}-\\u{high:04X}" for low, high in LATIN_RANGES)


def _spelling(char: Column) -> Column:
    """ASCII form of a one-character string."""
    source, target, expanded = transliteration()
    listed = F.lit("\x00" + "\x00".join(k + v for k, v in expanded.items()))
    longer = F.split_part(F.split_part(listed, F.concat(F.lit("\x00"), char), F.lit(2)), F.lit("\x00"), F.lit(1))
    short = F.translate(char, source, target)
    return F.when(short != char, short).when(longer != "", longer).otherwise(char)


def _to_ascii(col: Column) -> Column:
    """Replace each distinct covered character of the text in one pass per character.

    A text holds few distinct accented characters, and a byte-wise replace is
    far cheaper than looking up every character.
    """
    special = F.array_distinct(F.split(F.regexp_replace(col, rf"[\x00-\x7F]+|[^{_COVERED}]", ""), ""))
    return F.aggregate(F.filter(special, lambda c: c != ""), col, lambda acc, c: F.replace(acc, c, _spelling(c)))


def normalize_text(col: Column | str, on_null: str = "keep") -> Column:
    """Compatibility-normalised, accent-free, lower-cased text.

    ``on_null``: ``keep`` passes null on, ``empty`` yields ``""``, ``fail``
    raises at run time. ASCII rows skip the transliteration entirely. Latin,
    Greek and Cyrillic letters and common symbols become ASCII; other characters take their compatibility form.
    """
    c = F.col(col) if isinstance(col, str) else col
    out = F.lower(F.when(_is_ascii(c), c).otherwise(_to_ascii(c)))
    if on_null == "empty":
        return F.coalesce(out, F.lit(""))
    if on_null == "fail":
        return F.when(c.isNull(), F.raise_error(F.lit("text to normalise is null"))).otherwise(out)
    if on_null != "keep":
        raise ValueError(f"unknown null policy {on_null!r}")
    return out


def normalize_table(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Normalise every string cell (and every element of string arrays)."""
    out = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if field.name not in keep and isinstance(field.dataType, T.StringType):
            c = normalize_text(c)
        elif (field.name not in keep and isinstance(field.dataType, T.ArrayType)
              and isinstance(field.dataType.elementType, T.StringType)):
            c = F.transform(c, lambda x: normalize_text(x))
        out.append(c.alias(field.name))
    return df.select(*out)


def hierarchy_label(levels: Column | str | list, mode: str = "joined") -> Column:
    """One label per row from its hierarchy levels.

    ``joined`` keeps non-blank levels, ``joined_all`` renders every cell (nulls
    as ``nan``), ``first`` takes the first level only.
    """
    if isinstance(levels, (list, tuple)):
        arr = F.array(*[F.col(c) if isinstance(c, str) else c for c in levels])
    else:
        arr = F.col(levels) if isinstance(levels, str) else levels
    if mode == "joined":
        return F.array_join(F.filter(arr, lambda x: strip(x) != ""), LEVEL_SEPARATOR)
    if mode == "joined_all":
        return F.array_join(F.transform(arr, lambda x: F.coalesce(x, F.lit("nan"))), LEVEL_SEPARATOR)
    if mode == "first":
        return F.get(arr, F.lit(0))
    raise ValueError(f"unknown label mode {mode!r}")


# White space of normalised text, besides the blank, and of any text.
ASCII_SPACE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f"
ANY_SPACE = ASCII_SPACE + "\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(
    chr(c) for c in range(0x2000, 0x200B))


def strip(col: Column) -> Column:
    """Trim any white space, not only blanks."""
    return F.btrim(col, F.lit(" " + ANY_SPACE))


def blanks(col: Column, space: str = ASCII_SPACE) -> Column:
    """White space turned into blanks, by byte-wise replaces."""
    for char in space:
        col = F.replace(col, F.lit(char), F.lit(" "))
    return col


def words(col: Column, space: str = ASCII_SPACE) -> Column:
    """White-space separated tokens, without empty ones.

    Splitting on one literal character avoids a regular expression per text.
    """
    return F.array_remove(F.split(blanks(col, space), " "), "")


def capitalize(col: Column) -> Column:
    return F.concat(F.upper(F.substring(col, 1, 1)), F.lower(F.substring(col, 2, 2147483647)))


def let(value: Column, body) -> Column:
    """Evaluate *value* once and hand it to *body*.

    *body* must not use a variable of an enclosing lambda: Spark does not
    extract Python UDFs whose input captures one.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def pin(col: Column) -> Column:
    """Compute *col* where it is defined.

    Catalyst inlines a column into filters and lambdas that use it, which for
    an array per text would mean once per element. It leaves alone whatever it
    cannot prove deterministic.
    """
    return F.when(F.monotonically_increasing_id() >= 0, col)


def char_overlap(a: Column | str, b: Column | str) -> Column:
    """Shared characters over all characters (sets); two empty strings give 0."""
    def chars(c):
        c = F.col(c) if isinstance(c, str) else c
        return F.array_distinct(F.filter(F.split(c, ""), lambda x: x != ""))
    both, either = F.array_intersect(chars(a), chars(b)), F.array_union(chars(a), chars(b))
    return F.size(both) / F.greatest(F.size(either), F.lit(1))


def sheet_key(col: Column | str, fallback: Column | str | None = None) -> Column:
    """Sheet-safe key: 31 characters, letters, digits, blanks and ``_``, trimmed."""
    c = F.col(col) if isinstance(col, str) else col
    key = strip(F.regexp_replace(F.substring(c, 1, 31), r"[^\p{L}\p{N} _]", ""))
    if fallback is None:
        return key
    fb = F.lit(fallback) if isinstance(fallback, str) else fallback
    return F.when(F.coalesce(key, F.lit("")) == "", fb).otherwise(key)


def contains_any(col: Column, terms) -> Column:
    out = F.lit(False)
    for term in terms:
        out = out | F.contains(col, F.lit(term))
    return out
