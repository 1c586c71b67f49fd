"""Text expressions. All are native Column expressions, so they stay inside code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The 29 characters that count as white space, which are more than ``trim`` knows.
WHITE_SPACE = "".join(map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x20), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


def strip(c: Column) -> Column:
    """Without outer white space of any kind; much cheaper than a regular expression."""
    return F.btrim(c, F.lit(WHITE_SPACE))


def non_blank(c: Column) -> Column:
    """Stripped text, or null if nothing is left."""
    return F.nullif(strip(c), F.lit(""))


def normalize(c: Column) -> Column:
    """Runs of white space become one space, none is left at the ends; null stays null."""
    return F.trim(F.regexp_replace(c, r"(?U)[\s\x1c-\x1f]+", " "))


def words(c: Column) -> Column:
    """The words of a text; no words for a blank one."""
    return F.filter(F.split(normalize(c), " "), lambda w: w != "")


def char_count(c: Column) -> Column:
    return F.char_length(normalize(c))


def word_count(c: Column) -> Column:
    return F.size(words(c))


def char_edits(a: Column, b: Column) -> Column:
    """Levenshtein distance over code points of the normalized texts."""
    return F.levenshtein(normalize(a), normalize(b))


def word_edits(a: Column, b: Column) -> Column:
    """Levenshtein distance over words: each distinct word of the pair becomes one character.

    Exact below 55,000 distinct words a pair (the private range begins at U+0100 and jumps over the
    surrogates), native, so it stays inside code generation."""
    vocabulary = F.array_distinct(F.concat(words(a), words(b)))

    def code(w: Column, v: Column) -> Column:
        k = F.array_position(v, w) + 255
        point = F.when(k >= 0xD800, k + 0x800).otherwise(k)
        return F.decode(F.unhex(F.lpad(F.hex(point), 4, "0")), "UTF-16BE")

    def of(pair: Column) -> Column:
        spell = lambda ws: F.array_join(F.transform(ws, lambda w: code(w, pair["v"])), "")
        return F.levenshtein(spell(pair["a"]), spell(pair["b"]))

    bound = F.array(F.struct(vocabulary.alias("v"), words(a).alias("a"), words(b).alias("b")))
    return F.get(F.transform(bound, of), F.lit(0))


def ratio(a: Column, b: Column) -> Column:
    """a / b, and 0.0 where b is 0."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def infer_lang(c: Column, default: str = "mixed") -> Column:
    """ko, ja, latin or mixed by the scripts that occur; null for null. A default other than mixed is
    taken as it is, without looking."""
    if default != "mixed":
        return F.when(c.isNotNull(), default)
    has = {"hangul": "[\\uAC00-\\uD7AF]", "kana": "[\\u3040-\\u30FF]", "han": "[\\u4E00-\\u9FFF]", "latin": "[A-Za-z]"}
    hit = {k: c.rlike(v) for k, v in has.items()}
    return (
        F.when(c.isNull(), F.lit(None).cast("string"))
        .when(hit["kana"], "ja")
        .when(hit["hangul"], "ko")
        .when(hit["han"], "ja")
        .when(hit["latin"], "latin")
        .otherwise("mixed")
    )


def script_confidence(c: Column, default: str = "mixed") -> Column:
    return F.when(strip(c) == "", 0.0).when(infer_lang(c, default) == "mixed", 0.85).otherwise(0.95)


def join_tokens(tokens: Column, spaces: bool = True) -> Column:
    """Stripped, non-empty tokens in order, with one space between them or none."""
    clean = F.filter(F.transform(tokens, strip), lambda t: t != "")
    return F.array_join(clean, " " if spaces else "")


def lenient_double(c: Column, default: float = 0.0) -> Column:
    return F.coalesce(strip(c).try_cast("double"), F.lit(default))


def lenient_int(c: Column, default: int = 0) -> Column:
    """A number as text, cut to an integer; the default where it is none."""
    return F.coalesce(strip(c).try_cast("double").try_cast("int"), F.lit(default))


def quote_path(c: Column) -> Column:
    """Percent-encoding of a path: everything but unreserved characters and the slash."""
    q = F.url_encode(c)
    for a, b in (("+", "%20"), ("%2F", "/"), ("%7E", "~"), ("*", "%2A")):
        q = F.replace(q, F.lit(a), F.lit(b))
    return q
