"""Problem 2: one consistent form for text that looks the same.

Method: for every token the script sets of its letters are resolved by intersection (augmented
as in UTS #39: Han, kana and hangul also count for the writing systems that use them). An empty
intersection is a mixed-script confusable; a token wholly of letters with doubles elsewhere is a
whole-script confusable. The token is respelled in the one script that can spell all of it;
width, compatibility, accent composition, invisible characters and spaces are normalised.

The respelling looks only at the classes of look-alikes in the token, never at which member was
typed, so two texts get one form exactly when they look equal.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

# Look-alikes, the first of a line is the Latin letter.
_LATIN = """
a а α ɑ
c с
d ԁ
e е
g ɡ
h һ հ
i і ι ı
j ј ϳ
k κ
l ӏ
n ո
o о ο օ
p р ρ
q ԛ
s ѕ
u υ ս
v ν ѵ
w ԝ
x х χ
y у γ ү
A А Α Ꭺ
B В Β Ᏼ
C С Ꮯ
D Ꭰ
E Е Ε Ꭼ
F Ϝ
G Ԍ Ꮐ
H Н Η Ꮋ
I І Ι Ӏ
J Ј Ϳ Ꭻ
K К Κ Ꮶ
L Ꮮ
M М Μ Ꮇ
N Ν
O О Ο Օ
P Р Ρ Ꮲ
Q Ԛ
S Ѕ Տ Ꮪ
T Т Τ Ꭲ
U Ս
V Ѵ Ꮩ
W Ԝ Ꮃ
X Х Χ
Y Ү Υ
Z Ζ Ꮓ
"""
# Letters of scripts and blocks that repeat Latin shapes, by line as above.
_SHAPES = """
B ꓐ Ⲃ
C ꓚ Ⲥ
D ꓓ
E ꓰ
F ꓝ
G ꓖ
H ꓧ Ⲏ
I ꓲ Ⲓ
J ꓙ
K ꓗ Ⲕ
L ꓡ Ⳑ
M ꓟ Ⲙ
N ꓠ Ⲛ
O ꓳ Ⲟ
P ꓑ Ⲣ
R ꓣ Ꭱ Ꮢ
S ꓢ
T ꓔ Ⲧ
U ꓴ
V ꓦ
W ꓪ
X ꓫ Ⲭ
Y ꓬ Ⲩ
Z ꓜ Ⲍ
A ꓮ Ⲁ
c ᴄ ⲥ
g ց
o ᴏ ⲟ
p ⲣ
s ꜱ
u ᴜ
v ᴠ
w ᴡ
x ⲭ
z ᴢ
"""
# Katakana, and the kanji, hiragana or bopomofo that looks the same.
_JAPANESE = """
ー 一
ニ 二
ハ 八
タ 夕
カ 力
ト 卜
エ 工
ロ 口
チ 千
ヘ へ
オ 才
ノ 丿
ヒ 匕
メ 乄
"""
# Marks that look the same outside words.
_MARKS = """
~ 〜 ∼ ∿ ˜ 〰
' ’ ‘ ʼ ʹ ′ ` ´ ʻ
" “ ” „ ″
- ‐ ‑ ‒ – − ⁃
· ・ ‧ ∙ ⋅ •
, ‚
: ː ꞉ ∶
! ǃ
/ ∕ ⁄
"""


def _lines(block: str) -> list[list[str]]:
    return [line.split() for line in block.strip().splitlines()]


# aug: the writing systems a Unicode script counts for
_AUG = {"Han": {"Jpan", "Kore"}, "Hiragana": {"Jpan"}, "Katakana": {"Jpan"}, "Hangul": {"Kore"}}
_PREFERENCE = ("Latin", "Jpan", "Kore", "Cyrillic", "Greek", "Armenian", "Cherokee", "Coptic", "Lisu")
_SCRIPTS = {s: regex.compile(rf"\p{{Script={s}}}") for s in ("Latin", "Han", "Hiragana", "Katakana", "Hangul", "Cyrillic", "Greek", "Armenian", "Cherokee", "Coptic", "Lisu", "Arabic", "Hebrew", "Thai", "Devanagari")}


def script(ch: str) -> str:
    if ch == "ー":
        return "Katakana"
    for name, p in _SCRIPTS.items():
        if p.match(ch):
            return name
    return "Common"


def systems(ch: str) -> frozenset[str] | None:
    """The writing systems a character belongs to; None stands for all of them."""
    s = script(ch)
    return None if s == "Common" else frozenset(_AUG.get(s, {s}))


_CLASS: dict[str, int] = {}
_MEMBERS: list[list[str]] = []
_EXTRA = {line[0]: line[1:] for line in _lines(_SHAPES)}
_KNOWN = {line[0] for line in _lines(_LATIN)}
for _line in [[*line, *_EXTRA.get(line[0], ())] for line in _lines(_LATIN)] + [line for line in _lines(_SHAPES) if line[0] not in _KNOWN] + _lines(_JAPANESE):
    _line = [c for c in _line if unicodedata.normalize("NFKC", c) == c]  # others are gone before
    for _c in _line:
        _CLASS.setdefault(_c, len(_MEMBERS))
    _MEMBERS.append(_line)
_SPELL = [{sys: m for m in reversed(ms) for sys in (systems(m) or ())} for ms in _MEMBERS]
_KANA_SPELL = [{script(m): m for m in reversed(ms)} for ms in _MEMBERS]
_LONG = _CLASS["ー"]
_MARK = {ord(m): line[0] for line in _lines(_MARKS) for m in line[1:]}
#: removed: format and control characters, selectors, fillers; spaces of any kind become one kind
_GONE = {c: None for c in range(0x110000) if unicodedata.category(chr(c)) == "Cf"}
_GONE |= {c: None for c in [*range(0x00, 0x09), *range(0x0E, 0x1C), *range(0x7F, 0x85), *range(0x86, 0xA0), 0x034F, 0x115F, 0x1160, 0x17B4, 0x17B5, *range(0x180B, 0x1810), 0x3164, *range(0xFE00, 0xFE10), 0xFFA0, *range(0xE0100, 0xE01F0)]}
_SPACE = {c: " " for c in [*range(0x09, 0x0E), *range(0x1C, 0x20), 0x85, *(c for c in range(0x110000) if unicodedata.category(chr(c)) in ("Zs", "Zl", "Zp"))]}
_FIRST = _GONE | _SPACE
_FIRST.pop(0x20, None)
_TOKEN = regex.compile(r"[\p{L}\p{M}]+")
#: a look-alike, alone or composed with accents or voicing marks
_DOUBLES = [c for c in map(chr, range(0x80, 0xFFFF)) if not unicodedata.category(c).startswith("C") and (d := unicodedata.normalize("NFD", c)[0]) in _CLASS and not d.isascii()]
_SUSPECT = regex.compile("[" + "".join(regex.escape(c) for c in {*_DOUBLES, *(c for c in _CLASS if not c.isascii())}) + "]")
_ASCII_LETTER = regex.compile(r"[A-Za-z]")
_OTHER_LETTER = regex.compile(r"[^\P{L}\p{Latin}]")
_MARK_SUSPECT = regex.compile("[" + "".join(regex.escape(chr(c)) for c in _MARK) + "]")


def resolve(token: str) -> tuple[frozenset[str], bool]:
    """The writing systems that all letters of a token share as typed, and whether it is mixed."""
    common: frozenset[str] | None = None
    for ch in token:
        s = systems(ch)
        if s is not None:
            common = s if common is None else common & s
    return common or frozenset(), common is not None and not common


def _doubtful(t: str) -> bool:
    """Whether a letter of the text may stand for another: a look-alike from outside ASCII, or one
    inside it beside letters of another script."""
    return bool(_SUSPECT.search(t) or (_ASCII_LETTER.search(t) and _OTHER_LETTER.search(t)))


def _respell(token: str) -> str:
    classes = [_CLASS.get(c) for c in token]
    able: frozenset[str] | None = None
    for ch, k in zip(token, classes):
        s = systems(ch) if k is None else frozenset(_SPELL[k])
        if s is not None:
            able = s if able is None else able & s
    # in a mixed token that no one script can spell each look-alike takes the first that it can
    target = next((s for s in _PREFERENCE if s in able), None) if able else None
    order = [target] if target else list(_PREFERENCE)
    def sure_script(j: int) -> str | None:
        """The script of a letter that has no double, or that a voicing mark proves to be kana."""
        if classes[j] is None:
            s = script(token[j])
            return s if s in ("Han", "Hiragana", "Katakana") else None
        voiced = j + 1 < len(token) and token[j + 1] in "\u3099\u309a"
        return "Katakana" if voiced and "Hiragana" not in _KANA_SPELL[classes[j]] else None

    # the nearest sure letter on either side, in two passes, so a long token costs its length
    n = len(token)
    before: list[tuple[int, str | None]] = [(n + 1, None)] * n
    after_: list[tuple[int, str | None]] = [(n + 1, None)] * n
    if "Jpan" in order:
        for side, steps in ((before, range(n)), (after_, range(n - 1, -1, -1))):
            last: tuple[int, str | None] = (-2 * n, None)
            for j in steps:
                if (found := sure_script(j)) is not None:
                    last = (j, found)
                side[j] = (abs(j - last[0]), last[1])
    out = []
    for i, (ch, k) in enumerate(zip(token, classes)):
        if k is None:
            out.append(ch)
            continue
        sys = next((s for s in order if s in _SPELL[k]), None)
        if sys != "Jpan":
            out.append(_SPELL[k][sys] if sys else _MEMBERS[k][0])
            continue
        # within Japanese: the script of the nearest letter that has no double, left before right
        near = min(before[i], after_[i], key=lambda x: x[0])[1]
        if k == _LONG:  # the long mark follows kana and is not followed by kanji, the numeral is else
            after = i + 1 < len(token) and sure_script(i + 1) == "Han"
            near = "Katakana" if i and script(out[-1]) in ("Hiragana", "Katakana") and not after else "Han"
        order_in = {"Katakana": ("Katakana",), "Hiragana": ("Hiragana", "Han")}.get(near, ("Han", "Hiragana"))
        out.append(next((_KANA_SPELL[k][s] for s in order_in if s in _KANA_SPELL[k]), _MEMBERS[k][0]))
    return "".join(out)


def canonical(text: str | None) -> str | None:
    """The one form of a text. Null stays null; a text of invisible characters becomes empty."""
    if text is None:
        return None
    if text.isascii() and text.isprintable():
        return text if not ("`" in text) else text.replace("`", "'")
    t = unicodedata.normalize("NFKC", text.translate(_FIRST)).translate(_FIRST)
    if _doubtful(t):
        t = unicodedata.normalize("NFD", t)
        t = _TOKEN.sub(lambda m: _respell(m[0]) if _doubtful(m[0]) else m[0], t)
    if _MARK_SUSPECT.search(t):
        t = t.translate(_MARK)
    return unicodedata.normalize("NFC", t)


def canonical_series(texts: pd.Series) -> pd.Series:
    return pd.Series([canonical(t) for t in texts], index=texts.index, dtype=object)


@F.pandas_udf(StringType())
def canonical_udf(texts: pd.Series) -> pd.Series:
    return canonical_series(texts)


def whole_script(token: str) -> bool:
    """Whether a token of one script could be typed wholly in another too: each of its letters has a
    double, and some writing system that it is not written in can spell all of them."""
    classes = [_CLASS.get(c) for c in token if script(c) != "Common"]
    typed, mixed = resolve(token)
    if mixed or not typed or None in classes:
        return False
    able = frozenset.intersection(*(frozenset(_SPELL[k]) for k in classes))
    return bool(able - typed)


def _script_report(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for texts in batches:
        tokens = [() if t is None else _TOKEN.findall(unicodedata.normalize("NFKC", t)) for t in texts]
        yield pd.DataFrame({"mixed_tokens": [sum(resolve(m)[1] for m in own) for own in tokens], "whole_script_tokens": [sum(whole_script(m) for m in own) for own in tokens]}, index=texts.index)


script_report_udf = F.pandas_udf(_script_report, StructType([StructField("mixed_tokens", IntegerType()), StructField("whole_script_tokens", IntegerType())]))


def with_canonical(df: DataFrame, text: str = "transcript", out: str = "canonical") -> DataFrame:
    """``df`` plus the canonical form of one column. Map-only: no shuffle, one Arrow pass (declared
    nondeterministic, else a filter on the form would compute it a second time)."""
    return df.withColumn(out, canonical_udf.asNondeterministic()(F.col(text)))


def bbox(polygon: Column) -> list[Column]:
    """x1, y1, x2, y2 of a polygon; all null for a null or empty one."""
    xs, ys = F.transform(polygon, lambda p: p["x"]), F.transform(polygon, lambda p: p["y"])
    return [F.array_min(xs).alias("x1"), F.array_min(ys).alias("y1"), F.array_max(xs).alias("x2"), F.array_max(ys).alias("y2")]


def iou(a: str, b: str) -> Column:
    c = lambda t, k: F.col(f"{t}.{k}")
    w = F.greatest(F.lit(0.0), F.least(c(a, "x2"), c(b, "x2")) - F.greatest(c(a, "x1"), c(b, "x1")))
    h = F.greatest(F.lit(0.0), F.least(c(a, "y2"), c(b, "y2")) - F.greatest(c(a, "y1"), c(b, "y1")))
    area = lambda t: (c(t, "x2") - c(t, "x1")) * (c(t, "y2") - c(t, "y1"))
    union = area(a) + area(b) - w * h
    return F.when(union > 0, w * h / union).otherwise(0.0)


#: Side of the grid cells of a page, in pixels.
CELL = 256.0


def same_look_lines(preds: DataFrame, gold: DataFrame, min_iou: float = 0.5) -> DataFrame:
    """(pred_ord, gold_ord): lines at one place whose stored texts differ but look the same.

    The canonical form and the place are part of the join key, so a page with very many lines, or
    one text on a third of them, yields only pairs of equal look that lie near each other. Boxes
    that share half of their union share more than half of each side, so the centre of one is
    inside the other: a prediction stands in the grid cell of its centre, a gold line in every cell
    it touches, and each pair meets in one cell. Below 0.5 the page is one cell. Null image paths,
    transcripts or polygons match nothing; repeated rows each give their pairs.
    """

    def side(df: DataFrame) -> DataFrame:
        rows = df.where("image_path is not null and transcript is not null").select("image_path", "ord", "transcript", *bbox(F.col("polygon"))).where("x1 is not null")
        return with_canonical(rows)

    cell = lambda v: F.floor(v / CELL) if min_iou >= 0.5 else F.lit(0).cast("bigint")
    look = F.xxhash64("image_path", "canonical", "cx", "cy").alias("look")
    p = side(preds.join(gold.select("image_path").distinct(), "image_path", "left_semi"))
    p = p.withColumn("cx", cell((F.col("x1") + F.col("x2")) / 2)).withColumn("cy", cell((F.col("y1") + F.col("y2")) / 2))
    g = side(gold).withColumn("cx", F.explode(F.sequence(cell(F.col("x1")), cell(F.col("x2"))))).withColumn("cy", F.explode(F.sequence(cell(F.col("y1")), cell(F.col("y2")))))
    p, g = p.select("*", look).alias("p"), g.select("*", look).alias("g")
    same = [F.col(f"p.{c}") == F.col(f"g.{c}") for c in ("look", "canonical", "image_path", "cx", "cy")]
    return (
        p.join(g, same)
        .where((F.col("p.transcript") != F.col("g.transcript")) & (iou("p", "g") >= min_iou))
        .select(F.col("p.ord").alias("pred_ord"), F.col("g.ord").alias("gold_ord"))
    )
