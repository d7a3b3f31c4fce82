"""Visually identical text with different characters: script-aware repair.

Two layers.

* Form: compatibility ideographs, radicals, full-width letters and digits, decomposed
  accents, invisible characters and odd spaces have one ordinary form each; this needs
  no context. Full-width brackets and other punctuation stay.
* Look-alikes, only in tokens of more than one script: a token is a maximal run of
  alphabetic letters and digits, or of Han, kana and the like. Its dominant script is the
  one with most letters that no other script has a double of; where no letter tells, the
  word that is most usual in the corpus decides, then the number of letters. The doubles
  of other scripts are put into the dominant script, whichever that is, if the result (the
  whole word, or the Han neighbours of the sign) occurs in the corpus vocabulary. Words of
  one script stay, also where all their letters have doubles.

Values that consist of ordinary characters only are recognised in the JVM by one
regular expression; Python sees the distinct rest. The vocabulary, one for all columns, is
never gathered: only the entries that some suspicious token needs are looked up by a join.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from bondlake.operators.cut import cut

# Letters that look like a Latin letter (Unicode confusables).
LATIN_LIKE = {
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "У": "Y", "Х": "X", "І": "I", "Ј": "J", "Ѕ": "S", "Ү": "Y", "Ԍ": "G", "Ԛ": "Q", "Ԝ": "W", "З": "3",
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "һ": "h", "ԁ": "d", "ԛ": "q", "ԝ": "w", "ѵ": "v", "ӏ": "l", "ɡ": "g", "ո": "n", "ս": "u",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X",
    "ο": "o", "ν": "v", "ρ": "p", "α": "a", "ι": "i", "κ": "k", "υ": "u", "χ": "x", "γ": "y", "ϲ": "c", "ϳ": "j", "ı": "i", "ⅼ": "l",
}
# Signs that look like a Han character.
HAN_LIKE = {"ー": "一", "㆒": "一", "ㄧ": "一", "ㅡ": "一", "ニ": "二", "ハ": "八", "ロ": "口", "エ": "工", "カ": "力", "タ": "夕", "ト": "卜", "ミ": "三", "ヒ": "匕", "丶": "、", "ㄨ": "乂", "ノ": "丿", "ナ": "十", "メ": "乄", "オ": "才", "チ": "千", "セ": "七"}


# Mathematical signs that look like a Greek letter.
GREEK_LIKE = {"∆": "Δ", "∑": "Σ", "∏": "Π", "µ": "μ", "Ω": "Ω"}


@lru_cache
def folds() -> dict[str, str]:
    """Single characters whose compatibility form is one ordinary letter, digit or Han character."""
    spans = [(0x2E80, 0x2FE0), (0xF900, 0xFB00), (0x2F800, 0x2FA20), (0xFF10, 0xFF1A), (0xFF21, 0xFF3B), (0xFF41, 0xFF5B), (0xFF66, 0xFFA0), (0x2460, 0x2460), (0x1D400, 0x1D800), (0x3192, 0x31A0)]
    out = dict(GREEK_LIKE)
    for a, b in spans:
        for o in range(a, b):
            n = unicodedata.normalize("NFKC", chr(o))
            if n != chr(o) and len(n) == 1:
                out[chr(o)] = n
    return out


@lru_cache
def _form_table() -> dict[int, str | None]:
    table: dict[int, str | None] = {ord(k): v for k, v in folds().items()}
    for o in range(sys.maxunicode + 1):
        kind = unicodedata.category(chr(o)) if o < 0xE000 or o in (0xFEFF,) or 0xFE00 <= o <= 0xFE0F or 0xFFF0 <= o < 0xFFFC or 0xE0000 <= o < 0xE0200 else ""
        if kind in ("Cf", "Cc") and chr(o) not in "\t\n\r\x0b\x0c" or 0xFE00 <= o <= 0xFE0F or 0xE0100 <= o < 0xE01F0 or o in (0x115F, 0x1160, 0x3164, 0xFFA0, 0x034F, 0x17B4, 0x17B5):
            table[o] = None
        elif kind in ("Zs", "Zl", "Zp") or chr(o) in "\t\n\r\x0b\x0c":
            table[o] = " "
    return table


_HAN = r"〇㐀-䶿一-鿿\U00020000-\U0002ffff"
_WIDE = rf"{_HAN}、-〆〈-〿＀-￯"
_AROUND = re.compile(rf"(?<=[{_WIDE}]) | (?=[{_WIDE}])")


def form(text: str) -> str:
    """The context-free layer: ordinary characters, composed accents, single spaces between words."""
    t = unicodedata.normalize("NFC", text.translate(_form_table()))
    t = re.sub(" {2,}", " ", t).strip(" ")
    return _AROUND.sub("", t)


_ALPHA = re.compile(r"[0-9A-Za-zª-ɏɐ-ʯͰ-ϿЀ-ԯԱ-ևḀ-῿Ⅰ-ↈ]+")
_OTHER = "぀-ヿ㄀-ㄯ㄰-㆏㆐-㆟"  # kana, bopomofo, jamo
_HANRUN = re.compile(rf"[{_HAN}{_OTHER}]+")
_ODD = re.compile(rf"[{_OTHER}]")
_HAN_DOUBLES = frozenset(HAN_LIKE.values())
DIGIT_LIKE = {"O": "0", "o": "0", "l": "1", "I": "1"}  # Fixed values: Latin letters that look like a digit.


@lru_cache(maxsize=4096)
def script(ch: str) -> str:
    """The script of a letter, by its name in the character database; empty for anything else."""
    return unicodedata.name(ch, " ").split(" ")[0].split("-")[0] if ch.isalpha() else "DIGIT" if ch.isdigit() else ""


@lru_cache
def doubles() -> dict[str, dict[str, str]]:
    """Script -> letter of any other script -> its double in that script."""
    same: dict[str, list[str]] = {}
    for ch, latin in LATIN_LIKE.items():
        same.setdefault(latin, [latin]).append(ch)
    for latin, digit in DIGIT_LIKE.items():
        same.setdefault(latin, [latin]).append(digit)
    out: dict[str, dict[str, str]] = {}
    for letters in same.values():
        for to in letters:
            for ch in letters:
                if script(ch) != script(to):
                    out.setdefault(script(to), {}).setdefault(ch, to)
    return out


@lru_cache
def _has_double() -> frozenset[str]:
    return frozenset(ch for table in doubles().values() for ch in table)


def word_repairs(token: str) -> list[tuple[str, bool]]:
    """(the token put into one of its scripts, whether that script is sure to be the dominant one), the likeliest first; none for a token of one script."""
    letters = [ch for ch in token if script(ch) and script(ch) != "DIGIT"]
    scripts = {script(ch) for ch in letters}
    digits = sum(ch.isdigit() for ch in token)
    if digits > len(letters) > 0:
        scripts.add("DIGIT")
    if len(scripts) < 2:
        return []
    own = {s: sum(script(ch) == s and ch not in _has_double() for ch in letters) for s in scripts}
    many = {s: digits if s == "DIGIT" else sum(script(ch) == s for ch in letters) for s in scripts}
    out = []
    if len(scripts - {"DIGIT"}) > 1:
        scripts |= {"LATIN"}  # letters of two scripts can be doubles of a third
        own.setdefault("LATIN", 0)
        many.setdefault("LATIN", 0)
    for s in sorted(scripts, key=lambda s: (-own[s], -many[s], s != "LATIN", s)):
        table = doubles().get(s, {})
        new = "".join(ch if script(ch) in (s, "", "DIGIT") else table.get(ch, ch) for ch in token)
        if new != token and all(script(ch) in (s, "", "DIGIT") for ch in new):
            out.append((new, own[s] > 0))
    return out


def repairs(t: str) -> list[tuple[int, str, str, str, bool]]:
    """Possible substitutions in a formed value: (position, old, new, the vocabulary entry that must exist, sure)."""
    out = []
    for m in _ALPHA.finditer(t):
        if not m[0].isascii():
            out += [(m.start(), m[0], new, "a:" + new, sure) for new, sure in word_repairs(m[0])]
    for m in _HANRUN.finditer(t):
        run = m[0]
        # letters without a double tell the script of the run here as well; then the number of letters
        odd = [ch for ch in run if _ODD.match(ch)]
        sure_han, sure_odd = sum(ch not in _HAN_DOUBLES for ch in run) - len(odd), sum(ch not in HAN_LIKE for ch in odd)
        for i, ch in enumerate(run if (sure_han, len(run) - len(odd)) >= (sure_odd, len(odd)) else ""):
            if ch in HAN_LIKE:
                new = HAN_LIKE[ch]
                left = run[i - 1] if i else "^"
                right = run[i + 1] if i + 1 < len(run) else "$"
                out.append((m.start() + i, ch, new, f"h:{HAN_LIKE.get(left, left)}{new}{HAN_LIKE.get(right, right)}", True))
    return out


def words(t: str) -> list[str]:
    """Vocabulary entries of a formed value that isn't all ordinary characters: its words of one script."""
    return ["a:" + m[0] for m in _ALPHA.finditer(t) if len({script(ch) for ch in m[0]} - {"", "DIGIT"}) == 1]


def apply_repairs(t: str, known: dict[str, int]) -> str:
    """Make the substitutions whose result is known: that of the sure script, else the most usual one."""
    options: dict[int, list[tuple[int, int, str, str]]] = {}
    for k, (pos, old, new, need, sure) in enumerate(repairs(t)):
        if known.get(need, 0) > 0:
            options.setdefault(pos, []).append((-1 if sure else 0, -known[need], k, old, new))
    out, at = [], 0
    for pos in sorted(options):
        if pos >= at:
            *_, old, new = min(options[pos])
            out += [t[at:pos], new]
            at = pos + len(old)
    return "".join(out) + t[at:]


_LATIN = r"!-~\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{17f}"
#: What a value in the consistent form doesn't have: other characters, or a space that isn't between two words.
UNCLEAN = (
    rf"[^ {_LATIN}\x{{3007}}\x{{3400}}-\x{{4dbf}}\x{{4e00}}-\x{{9fff}}\x{{3001}}-\x{{3006}}\x{{3008}}-\x{{301f}}\x{{ff01}}-\x{{ff0f}}\x{{ff1a}}-\x{{ff20}}\x{{ff3b}}-\x{{ff40}}\x{{ff5b}}-\x{{ff65}}\x{{2010}}-\x{{2027}}\x{{b7}}]"
    rf"|(?<![{_LATIN}]) | (?![{_LATIN}])"
)


#: What a value that folding leaves as it is doesn't have.
UNFOLDED = r"[^!-~\x{3007}\x{3400}-\x{4dbf}\x{4e00}-\x{9fff}\x{3001}-\x{3006}\x{3008}-\x{301f}\x{ff01}-\x{ff0f}\x{ff1a}-\x{ff20}\x{2010}-\x{2027}]"


def is_clean(c: Column) -> Column:
    return ~c.rlike(UNCLEAN)


def _entries(v: Column) -> Column:
    """Vocabulary entries of a clean value: words, and every Han character that has a double with its neighbours in the run."""
    alpha = F.transform(F.regexp_extract_all(v, F.lit(r"([0-9A-Za-z\x{c0}-\x{24f}]+)"), F.lit(1)), lambda x: F.concat(F.lit("a:"), x))
    signs = "".join(sorted(set(HAN_LIKE.values())))
    han = r"\x{3007}\x{3400}-\x{4dbf}\x{4e00}-\x{9fff}"
    marked = F.regexp_replace(F.regexp_replace(v, rf"(?<![{han}])(?=[{han}])", "^"), rf"(?<=[{han}])(?![{han}])", "\\$")
    near = F.regexp_extract_all(marked, F.lit(rf"(?=([{han}^][{signs}][{han}$]))"), F.lit(1))
    return F.concat(alpha, F.transform(near, lambda x: F.concat(F.lit("h:"), x)))


def consistent(values: DataFrame) -> DataFrame:
    """(value, fixed): the consistent form of every distinct value that isn't in it already.

    ``values`` has one string column ``value``; repeats are fine. Null and empty values,
    and values already consistent, give no row. A double whose repaired token or
    neighbourhood is unknown to the vocabulary (the words of all clean values and the words
    of one script of the others) stays as it is. Very long values are handled whole.
    """
    there = values.filter(F.col("value").isNotNull())
    clean = is_clean(F.col("value"))

    def formed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            f = [form(x) for x in b["value"]]
            yield pd.DataFrame({"value": b["value"], "formed": f, "needs": [sorted({r[3] for r in repairs(x)}) for x in f], "words": [words(x) for x in f]})

    suspects = cut(there.filter(~clean).distinct().mapInPandas(formed, "value string, formed string, needs array<string>, words array<string>"))
    needed = suspects.select(F.explode("needs").alias("key")).distinct()
    have = there.filter(clean).select(F.explode(_entries(F.col("value"))).alias("key")).unionByName(suspects.select(F.explode("words").alias("key")))
    known = have.groupBy("key").agg(F.count(F.lit(1)).alias("n")).join(needed, "key")
    asked = suspects.select("value", F.explode("needs").alias("key")).join(known, "key").groupBy("value").agg(F.map_from_entries(F.collect_list(F.struct("key", "n"))).alias("known"))

    def repaired(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            fixed = [apply_repairs(f, {} if k is None else dict(k)) for f, k in zip(b["formed"], b["known"], strict=True)]
            out = pd.DataFrame({"value": b["value"], "fixed": fixed})
            yield out[out["value"] != out["fixed"]]

    both = suspects.select("value", "formed").join(asked, "value", "left")
    return both.mapInPandas(repaired, "value string, fixed string")


def fold(c: Column) -> Column:
    """The form layer for keys, all in the JVM: one form of characters, nothing invisible, no spaces at all.

    Look-alike Han signs are folded without the vocabulary, so use it to compare known
    names, not to repair text. Null stays null.
    """
    f = folds() | HAN_LIKE
    t = F.translate(c, "".join(f), "".join(f.values()))
    t = F.regexp_replace(t, r"[\p{Cf}\p{Cc}\p{Z}\x{fe00}-\x{fe0f}\x{3164}\x{34f}]+", "")
    # most values have nothing to fold, which one search tells
    return F.when(c.rlike(UNFOLDED), t).otherwise(c)


def repair_columns(*tables: tuple[DataFrame, str, list[str]]) -> DataFrame:
    """(row_id, field, value, fixed) of every value not in the consistent form, of tables given with id column and columns; all share one vocabulary."""
    long = None
    for df, id_col, columns in tables:
        part = df.select(F.col(id_col).alias("row_id"), F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("value")) for c in columns])).alias("s")).select("row_id", "s.*")
        long = part if long is None else long.unionByName(part)
    odd = long.filter(F.col("value").isNotNull() & ~is_clean(F.col("value")))
    return odd.join(consistent(long.select("value")), "value").select("row_id", "field", "value", "fixed")
