"""Text normalisation and keyword themes as JVM-side column expressions.

``normalize_text`` is compatibility decomposition (NFKD) without combining
marks, lowercased. Spark has no such built-in, so the code-point tables are
derived once on the driver from :mod:`unicodedata` and handed to ``translate``;
no row ever visits a Python worker.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Mapping, Sequence
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from touchline.functions.once import once
from touchline.vocabulary import THEME_KEYWORDS

# A word character: any letter or number of any script, or the underscore.
WORD_CLASS = r"[\p{L}\p{N}_]"

_HANGUL_FIRST, _HANGUL_LAST = 0xAC00, 0xD7A3


def fold(text: str) -> str:
    """Driver-side normalisation of a short string (keywords, search terms)."""
    decomposed = unicodedata.normalize("NFKD", text)
    return "".join(c for c in decomposed if unicodedata.combining(c) == 0).lower()


class FoldTables(NamedTuple):
    single_from: str
    single_to: str
    expansions: dict[str, str]


@lru_cache(maxsize=1)
def fold_tables() -> FoldTables:
    """Code points that change under NFKD minus marks, by size of the result.

    Code points that become one character or vanish fit ``translate``; the ones
    that become several are listed apart. Hangul syllables follow an arithmetic
    rule and are handled by expression.
    """
    kept_from, kept_to, dropped, expansions = [], [], [], {}
    for code in range(0x80, 0x110000):
        if 0xD800 <= code <= 0xDFFF or _HANGUL_FIRST <= code <= _HANGUL_LAST:
            continue
        char = chr(code)
        if not unicodedata.decomposition(char) and not unicodedata.combining(char):
            continue
        result = "".join(
            c for c in unicodedata.normalize("NFKD", char) if not unicodedata.combining(c)
        )
        if result == char:
            continue
        if len(result) == 0:
            dropped.append(char)
        elif len(result) == 1:
            kept_from.append(char)
            kept_to.append(result)
        else:
            expansions[char] = result
    return FoldTables("".join(kept_from + dropped), "".join(kept_to), expansions)


def _ranges(codes: Sequence[int]) -> str:
    """Sorted code points as the inside of a Java character class."""
    parts, start, previous = [], None, None
    for code in [*codes, None]:
        if start is not None and (code is None or code != previous + 1):
            parts.append(rf"\x{{{start:X}}}-\x{{{previous:X}}}")
            start = None
        if start is None:
            start = code
        previous = code
    return "".join(parts)


def _char_class(codes: Sequence[int]) -> str:
    """A Java regex for one of many code points, cheap to fail on common letters.

    Everything from U+0100 on sits behind a guard range, and there each block behind
    its own, so that a character tests a few ranges instead of all of them.
    """
    latin = sorted(c for c in codes if c < 0x100)
    blocks: dict[int, list[int]] = {}
    for code in sorted(c for c in codes if c >= 0x100):
        blocks.setdefault(code >> 10, []).append(code)
    guarded = "".join(
        rf"[\x{{{members[0]:X}}}-\x{{{members[-1]:X}}}&&[{_ranges(members)}]]" for members in blocks.values()
    )
    return rf"[{_ranges(latin)}]|[\x{{100}}-\x{{10FFFF}}&&[{guarded}]]"


@lru_cache(maxsize=1)
def _expansion_pattern() -> str:
    hangul = range(_HANGUL_FIRST, _HANGUL_LAST + 1)
    return _char_class([*(ord(c) for c in fold_tables().expansions), *hangul])


def _code_point(code: Column) -> Column:
    """The one-character string of a code point below U+10000."""
    return F.decode(F.unhex(F.lpad(F.hex(code), 4, "0")), "UTF-16BE")


def _hangul_parts(char: Column) -> Column:
    offset = F.ascii(char).cast("long") - F.lit(_HANGUL_FIRST)
    lead = _code_point(F.lit(0x1100) + F.floor(offset / F.lit(588)))
    vowel = _code_point(F.lit(0x1161) + F.floor((offset % F.lit(588)) / F.lit(28)))
    tail = offset % F.lit(28)
    closing = F.when(tail > 0, _code_point(F.lit(0x11A7) + tail)).otherwise(F.lit(""))
    return F.concat(lead, vowel, closing)


def _expand(text: Column) -> Column:
    """Replace each distinct multi-character code point by its decomposition."""
    pairs = "\x02".join(f"{c}\x01{r}" for c, r in fold_tables().expansions.items())
    lookup = F.str_to_map(F.lit(pairs), F.lit("\x02"), F.lit("\x01"))

    def decomposed(char: Column) -> Column:
        is_hangul = F.ascii(char).between(_HANGUL_FIRST, _HANGUL_LAST)
        return F.when(is_hangul, _hangul_parts(char)).otherwise(
            F.coalesce(F.try_element_at(lookup, char), char)
        )

    found = F.array_distinct(F.regexp_extract_all(text, F.lit(_expansion_pattern()), F.lit(0)))
    return F.aggregate(found, text, lambda acc, char: F.replace(acc, char, decomposed(char)))


def normalize_text(text: Column | str) -> Column:
    """NFKD without combining marks, lowercased; null stays null.

    Pure ASCII text (byte length equals character length) skips the tables.
    """
    text = F.col(text) if isinstance(text, str) else text
    tables = fold_tables()
    folded = F.translate(_expand(text), tables.single_from, tables.single_to)
    is_ascii = F.octet_length(text) == F.char_length(text)
    return F.lower(F.when(is_ascii, text).otherwise(folded))


def _quote(text: str) -> str:
    return re.sub(r"([^\w\s])", r"\\\1", text)


def _is_word(char: str) -> bool:
    return char == "_" or unicodedata.category(char)[0] in "LN"


def whole_word_pattern(terms: Sequence[str]) -> str:
    """One Java regex that finds any (already folded) term between word boundaries."""
    groups: dict[tuple[str, str], list[str]] = {}
    for term in terms:
        if not term:
            raise ValueError("a keyword is empty after normalisation")
        # A boundary next to a word character means no word character beyond it;
        # next to any other character it means a word character must be there.
        left = "(?<!" if _is_word(term[0]) else "(?<="
        right = "(?!" if _is_word(term[-1]) else "(?="
        groups.setdefault((left, right), []).append(term)
    parts = []
    for (left, right), members in groups.items():
        firsts = "".join(sorted({_quote(m[0]) for m in members}))
        body = "|".join(_quote(m) for m in members)
        parts.append(f"(?=[{firsts}]){left}{WORD_CLASS})(?:{body}){right}{WORD_CLASS})")
    return "|".join(parts)


def compact_pattern(keywords: Sequence[str]) -> str:
    """Regex that finds any keyword, without spaces and hyphens, inside a hashtag."""
    compact = [re.sub(r"[\s-]", "", fold(k)) for k in keywords]
    return "|".join(_quote(c) for c in compact if c)


def hashtag_text(hashtags: Column | str) -> Column:
    """All hashtags of a post as one normalised string, hyphens removed.

    A line break separates them: no compacted keyword contains one, so a match
    never spans two hashtags.
    """
    joined = F.array_join(hashtags, "\n")
    return F.replace(normalize_text(joined), F.lit("-"), F.lit(""))


def match_keywords(text_norm: Column, tags_norm: Column, keywords: Sequence[str]) -> Column:
    """Whole-word match in the text or substring match in the hashtags."""
    in_text = F.coalesce(text_norm.rlike(whole_word_pattern([fold(k) for k in keywords])), F.lit(False))
    in_tags = F.coalesce(tags_norm.rlike(compact_pattern(keywords)), F.lit(False))
    return in_text | in_tags


def _theme_array(
    text_norm: Column, tags_norm: Column, any_in_text: Column, themes: Mapping[str, Sequence[str]]
) -> Column:
    matches = []
    for theme, keywords in themes.items():
        in_text = any_in_text & text_norm.rlike(whole_word_pattern([fold(k) for k in keywords]))
        in_tags = tags_norm.rlike(compact_pattern(keywords))
        matches.append(F.when(in_text | in_tags, F.lit(theme)))
    return F.array_compact(F.array(*matches))


def _any_keyword(text_norm: Column, themes: Mapping[str, Sequence[str]]) -> Column:
    every = [fold(k) for keywords in themes.values() for k in keywords]
    return text_norm.rlike(whole_word_pattern(every))


def tag_themes(
    text: Column, hashtags: Column, themes: Mapping[str, Sequence[str]] = THEME_KEYWORDS
) -> Column:
    """Matched themes in declaration order as one expression; ``[]`` if none."""
    text_norm = F.coalesce(normalize_text(text), F.lit(""))
    tags_norm = F.coalesce(hashtag_text(hashtags), F.lit(""))
    return _theme_array(text_norm, tags_norm, _any_keyword(text_norm, themes), themes)


def with_themes(
    df: DataFrame,
    text: str = "text",
    hashtags: str = "hashtags",
    output: str = "themes",
    themes: Mapping[str, Sequence[str]] = THEME_KEYWORDS,
) -> DataFrame:
    """Add the theme array, computing each intermediate once per row.

    Normalised text, normalised hashtags and the any-keyword probe are separate
    projections, so an off-topic post costs one regex scan instead of one per
    theme. Filters on the result do not repeat the work.
    """
    kept = [c for c in df.columns if c != output]
    staged = df.withColumns(
        {
            "_text_norm": F.coalesce(normalize_text(F.col(text)), F.lit("")),
            "_tags_norm": F.coalesce(hashtag_text(F.col(hashtags)), F.lit("")),
        }
    ).withColumn("_any_in_text", _any_keyword(F.col("_text_norm"), themes))
    tagged = _theme_array(F.col("_text_norm"), F.col("_tags_norm"), F.col("_any_in_text"), themes)
    return once(staged, **{output: tagged}).select(*kept, output)


def tag_themes_udf(themes: Mapping[str, Sequence[str]] = THEME_KEYWORDS):
    """Arrow UDF form of :func:`tag_themes`, for callers that need a function object.

    Each distinct text and tag list of a batch is looked at once; per theme a pattern runs over a whole column. Text still
    crosses to Python and back, so the expression stays the main path.
    """
    text_rules = {t: "|".join(rf"\b{re.escape(fold(k))}\b" for k in keywords) for t, keywords in themes.items()}
    tag_rules = {t: compact_pattern(keywords) for t, keywords in themes.items()}
    names = np.array(list(themes), dtype=object)

    def found(values: pd.Series, rules: Mapping[str, str]) -> np.ndarray:
        """One column per theme: whether its pattern is in the folded value."""
        codes, distinct = pd.factorize(values)
        folded = pd.Series(distinct, dtype=object).map(fold)
        if rules is tag_rules:
            folded = folded.str.replace("-", "", regex=False)
        hits = [folded.str.contains(re.compile(rules[t])).to_numpy(dtype=bool) for t in themes]
        return np.stack(hits, axis=1)[codes] if len(folded) else np.zeros((len(values), len(hits)), dtype=bool)

    @F.pandas_udf(ArrayType(StringType()))
    def tagger(texts: pd.Series, tag_lists: pd.Series) -> pd.Series:
        joined = tag_lists.map(lambda tags: "\n".join(t for t in (tags if tags is not None else []) if t))
        hits = found(texts.fillna(""), text_rules) | found(joined, tag_rules)
        rows, at = np.nonzero(hits)
        ends = np.cumsum(np.bincount(rows, minlength=len(hits)))
        return pd.Series(np.split(names[at], ends[:-1]) if len(hits) else [], dtype=object)

    return tagger
