"""Column expressions of the cleaning rules. All run in the JVM and on whole texts.

White space is spelled out, since Java's classes differ from the rules': the class below
is what separates words and is stripped.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode white space, line boundaries.
WHITE = r"\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
WHITE_CHARS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
LINE_END = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"

# Lines that start like one of these are boilerplate.
BOILERPLATE = (
    r"^\s*FORM\s+10-[KQ]\b",
    r"^\s*Page\s+\d+\s+of\s+\d+\s*$",
    r"^\s*UNITED\s+STATES\s+SECURITIES\s+AND\s+EXCHANGE\s+COMMISSION\s*$",
    r"^\s*SECURITIES\s+AND\s+EXCHANGE\s+COMMISSION\s*$",
    r"^\s*Washington,?\s+D\.?\s*C\.?\s+20549\s*$",
    r"^\s*/s/\s*.+$",
    r"^\s*TABLE\s+OF\s+CONTENTS\s*$",
    r"^\s*All\s+rights\s+reserved\.?\s*$",
    r"^\s*\(?[Cc]opyright\)?\s*(©|\(c\))?\s*\d{4}",
    r"^\s*©\s*\d{4}",
    r"^\s*\[?\s*(SIGNATURE|SIGNATURES)\s*\]?\s*$",
    r"^\s*Exhibit\s+\d+(\.\d+)?\s*$",
    r"^\s*See\s+accompanying\s+notes\b",
    r"^\s*<[A-Z/][^>]*>\s*$",
)

# Words that look like damage of character recognition.
OCR_DAMAGE = (
    r"^[A-Za-z]*\p{Nd}+[A-Za-z]+$",
    r"^[a-z]+[A-Z]{2,}",
    r"[bcdfghjklmnpqrstvwxz]{6,}",
    r"(.)\1{4,}",
)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` worked out once, also inside lambdas."""
    return F.transform(F.array(value), use)[0]


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITE_CHARS))


def split_lines(text: Column) -> Column:
    return F.split(text, LINE_END)


def normalize_whitespace(text: Column) -> Column:
    """Every run of white space becomes one space; none at the ends."""
    # a single space stays as it is, which is most runs
    return strip(F.regexp_replace(text, f"[{WHITE}&&[^ ]][{WHITE}]*| [{WHITE}]+", " "))


def words(text: Column) -> Column:
    """The words of a text; an empty array if there are none."""
    return F.filter(F.split(text, f"[{WHITE}]+"), lambda w: w != "")


def non_alnum_ratio(line: Column) -> Column:
    """Share of characters that aren't ASCII letters or digits; 1 for an empty line."""
    found = F.length(line) - F.length(F.regexp_replace(line, "[a-zA-Z0-9]+", ""))
    return F.when(F.length(line) == 0, F.lit(1.0)).otherwise(F.lit(1.0) - found / F.length(line))


def is_boilerplate(line: Column) -> Column:
    # all begin alike: as one anchored pattern they are tried at the line's start only
    return line.rlike(r"(?iu)^\s*(?:" + "|".join(p.removeprefix(r"^\s*") for p in BOILERPLATE) + ")")


def ascii_ratio(text: Column) -> Column:
    """Share of ASCII characters; 0 for an empty text."""
    return F.when(F.length(text) == 0, F.lit(0.0)).otherwise(F.length(F.regexp_replace(text, r"[^\x00-\x7f]", "")) / F.length(text))


def mostly_ascii(text: Column, least: float) -> Column:
    """Whether :func:`ascii_ratio` is at least that. A character that isn't ASCII has one to
    three bytes more, so lengths decide most texts; the others are counted."""
    more, few = F.octet_length(text) - F.length(text), F.length(text) * (1 - least)
    sure = F.when(more < few - 1, F.lit(True)).when(more > 3 * few + 3, F.lit(False))
    return F.when(F.length(text) == 0, F.lit(least <= 0)).otherwise(F.coalesce(sure, ascii_ratio(text) >= least))


def ngrams(words_: Column, n: int) -> Column:
    """All runs of n words, joined by one space; none if there are fewer words."""
    return let(
        words_,
        lambda w: F.when(F.size(w) < n, F.array().cast("array<string>")).otherwise(
            F.transform(F.sequence(F.lit(1), F.greatest(F.size(w) - (n - 1), F.lit(1))), lambda i: F.array_join(F.slice(w, i, n), " "))
        ),
    )


def repetition_ratio(words_: Column, n: int, top_k: int) -> Column:
    """Share of the n-grams that the top_k commonest ones make up; 0 below 2n words.

    N-grams are counted by 64-bit hashes, sorted in place: run ends give the counts, so
    nothing is exploded or shuffled.
    """

    def counts(sorted_: Column) -> Column:
        many = F.size(sorted_)
        ends = F.filter(F.sequence(F.lit(1), many), lambda i: (i == many) | (F.get(sorted_, i) != F.get(sorted_, i - 1)))
        return let(ends, lambda e: F.transform(e, lambda x, k: x - F.when(k == 0, 0).otherwise(F.get(e, k - 1))))

    top = lambda c: F.aggregate(F.slice(F.sort_array(c, False), 1, top_k), F.lit(0), lambda a, x: a + x)
    ratio = lambda w: let(F.sort_array(_gram_hashes(w, n)), lambda g: top(counts(g)) / F.size(g))
    return let(words_, lambda w: F.when(F.size(w) < 2 * n, F.lit(0.0)).otherwise(ratio(w)))


def _gram_hashes(words_: Column, n: int) -> Column:
    """A 64-bit hash of each n-gram, from one hash a word."""
    of = lambda h: F.transform(F.slice(h, 1, F.greatest(F.size(h) - (n - 1), F.lit(0))), lambda x, i: F.xxhash64(x, *(F.get(h, i + k) for k in range(1, n))))
    return let(F.transform(words_, lambda w: F.xxhash64(w)), of)


def repetitive(words_: Column, n: int, top_k: int, most: float) -> Column:
    """Whether :func:`repetition_ratio` is above ``most``. The top_k commonest of d distinct
    n-grams leave d - top_k others at least, which settles most texts; the others are counted."""
    bound = lambda w: let(_gram_hashes(w, n), lambda g: F.size(g) - F.size(F.array_distinct(g)) + top_k > F.size(g) * F.lit(float(most)))
    return let(words_, lambda w: (F.size(w) >= 2 * n) & bound(w) & (repetition_ratio(w, n, top_k) > most))


def ocr_ratio(words_: Column, least: int) -> Column:
    """Share of damaged words; 0 with fewer than ``least``. The rule gives it the words of
    the first characters only."""
    # anchored patterns are tried once a word, the others only where a word is long enough
    start = "^(?:" + "|".join(p[1:] for p in OCR_DAMAGE if p[0] == "^") + ")"
    inside = "|".join(p for p in OCR_DAMAGE if p[0] != "^")
    damaged = lambda x: x.rlike(start) | ((F.length(x) >= 5) & x.rlike(inside))
    return let(words_, lambda w: F.when(F.size(w) < least, F.lit(0.0)).otherwise(F.size(F.filter(w, damaged)) / F.size(w)))


def single_spaced_words(text: Column) -> Column:
    """The words of a text that :func:`normalize_whitespace` made, or of its beginning."""
    return F.filter(F.split(text, " "), lambda w: w != "")


def exact_key(text: Column) -> Column:
    return F.sha2(F.lower(normalize_whitespace(text)), 256)


def est_tokens(chars: Column, chars_per_token: float) -> Column:
    return F.floor(chars / F.lit(chars_per_token)).cast("long")
