"""String, vocabulary and label functions as column expressions."""

from __future__ import annotations

import functools
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Plain forms of letters that no decomposition reaches (fixed values).
FOLD = {"ß": "ss", "æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE", "ø": "o", "Ø": "O", "ł": "l", "Ł": "L", "đ": "d", "€": "EUR", "’": "'", "–": "-", "—": "-"}
ACCENTED = "".join(c for c in map(chr, range(0xC0, 0x180)) if len(unicodedata.normalize("NFD", c)) > 1)
PLAIN = "".join(unicodedata.normalize("NFD", c)[0] for c in ACCENTED)
#: Layout roles (fixed values).
ROLES = {"header": ["page_header", "header"], "footer": ["page_footer", "footer"], "footnote": ["footnote"], "caption": ["caption"], "float": ["table", "picture", "figure", "formula", "chart"]}
#: Characters and line starts that mean something in a format (fixed values).
MARKDOWN, MARKDOWN_LINE = r"([\\`*_\[\]|#<>])", r"^\s*(?:[-+>#=`]|[\p{Nd}²³¹⁰⁴-⁹₀-₉]+\.*(?: |$))"
ASCIIDOC, ASCIIDOC_LINE = r"([\\`*_#^~|+{}<>])", r"^\s*[=*.\-/+]"
RTL_LETTERS = r"[\p{IsHebrew}\p{IsArabic}\p{IsSyriac}\p{IsThaana}\p{IsNko}&&\p{L}]"
RTL_LANGUAGES = ["ar", "fa", "he", "ur", "yi"]


def folded(s: Column) -> Column:
    """Latin letters without accents, some signs written out."""
    out = F.translate(s, ACCENTED, PLAIN)
    for a, b in FOLD.items():
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def match_levels(a: Column, b: Column) -> dict[str, Column]:
    """Equality as it is, without case, folded, and folded without case."""
    return {"raw": a == b, "caseless": F.lower(a) == F.lower(b), "folded": folded(a) == folded(b), "unicase": F.lower(folded(a)) == F.lower(folded(b))}


def characters(s: Column) -> Column:
    return F.filter(F.split(s, ""), lambda c: c != "")


def encoded(s: Column, vocab: str) -> Column:
    """Index of each character in the vocabulary; an error if one is missing."""
    known = F.array(*map(F.lit, vocab))
    return F.transform(characters(s), lambda c: F.when(F.array_contains(known, c), F.array_position(known, c).cast("int") - 1).otherwise(F.raise_error(F.lit("character outside the vocabulary")).cast("int")))


def in_vocabulary(s: Column, vocab: str) -> Column:
    known = F.array(*map(F.lit, vocab))
    return F.forall(characters(s), lambda c: F.array_contains(known, c))


def padded(codes: Column, width: int | Column, eos: int, pad: int | None = None, sos: int | None = None) -> Column:
    """Codes at a fixed width: optional start, end mark, padding; cut where too long."""
    body = F.concat(*([F.array(F.lit(sos))] if sos is not None else []), codes, F.array(F.lit(eos)))
    return F.slice(F.concat(body, F.array_repeat(F.lit(eos if pad is None else pad), width)), 1, width)


def decoded(codes: Column, vocab: str | Column) -> Column:
    known = vocab if isinstance(vocab, Column) else F.array(*map(F.lit, vocab))
    return F.array_join(F.transform(codes, lambda i: F.element_at(known, i + 1)), "")


def normal_label(label: Column) -> Column:
    """Lower snake case; null becomes empty."""
    return F.coalesce(F.regexp_replace(F.lower(F.trim(label)), r"[^\p{L}\p{N}]", "_"), F.lit(""))


def label_role(label: Column) -> Column:
    name = normal_label(label)
    out = F.lit("body")
    for role, names in ROLES.items():
        out = F.when(name.isin(names), role).otherwise(out)
    return out


def markdown_escaped(s: Column) -> Column:
    return F.regexp_replace(s, MARKDOWN, r"\\$1")


def markdown_line(s: Column) -> Column:
    """A line that would begin like a marker or a numbered item gets a backslash, if it has none."""
    return F.when(s.rlike(MARKDOWN_LINE), F.concat(F.lit("\\"), s)).otherwise(s)


def asciidoc_escaped(s: Column) -> Column:
    return F.regexp_replace(s, ASCIIDOC, r"\\$1")


def asciidoc_line(s: Column) -> Column:
    return F.when(s.rlike(ASCIIDOC_LINE), F.concat(F.lit("{empty}"), s)).otherwise(s)


def html_escaped(s: Column) -> Column:
    return F.replace(F.replace(F.replace(s, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def softmax(logits: Column) -> Column:
    top = F.array_max(logits)
    e = F.transform(logits, lambda v: F.exp(v - top))
    total = F.aggregate(e, F.lit(0.0), lambda s, v: s + v)
    return F.transform(e, lambda v: v / total)


def arg_max(values: Column) -> Column:
    """First index of the greatest value."""
    return F.array_position(values, F.array_max(values)).cast("int") - 1


def ctc_decode(steps: Column, vocab: str | Column, blank: int) -> tuple[Column, Column]:
    """Best path of per-step logits: repeats collapse, then blanks go; confidence is the least step's."""
    best = F.transform(steps, arg_max)
    pairs = F.zip_with(best, F.concat(F.array(F.lit(-1)), best), lambda c, before: F.struct(c.alias("c"), before.alias("before")))
    kept = F.transform(F.filter(pairs, lambda x: (x["c"] != blank) & (x["c"] != x["before"])), lambda x: x["c"])
    return decoded(kept, vocab), F.array_min(F.transform(steps, lambda s: F.array_max(softmax(s))))


def until_eos(codes: Column, eos: int | Column) -> Column:
    k = F.array_position(codes, F.lit(eos)).cast("int")
    return F.when(k > 0, F.slice(codes, F.lit(1), k - 1)).otherwise(codes)


def attention_decode(steps: Column, vocab: str | Column, eos: int | Column, whole: bool) -> tuple[Column, Column]:
    """Text up to the end mark; confidence is the least of all steps (``whole``) or the mean over the text."""
    codes = until_eos(F.transform(steps, arg_max), eos)
    probs = F.transform(steps, lambda s: F.array_max(softmax(s)))
    n = F.size(codes)
    mean = F.when(n > 0, F.aggregate(F.slice(probs, F.lit(1), n), F.lit(0.0), lambda s, v: s + v) / n).otherwise(0.0)
    return decoded(codes, vocab), F.array_min(probs) if whole else mean


def merge_pair(a: str, b: str, overlap: float) -> str:
    """Two overlapping readings as one.

    The cut characters at the seam, the last of ``a`` and the first of ``b``,
    are given up, then the shared stretch that fits best is kept once: an exact
    one, of several the nearest to the expected length, else the least of
    differing characters plus distance from that length.
    """
    if min(len(a), len(b)) <= 1:
        return a + b
    head, tail = a[:-1], b[1:]
    wanted = round(len(b) * overlap) - 2  # half-even; less the two characters given up
    shared = range(1, min(len(head), len(tail)) + 1)
    differ = {n: sum(x != y for x, y in zip(head[-n:], tail)) for n in shared}
    exact = [n for n in shared if not differ[n]]
    if exact:
        keep = min(exact, key=lambda n: abs(n - wanted))
    elif wanted < 0:
        return a + b
    elif wanted == 0:
        return head + tail
    else:
        keep = min(shared, key=lambda n: differ[n] + abs(n - wanted))
    return head + tail[keep:]


def merge_all(parts: list[str], overlap: float, last_overlap: float) -> str:
    """Left fold of ``merge_pair``; the last pair has its own overlap."""
    out = parts[0] if parts else ""
    for k, part in enumerate(parts[1:], 2):
        out = merge_pair(out, part, last_overlap if k == len(parts) else overlap)
    return out


@F.pandas_udf(T.StringType())
def merged(parts: pd.Series, overlap: pd.Series, last_overlap: pd.Series) -> pd.Series:
    return pd.Series([None if p is None else merge_all(list(p), o, x) for p, o, x in zip(parts, overlap, last_overlap)])


def text_direction(text: Column, language: Column) -> Column:
    """rtl or ltr by strong letters; a tie follows the language."""
    plain = F.coalesce(text, F.lit(""))
    right, letters = F.regexp_count(plain, F.lit(RTL_LETTERS)), F.regexp_count(plain, F.lit(r"\p{L}"))
    left = letters - right
    return F.when((right > left) | ((right == left) & F.coalesce(language.isin(RTL_LANGUAGES), F.lit(False))), "rtl").otherwise("ltr")


def to_vocabulary(text: Column, vocab: str) -> Column:
    """Characters of the vocabulary, accented ones as their plain letter if that is in it, the rest marked; blanks go."""
    pairs = [(a, p) for a, p in zip(*accents()) if a not in vocab and p in vocab]
    inside = "".join("\\" + c if not c.isalnum() and c.isascii() else c for c in vocab)
    plain = F.translate(F.regexp_replace(text, r"(?U)\s", ""), "".join(a for a, _ in pairs), "".join(p for _, p in pairs))
    return F.regexp_replace(plain, f"[^{inside}]", "■")


@functools.cache
def accents() -> tuple[str, str]:
    """All characters that decompose to an ASCII letter and marks, and those letters."""
    found = [(c, d[0]) for c in map(chr, range(0xC0, 0x2C00)) if (d := unicodedata.normalize("NFD", c)) != c and d[0].isascii() and all(map(unicodedata.combining, d[1:]))]
    return "".join(a for a, _ in found), "".join(b for _, b in found)
