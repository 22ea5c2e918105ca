"""Text normalisation as native Column expressions."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


# Unicode white space and word characters as plain classes: same sets as (?U)\\s and \\w, matched faster.
SPACE = r"[\s\x85\p{Z}]"
NOT_SPACE = r"[^\s\x85\p{Z}]"
WORD = r"[\p{L}\p{M}\p{Nd}\p{Pc}]"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind ``value`` to a lambda variable so that ``body`` can reuse it without re-evaluating it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _fold_table() -> tuple[str, str]:
    """Accented Latin letters and their base letters, derived from Unicode decomposition."""
    source, target = [], []
    for code in [*range(0x00C0, 0x0250), *range(0x1E00, 0x1F00)]:
        char = chr(code)
        base = "".join(c for c in unicodedata.normalize("NFD", char) if unicodedata.category(c) != "Mn")
        if base != char and len(base) == 1 and base.isascii():
            source.append(char)
            target.append(base)
    return "".join(source) + "đĐ", "".join(target) + "dD"


_ACCENTED, _PLAIN = _fold_table()


def collapse(text: Column) -> Column:
    """Runs of (Unicode) whitespace become one space; ends are trimmed."""
    return F.trim(F.regexp_replace(text, rf"{SPACE}{{2,}}|[\s\x85\p{{Z}}&&[^ ]]", " "))


def strip_space(text: Column) -> Column:
    return F.regexp_replace(text, rf"^{SPACE}+|{SPACE}+$", "")


def non_empty(text: Column) -> Column:
    return let(text, lambda t: F.when(t != "", t))


def fold_accents(text: Column) -> Column:
    """Remove diacritics, keeping case."""
    return F.translate(F.regexp_replace(text, r"\p{Mn}+", ""), _ACCENTED, _PLAIN)


def unaccent(text: Column) -> Column:
    """Lower-case, accent-free, single-spaced form used for keyword matching."""
    return non_empty(collapse(fold_accents(F.lower(text))))


def _tidy_parentheses(text: Column) -> Column:
    def tidy(t: Column) -> Column:
        spaced = F.regexp_replace(F.regexp_replace(t, r"\( +", "("), r" +\)", ")")
        spaced = F.regexp_replace(spaced, r"([^\s\x85\p{Z}(])\(", "$1 (")
        return F.when(t.contains("(") | t.contains(")"), spaced).otherwise(t)

    return let(text, tidy)


def normalize_common(text: Column) -> Column:
    return non_empty(_tidy_parentheses(F.lower(collapse(text))))


def normalize_name(text: Column) -> Column:
    """As ``normalize_common`` but with spaced punctuation and without special characters."""
    text = _sub_if(text, ",", rf",({NOT_SPACE})", ", $1")
    text = _sub_if(text, "-", rf"({NOT_SPACE})-({NOT_SPACE})", "$1 - $2")
    text = _sub_if(text, "/", rf"(?<!{SPACE})/(?!{SPACE})", " / ")
    text = F.regexp_replace(text, r"[^\p{L}\p{M}\p{Nd}\p{Pc}\s\x85\p{Z}.,\-/()]", " ")
    return normalize_common(text)


def split_camel(text: Column) -> Column:
    return F.regexp_replace(text, r"(?=\p{Lu})(?<=\p{Ll})", " ")


def _sub_if(text: Column, needles: str, pattern: str, new: str) -> Column:
    """``regexp_replace`` only where one of the characters occurs; a byte search is far cheaper than a regex."""

    def guarded(t: Column) -> Column:
        present = t.contains(needles[0])
        for needle in needles[1:]:
            present = present | t.contains(needle)
        return F.when(present, F.regexp_replace(t, pattern, new)).otherwise(t)

    return let(text, guarded)


def clean_requirement(text: Column) -> Column:
    """Flatten a requirement section: no tags, bullets, ellipses or list markers."""
    text = _sub_if(F.coalesce(text, F.lit("")), "<", r"(?i)</?p>|</?strong>", " ")
    text = _sub_if(text, "-–", rf"(?md)^[\-–]{SPACE}*", "")
    text = F.regexp_replace(text, r"[➢▸ü·\r\t•●▪◦*+]+", " ")
    text = _sub_if(text, "\n", r"\n+", " ")
    text = _sub_if(text, "…", r"…+", ".")
    text = _sub_if(text, ".", r"\.{2,}", ".")
    text = _sub_if(text, "()", r"[()]", " ")
    text = split_camel(text)
    text = _sub_if(text, ".!?;:", r"([.!?;:])", " $1 ")
    text = _sub_if(text, ".", rf"(?<!{WORD})(?:[A-Za-z]|[IVXLCM]+|\p{{Nd}}+){SPACE}*\.", " ")
    return collapse_runs(text)


def collapse_runs(text: Column) -> Column:
    """Runs of two or more white-space characters become one space; ends are stripped."""
    return strip_space(F.regexp_replace(text, rf"{SPACE}{{2,}}", " "))


# Compound terms that separators must not break, in matching order.
COMPOUND_TERMS = (
    "B2B/B2C", "B2B", "B2C", "QA/QC", "R&D", "F&B", "MEP", "MEPF",
    "LV/MV", "MV/LV", "MV/LV/ELV", "PCCC",
)


SEPARATOR = r"""[/&.,;:()\[\]"'–—]"""


def protect_terms(text: Column, terms: Sequence[str] = COMPOUND_TERMS) -> Column:
    """Space out separators except inside ``terms``, which keep their own casing; earlier terms go first.

    A text that holds a term is read as a row of terms, separators and stretches of neither.
    """
    text = F.coalesce(text, F.lit(""))
    term = "(?iu:" + "|".join(r"\Q" + t + r"\E" for t in terms) + ")"
    dashed = lambda c: F.regexp_replace(c, "[–—]", "–")
    read = F.regexp_extract_all(text, F.lit(f"(?s){term}|{SEPARATOR}|(?:(?!{term}|{SEPARATOR}).)+"), F.lit(0))
    spaced = F.array_join(F.transform(read, lambda x: F.when(x.rlike(f"^{SEPARATOR}$"), F.concat(F.lit(" "), dashed(x), F.lit(" "))).otherwise(x)), "")
    plain = dashed(F.regexp_replace(text, SEPARATOR, " $0 "))
    return collapse(F.when(text.rlike(term), spaced).otherwise(plain))


def normalize_skill(skill: Column, min_length: int = 2) -> Column:
    """Match key of a skill name; null when it is too short to mean anything."""
    text = F.regexp_replace(fold_accents(F.lower(F.trim(skill))), r"[\s\x85\p{Z}_/|;,]+", " ")
    text = collapse(F.regexp_replace(text, r"[^0-9a-zA-Z#+. ]", " "))
    return let(text, lambda t: F.when(F.length(t) >= min_length, t))


def _has_upper(text: Column) -> Column:
    return text.rlike(r"\p{Lu}")


def is_reasonable_skill(token: Column) -> Column:
    """Reject fragments: too short, vowel-free, or phrases of tiny words."""

    def judge(raw: Column) -> Column:
        plain = fold_accents(raw)
        low = F.lower(plain)
        readable = low.rlike("[a-z]") & low.rlike("[aeiouy]")
        single = (
            F.when(plain.rlike(r"\d"), True)
            .when(_has_upper(raw) & ~raw.rlike(r"\p{Ll}"), True)
            .when(raw.rlike(r"^\p{Lu}[^\p{Lu}]*\p{Ll}[^\p{Lu}]*$"), F.length(low) >= 3)
            .otherwise(
                (F.length(low) >= 5)
                & (F.length(F.regexp_replace(low, "[^bcdfghjklmnpqrstvwxyz]", "")) >= 2)
            )
        )
        phrase = (F.length(F.replace(low, F.lit(" "), F.lit(""))) >= 4) & low.rlike(r"\S{4,}")
        return readable & F.when(low.rlike(r"\S\s+\S"), phrase).otherwise(single)

    return F.coalesce(let(F.trim(token), judge), F.lit(False))


def split_span(span: Column) -> Column:
    """Split one extracted span into clean skill names (array, in order)."""
    text = F.regexp_replace(strip_space(span), r"^[()\[\]\"' ]+|[()\[\]\"' ]+$", "")
    text = F.translate(text, "–—…", "--.")
    text = split_camel(text)
    text = F.regexp_replace(text, r"^[\s\x85\p{Z}.,;:!?\-]+|[\s\x85\p{Z}.,;:!?\-]+$", "")
    text = F.regexp_replace(collapse(text), r"(?<=\S) \p{Lu}$", "")
    parts = F.transform(F.split(text, r"[,/;]"), lambda p: F.trim(p))
    return F.coalesce(F.filter(parts, is_reasonable_skill), F.array().cast("array<string>"))


# Names kept although the noise rules would drop them.
NOISE_WHITELIST = (
    "AI", "AR", "VR", "UI", "UX", "C#", "Go", "R", ".NET", "3ds Max", "5why", "5 whys", "7 wastes",
    "7 quality tools", "7 security operations", "7qc tools", "8d scar", "5 quality tools",
    "5-axis cnc milling", "5m1e", "4-point inspection system", "4m1e", "6signma", "3d printing",
    "3d printer", "3d studio max", "3d mockup", "3d solid modeling", "3d electrical design",
    "3d coordination", "360-degree feedback",
)


# Fixed value: lower-case letters that start a sentence fragment (Latin a-z and Vietnamese).
FRAGMENT_START = (
    "[a-zđăâêôơưáàảãạắằẳẵặấầẩẫậéèẻẽẹếềểễệíìỉĩịóòỏõọốồổỗộớờởỡợúùủũụứừửữựýỳỷỹỵ]"
)


def is_noise(canonical: Column, keep: Sequence[str] = NOISE_WHITELIST) -> Column:
    text = F.trim(canonical)
    return F.when(text.isin(*keep), False).otherwise(
        (F.length(text) <= 2)
        | text.rlike(r"^[.\-&#*/()\[\]_+~,;:!?]")
        | text.rlike(r"^\d+\s")
        | ((F.length(text) > 20) & text.rlike("^" + FRAGMENT_START))
    )


def _keeps_case(word: Column) -> Column:
    mixed = _has_upper(word) & word.rlike(r"\p{Ll}")
    acronym = _has_upper(word) & ~word.rlike(r"\p{Ll}") & (F.length(word) >= 2)
    return mixed | acronym | word.rlike(r"\d") | ~word.rlike(r"[\p{Lu}\p{Ll}]")


def smart_capitalize(text: Column) -> Column:
    """Sentence case that leaves acronyms, digits and mixed case alone."""
    words = F.split(collapse(text), " ")
    joined = F.array_join(F.transform(words, lambda w: F.when(_keeps_case(w), w).otherwise(F.lower(w))), " ")

    def sentence(t: Column) -> Column:
        return F.concat(F.upper(F.substring(t, 1, 1)), F.substring(t, F.lit(2), F.length(t)))

    return F.when(collapse(text) == "", text).otherwise(let(joined, sentence))


def smart_title(text: Column) -> Column:
    """Title case that leaves upper-case words and words with digits alone."""
    words = F.split(collapse(text), " ")

    def title(word: Column) -> Column:
        upper = _has_upper(word) & ~word.rlike(r"\p{Ll}")
        return F.when(upper | word.rlike(r"\d"), word).otherwise(
            F.concat(F.upper(F.substring(word, 1, 1)), F.lower(F.substring(word, F.lit(2), F.length(word))))
        )

    return F.array_join(F.transform(words, title), " ")


def merge_lists(*lists: Column, fold: bool = False) -> Column:
    """Union of arrays in first-seen order; ``fold`` compares accent- and case-insensitively."""
    empty = F.array().cast("array<string>")
    every = F.filter(F.concat(*[F.coalesce(a, empty) for a in lists]), lambda s: s.isNotNull() & (s != ""))
    if not fold:
        return F.array_distinct(every)

    def first_of_each(items: Column) -> Column:
        keys = F.transform(items, unaccent)
        return let(
            keys,
            lambda k: F.filter(items, lambda s, i: F.array_position(k, F.get(k, i)) == i + 1),
        )

    return let(every, first_of_each)


def weighted_text(parts: Sequence[tuple[Column, int]], label: Sequence[str] | None = None) -> Column:
    """Concatenate texts, each repeated by its weight, so that frequent fields weigh more."""
    names = label or [""] * len(parts)
    pieces = []
    for (text, weight), name in zip(parts, names, strict=True):
        value = non_empty(F.trim(text.cast("string")))
        head = f"{name}: " if name else ""
        body = F.concat_ws(" ", *[F.concat(value, F.lit("."))] * weight)
        pieces.append(F.when(value.isNotNull(), F.concat(F.lit(head), body)))
    return F.concat_ws(" ", *pieces)


def truncate_words(text: Column, length: int = 80) -> Column:
    """At most ``length`` characters, cut back to the last space, with an ellipsis."""
    head = F.substring(text, 1, length)
    return F.when(F.length(text) <= length, text).otherwise(
        F.concat(F.regexp_replace(head, r"(?s) [^ ]*$", ""), F.lit("..."))
    )
