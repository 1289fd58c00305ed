"""Column functions for text clean-up, lines and array helpers.

All of them work inside one row: no exchange, no Python worker. Inside a lambda
only lambda variables and literals are used, so that Catalyst cannot inline an
expensive parent expression into a per-element loop; ``bind`` gives a value a
name for that purpose.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
LINE_BREAK = "\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029]"

_WORD = r"[\p{L}\p{N}_]"
_REGEX_CLASSES = {
    r"\b": f"(?:(?<={_WORD})(?!{_WORD})|(?<!{_WORD})(?={_WORD}))",
    r"\w": _WORD,
    r"\d": r"\p{Nd}",
    r"\s": f"[{WHITESPACE}]",
}


def regex(pattern: str, ignore_case: bool = False) -> str:
    r"""Give ``\b \w \d \s`` their Unicode meaning whatever the Java version.

    A leading ``\b`` always stands before a word character here, so one
    look-behind is enough for it.
    """
    if pattern.startswith(r"\b"):
        pattern = f"(?<!{_WORD})" + pattern[2:]
    for short, full in _REGEX_CLASSES.items():
        pattern = pattern.replace(short, full)
    return ("(?iu)" if ignore_case else "") + pattern


def any_word(words) -> str:
    """Pattern for one of ``words`` standing alone, in any case."""
    return regex(rf"\b(?:{'|'.join(words)})\b", ignore_case=True)


def bind(value: Column, body) -> Column:
    """Evaluate ``value`` once per row and hand it to ``body`` as a variable."""
    return F.get(F.transform(F.array(value), lambda v: body(v)), F.lit(0))


def constant_array(values) -> Column:
    """A string array as one literal; Catalyst folds the split away."""
    return F.split(F.lit("\x1f".join(values)), "\x1f")


def constant_map(entries: dict) -> Column:
    """A string map as one literal, folded like ``constant_array``."""
    joined = "\x1f".join(f"{key}\x1e{value}" for key, value in entries.items())
    return F.str_to_map(F.lit(joined), F.lit("\x1f"), F.lit("\x1e"))


def strip(text: Column, chars: str = WHITESPACE) -> Column:
    return F.btrim(text, F.lit(chars))


def split_words(text: Column) -> Column:
    """Whitespace-separated words."""
    return F.filter(F.split(text, f"[{WHITESPACE}]+"), lambda w: w != "")


def clean_text(text: Column) -> Column:
    """Page text clean-up. Blank lines collapse before each line is stripped."""
    spaced = F.regexp_replace(F.replace(text, F.lit("\0"), F.lit(" ")), "[ \t]+", " ")
    collapsed = F.regexp_replace(spaced, "\n{3,}", "\n\n")
    lines = F.transform(F.split(collapsed, LINE_BREAK), lambda line: strip(line))
    return strip(F.array_join(lines, "\n"))


def normalize_text(text: Column) -> Column:
    spaced = F.replace(text, F.lit("\0"), F.lit(" "))
    return strip(F.regexp_replace(spaced, "\n{3,}", "\n\n"))


def collapse_whitespace(text: Column) -> Column:
    """Single-spaced text; a single space when nothing is left."""
    joined = F.trim(F.regexp_replace(text, f"[{WHITESPACE}]+", " "))
    return F.regexp_replace(joined, r"^\z", " ")


def raw_lines(text: Column) -> Column:
    return F.split(text, LINE_BREAK)


def meaningful_lines(text: Column) -> Column:
    """Lines without bullets and outer blanks; empty ones dropped."""
    stripped = F.transform(raw_lines(text), lambda line: strip(line, " -\t"))
    return F.filter(stripped, lambda line: line != "")


def keep_only(text: Column, characters: str) -> Column:
    """The text without any other characters; extracting is faster than replacing."""
    return F.array_join(F.regexp_extract_all(text, F.lit(f"[{characters}]+"), F.lit(0)), "")


def token_key(value: Column) -> Column:
    """Key under which two spellings of a term are the same."""
    return F.array_join(F.regexp_extract_all(F.lower(value), F.lit("[a-z0-9+#]+"), F.lit(0)), " ")


def capitalize_words(value: Column) -> Column:
    """Upper-case the first letter of each word and keep the rest."""
    words = F.transform(
        split_words(value),
        lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substr(w, F.lit(2))),
    )
    return F.array_join(words, " ")


def header_key(line: Column) -> Column:
    return F.trim(keep_only(F.lower(line), "a-z "))


def section_name(line: Column, aliases: dict) -> Column:
    """Section a header line opens, null for any other line."""
    lookup = constant_map({a: s for s, names in aliases.items() for a in names})
    return F.element_at(lookup, header_key(line))


def spans(lines: Column, label) -> Column:
    """Cut ``lines`` at each line ``label`` names: array<label, body lines>.

    Lines above the first labelled line belong to no span.
    """

    def cut(ls: Column) -> Column:
        marks = F.filter(
            F.transform(ls, lambda l, i: F.struct(label(l).alias("label"), i.alias("at"))),
            lambda m: m["label"].isNotNull(),
        )

        def bodies(ms: Column) -> Column:
            def body(m: Column, k: Column) -> Column:
                end = F.coalesce(F.get(ms, k + 1)["at"], F.size(ls))
                return F.struct(
                    m["label"].alias("label"),
                    F.slice(ls, m["at"] + 2, end - m["at"] - 1).alias("body"),
                )

            return F.transform(ms, lambda m, k: body(m, k))

        return bind(marks, bodies)

    return bind(lines, cut)


def sections(text: Column, aliases: dict) -> Column:
    return spans(raw_lines(text), lambda line: section_name(line, aliases))


def has_section(cut: Column, name: str) -> Column:
    return F.exists(cut, lambda s: s["label"] == name)


def section_text(cut: Column, name: str) -> Column:
    """Text under all headers of one section, in document order."""
    chosen = F.filter(cut, lambda s: s["label"] == name)
    body = F.flatten(F.transform(chosen, lambda s: s["body"]))
    return strip(F.array_join(body, "\n"))


def section_or(cut: Column, name: str, fallback: Column) -> Column:
    """Section text; ``fallback`` only when the header does not occur at all."""
    return F.when(has_section(cut, name), section_text(cut, name)).otherwise(fallback)


def first_by_key(items: Column, key) -> Column:
    """Order-preserving distinct on ``key(item)``; n log n in the array length."""
    keyed = F.transform(
        items,
        lambda v, i: F.struct(key(v).alias("key"), i.alias("at"), v.alias("item")),
    )
    firsts = bind(
        F.sort_array(keyed),
        lambda ks: F.filter(
            ks, lambda k, i: (i == 0) | (F.get(ks, i - 1)["key"] != k["key"])
        ),
    )
    ordered = F.sort_array(
        F.transform(firsts, lambda k: F.struct(k["at"].alias("at"), k["item"].alias("item")))
    )
    return F.transform(ordered, lambda k: k["item"])


def distinct_ignoring_case(values: Column) -> Column:
    return first_by_key(values, F.lower)


def distinct_terms(values: Column) -> Column:
    """Distinct on the token key; terms without any key character are dropped."""
    return first_by_key(F.filter(values, lambda v: token_key(v) != ""), token_key)


def term_keys(values: Column) -> Column:
    """Distinct token keys of a term list, in first-occurrence order."""
    keys = F.transform(values, token_key)
    return F.array_distinct(F.filter(keys, lambda k: k != ""))


def keyed_terms(values: Column) -> Column:
    """Distinct terms with their token key: array<key, term>, first spelling first."""
    return F.transform(
        distinct_terms(values), lambda v: F.struct(token_key(v).alias("key"), v.alias("term"))
    )


def _by_shared_key(have_keys: Column, required: Column, keep) -> Column:
    """Terms of the keyed terms for which ``keep(shared keys, key)`` holds.

    The keys of both sides meet once, by hash; terms are compared with those shared alone.
    """
    shared = F.array_intersect(F.transform(required, lambda r: r["key"]), have_keys)
    return bind(
        F.struct(required.alias("required"), shared.alias("shared")),
        lambda both: F.transform(
            F.filter(both["required"], lambda r: keep(both["shared"], r["key"])), lambda r: r["term"]
        ),
    )


def matching_terms(have_keys: Column, required: Column) -> Column:
    """Keyed terms whose key is among ``have_keys``, in required order (semi-join)."""
    return _by_shared_key(have_keys, required, F.array_contains)


def missing_terms(have_keys: Column, required: Column) -> Column:
    """Keyed terms whose key is not among ``have_keys``, in required order (anti-join)."""
    return _by_shared_key(have_keys, required, lambda shared, key: ~F.array_contains(shared, key))


def match_ratio(have_keys: Column, required_keys: Column) -> Column:
    """Share of distinct required keys present; 0.0 when nothing is required."""
    hits = F.size(F.array_intersect(required_keys, have_keys))
    return F.when(
        F.size(required_keys) > 0, hits.cast("double") / F.size(required_keys)
    ).otherwise(F.lit(0.0))
