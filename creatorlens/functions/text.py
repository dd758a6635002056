"""Text cleaning, tokenisation and lexicon counting as native expressions
(F1-F9, F15, T1, T2, J4, J5).

Regular expressions use explicit character classes so that Spark (Java regex)
and other engines agree with Unicode-aware ``\\w`` / ``\\s`` semantics:

* word character  ``[\\p{L}\\p{N}_]``
* white space     ``[\\t-\\r \\x1c-\\x1f\\x{85}\\p{Z}]``
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD_CLASS = r"[\p{L}\p{N}_]"
SPACE_CHARS = r"\t-\r \x1c-\x1f\x{85}\p{Z}"
SPACE_RUN = f"[{SPACE_CHARS}]+"
URL_PATTERN = rf"http[^{SPACE_CHARS}]+"
MENTION_PATTERN = rf"@{WORD_CLASS}+"
NON_LETTER_PATTERN = rf"[^a-zA-Z{SPACE_CHARS}]"


def _col(c):
    return F.col(c) if isinstance(c, str) else c


def remove_urls(text) -> Column:
    """drop ``http`` followed by non-space characters."""
    return F.regexp_replace(_col(text), URL_PATTERN, "")


def remove_mentions(text) -> Column:
    """drop ``@`` followed by word characters."""
    return F.regexp_replace(_col(text), MENTION_PATTERN, "")


def keep_letters(text) -> Column:
    """keep ASCII letters and white space only."""
    return F.regexp_replace(_col(text), NON_LETTER_PATTERN, "")


def clean_text(text) -> Column:
    """URLs, mentions, then every non-letter removed; lower-cased."""
    return F.lower(keep_letters(remove_mentions(remove_urls(text))))


def tokens(clean) -> Column:
    """White-space tokens of a cleaned text (empty pieces dropped)."""
    return F.filter(F.split(_col(clean), SPACE_RUN), lambda x: x != F.lit(""))


#: T2 in full: the Penn Treebank conventions as (pattern, replacement) in order, without look-around, so that any
#: regular-expression engine gives the same.  White space is written out; the text has a blank at both ends.
TREEBANK_RULES = [
    (r"([ (\[{<\t-\r])\"", r"$1`` "),
    (r"\.\.\.", r" ... "),
    (r"([:,])([^0-9])", r" $1 $2"),
    (r"[;@#$%&?!]", r" $0 "),
    (r"([^. \t-\r])(\.)([\])}>\"']*)[ \t-\r]+\z", r"$1 $2$3 "),
    (r"([^'])' ", r"$1 ' "),
    (r"[\]\[(){}<>]", r" $0 "),
    (r"--", r" -- "),
    (r"\"", r" '' "),
    (r"([^' \t-\r])('[sSmMdD])([ \t-\r])", r"$1 $2$3"),
    (r"([^' \t-\r])('ll|'LL|'re|'RE|'ve|'VE|n't|N'T)([ \t-\r])", r"$1 $2$3"),
    (r"([ \t-\r])([Cc])annot([ \t-\r])", r"$1$2an not$3"),
    (r"([ \t-\r])([Gg])onna([ \t-\r])", r"$1$2on na$3"),
    (r"([ \t-\r])([Gg])otta([ \t-\r])", r"$1$2ot ta$3"),
    (r"([ \t-\r])([Ww])anna([ \t-\r])", r"$1$2an na$3"),
    (r"([ \t-\r])([Gg])imme([ \t-\r])", r"$1$2im me$3"),
    (r"([ \t-\r])([Ll])emme([ \t-\r])", r"$1$2em me$3"),
    (r"([ \t-\r])'([Tt])(is|was)([ \t-\r])", r"$1'$2 $3$4"),
]


def treebank_tokens(text) -> Column:
    """T2 with contractions and punctuation: words, clitics (``n't``, ``'ll``), quotes, ellipses and marks as tokens of
    their own.  Null text: null."""
    t = F.concat(F.lit(" "), _col(text), F.lit(" "))
    for pattern, replacement in TREEBANK_RULES:
        t = F.regexp_replace(t, pattern, replacement)
    return F.filter(F.split(t, r"[ \t-\r]+"), lambda x: x != F.lit(""))


def word_tokens(text) -> Column:
    """The tokens of :func:`treebank_tokens` that hold a letter or digit, without punctuation at their ends (the
    apostrophe of a clitic stays)."""
    marks = r"!\"#$%&()*+,\-./:;<=>?@\[\\\]^_`{|}~"
    bare = F.transform(treebank_tokens(text), lambda x: F.regexp_replace(x, rf"\A[{marks}]+|[{marks}]+\z", ""))
    return F.filter(bare, lambda x: x.rlike(r"[\p{L}\p{N}]"))


def keyword_token_count(token_array, keywords: Sequence[str]) -> Column:
    """Number of tokens that are lexicon entries (duplicates counted).

    ``IN`` with many literals is rewritten by the optimizer into a hash-set
    probe, so each token costs one lookup regardless of the lexicon size.
    """
    words = sorted(set(keywords))
    if not words:
        return F.lit(0)
    return F.size(F.filter(_col(token_array), lambda x: x.isin(words)))


def _caseless(term: str) -> bool:
    """True when lower-casing any text cannot create or destroy an occurrence
    of ``term``: it has no letters (and not the combining dot that the
    lower-case of a dotted capital I produces)."""
    return all(not ch.isalpha() and ch != "\u0307" for ch in term)


def _char_ranges(chars: Sequence[str], gap: int = 512) -> list[tuple[int, int]]:
    """Code points merged into few ranges (neighbours closer than ``gap``
    join), a superset of ``chars`` that a regex class tests quickly."""
    out: list[list[int]] = []
    for cp in sorted({ord(c) for c in chars}):
        if out and cp - out[-1][1] <= gap:
            out[-1][1] = cp
        else:
            out.append([cp, cp])
    return [(a, b) for a, b in out]


def _prefilter(text: Column, terms: Sequence[str]) -> Column | None:
    """A cheap exact pre-test: false only when no term can occur in ``text``.

    One scan for any of the terms' first characters replaces one scan per
    term on texts that cannot match.  Many first characters become a regex
    class of a few code-point ranges (a superset, so the test stays exact).
    """
    firsts = sorted({t[0] for t in terms if t})
    if not firsts:
        return None
    if len(firsts) <= 4:
        return F.greatest(*[F.instr(text, ch) for ch in firsts], F.lit(0)) > 0
    return text.rlike(f"[{char_class(firsts)}]")


def char_class(chars) -> str:
    """The inside of a regular-expression class that holds ``chars`` (and few others)."""
    return "".join(f"\\x{{{a:X}}}" if a == b else f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in _char_ranges(list(chars)))


def overlaps_itself(term: str) -> bool:
    """Whether two occurrences of ``term`` can overlap (a proper prefix is also a suffix)."""
    return any(term[:i] == term[-i:] for i in range(1, len(term)))


def _trie_pattern(terms: Sequence[str]) -> str:
    """A regular expression in the shape of the terms' prefix tree; it matches the longest term at a place."""
    ends, below = "" in terms, {}
    for t in sorted(t for t in set(terms) if t):
        below.setdefault(t[0], []).append(t[1:])
    options = [f"\\x{{{ord(c):X}}}{_trie_pattern(rest)}" for c, rest in below.items()]
    if not options:
        return ""
    return f"(?:{'|'.join(options)})" + ("?" if ends else "")


def term_hits(text, terms: Sequence[str]) -> Column:
    """One pass over the text: at every place where a term starts, the longest such term."""
    return F.regexp_extract_all(_col(text), F.lit(f"(?=({_trie_pattern(terms)}))"), F.lit(1))


def shorter_terms(terms: Sequence[str]) -> dict[str, list[str]]:
    """For the terms that start with other terms: those others, which occur wherever the term does."""
    known = set(terms)
    found = {t: [t[:i] for i in range(1, len(t)) if t[:i] in known] for t in known}
    return {t: own for t, own in sorted(found.items()) if own}


def _searched(text, terms: Sequence[str], case_insensitive: bool, lowered) -> tuple[Column, Column | None]:
    """The text to search, and a cheap test without which no term occurs.

    With ``case_insensitive`` the terms are searched in the lower-cased text
    (terms are used as given, so a term with capitals never matches).  The test
    runs on the raw text when every first character is caseless, so texts that
    cannot match never pay for ``lower``.  ``lowered``: an already lower-cased
    column of the same text.
    """
    raw = _col(text)
    low = (_col(lowered) if lowered is not None else F.lower(raw)) if case_insensitive else raw
    raw_ok = not case_insensitive or all(_caseless(x[0]) for x in terms)
    return low, _prefilter(raw if raw_ok else low, terms)


def count_occurrences(text, term: str) -> Column:
    """non-overlapping occurrences of ``term`` (left to right), measured in
    bytes so multi-code-point sequences count as one."""
    t = _col(text)
    n = len(term.encode("utf-8"))
    return ((F.octet_length(t) - F.octet_length(F.replace(t, F.lit(term), F.lit("")))) / F.lit(n)).cast("int")


def occurrence_total(text, terms: Sequence[str], case_insensitive: bool = False, lowered=None) -> Column:
    """total occurrences of every (distinct) term - an emoji sequence is
    matched as a whole, not per character.  One pass finds the places of all
    terms; those that can overlap themselves are counted apart, left to right."""
    terms = [x for x in dict.fromkeys(terms) if x]
    if not terms:
        return F.lit(0)
    low, pre = _searched(text, terms, case_insensitive, lowered)
    plain, again = [t for t in terms if not overlaps_itself(t)], [t for t in terms if overlaps_itself(t)]
    parts = [count_occurrences(low, t) for t in again]
    if plain:
        hits, inner = term_hits(low, plain), shorter_terms(plain)
        if inner:
            extra = F.create_map(*[x for t, own in inner.items() for x in (F.lit(t), F.lit(len(own)))])
            parts.append(F.aggregate(hits, F.lit(0), lambda n, h: n + 1 + F.coalesce(F.try_element_at(extra, h), F.lit(0))))
        else:
            parts.append(F.size(hits))
    total = sum(parts[1:], parts[0])
    return total if pre is None else F.when(pre, total).otherwise(F.lit(0))


def count_present(text, terms: Sequence[str], case_insensitive: bool = False, lowered=None) -> Column:
    """Number of distinct lexicon terms that occur as substrings (one pass)."""
    terms = [x for x in dict.fromkeys(terms) if x]
    if not terms:
        return F.lit(0)
    low, pre = _searched(text, terms, case_insensitive, lowered)
    found, inner = F.array_distinct(term_hits(low, terms)), shorter_terms(terms)
    if inner:
        names = F.create_map(*[x for t, own in inner.items() for x in (F.lit(t), F.array(*map(F.lit, [t, *own])))])
        found = F.array_distinct(F.flatten(F.transform(found, lambda h: F.coalesce(F.try_element_at(names, h), F.array(h)))))
    total = F.size(found)
    return total if pre is None else F.when(pre, total).otherwise(F.lit(0))


def profile_url(username, prefix: str = "https://instagram.com/") -> Column:
    """Profile link of a user name."""
    return F.concat(F.lit(prefix), _col(username).cast("string"))


def format_score(score, digits: int = 2) -> Column:
    """Score rounded for display (half-up, like ``toFixed``)."""
    return F.round(_col(score), digits)
