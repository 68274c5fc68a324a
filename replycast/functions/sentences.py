"""Sentences of a text column whose abbreviations are known: built-in expressions, no Python."""

from pyspark.sql import functions as F

#: Marks the end of a sentence inside a text; not a character of written text.
END = "\x1e"


def split_tokens(text):
    """Tokens between white space; none for a null."""
    found = F.array_remove(F.split(text, r"[ \t\n\r\f\x0b]+"), "")
    return F.coalesce(found, F.array().cast("array<string>"))


def core(token):
    """Token without what surrounds its letters and digits, but with its closing periods."""
    return F.regexp_replace(token, r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}.]+$", "")


def ends_sentence(token, abbreviations=()):
    """Whether a token closes a sentence: it ends with closing punctuation and is no abbreviation.

    Not closing are listed abbreviations, single capitals (initials) and letters with periods between them
    ("e.g."). A decimal has no white space after its point, so it is one token.
    """
    word = core(token)
    # a mark other than one period closes a sentence whatever stands before it
    one_period = token.rlike(r"[^.!?]\.$")
    spared = word.rlike(r"^(?:\p{Lu}|\p{L}(?:\.\p{L})+)\.$")
    if abbreviations:
        spared |= F.lower(F.regexp_replace(word, r"\.+$", "")).isin(list(abbreviations))
    return token.rlike(r"[.!?]$") & ~(one_period & spared)


def sentences(text, abbreviations=()):
    """Sentences of a text in order, tokens joined by one space; none for a null or blank text.

    Pieces of punctuation alone are left out. An abbreviation never ends a sentence but at the end of the text.
    """
    marked = F.transform(
        split_tokens(text), lambda t: F.concat(t, F.when(ends_sentence(t, abbreviations), END).otherwise(""))
    )
    pieces = F.split(F.array_join(marked, " "), f"{END} ?")
    return F.filter(pieces, lambda s: s.rlike("[^.!? ]"))


def sentence_tokens(text, abbreviations=()):
    """One list of tokens for each sentence."""
    return F.transform(sentences(text, abbreviations), lambda s: F.split(s, " "))
