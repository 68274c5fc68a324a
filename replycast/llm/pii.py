"""Personal data by anchor expansion: an automaton finds cues, local parsers expand and check them.

One pass of an Aho-Corasick automaton over a text finds at-signs, schemes, plus signs, digits and words
that announce an identifier. A parser of the cue's kind walks from there to both ends of what it belongs
to and checks it. Spans are counted in code points, the end exclusive. A null or empty text has no spans.
Repeated rows are searched like any other, an empty table gives an empty table, and only the named
columns are read. A very long text is searched whole; parsers never go back over a span, so time follows length.

Cues and schemes are found in any case of A to Z. What a cue announces is an account number (an IBAN that
passes its check digits, in one run or in groups; otherwise six or more letters, digits and hyphens with four
digits, after words like "number" if any) or, after a colon or an equals sign, a secret of any four or more
characters.
"""

import re

import ahocorasick
from pyspark.sql import functions as F

from .common import map_texts, travels, worker_memory

travels(__name__)

#: Kinds in the order of the result: those every result has, then those the cues add.
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "url", "account")

# Cues of links and of identifiers.
SCHEMES = ("http://", "https://", "ftp://", "www.")
ACCOUNT_CUES = ("account", "acct", "iban", "konto", "kontonummer", "compte", "cuenta", "passport", "ssn")
SECRET_CUES = ("token", "api_key", "api-key", "api key", "apikey", "password", "passwd", "pwd", "secret")

LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
DIGITS = "0123456789"
LOCAL = frozenset(LETTERS + DIGITS + "._%+-")
LABEL = frozenset(LETTERS + DIGITS + "-")
PHONE = frozenset(DIGITS + " ().-")
ACCOUNT = frozenset(LETTERS + DIGITS + "-")
URL_STOP = frozenset("<>\"'`{}|\\^")
LOWER = str.maketrans(LETTERS[:26], LETTERS[26:])


def _run(text, at, allowed):
    """End of the run of allowed characters that starts there."""
    end = len(text)
    while at < end and text[at] in allowed:
        at += 1
    return at


def _run_back(text, at, allowed, least):
    """Start of the run of allowed characters that ends there."""
    while at > least and text[at - 1] in allowed:
        at -= 1
    return at


def email(text, at, free):
    """Address around an at-sign; `free` is where the last address ended."""
    start = _run_back(text, at, LOCAL, free)
    end = _run(text, at + 1, LABEL)
    if start == at or end == at + 1:
        return None
    labels = 1
    while end < len(text) and text[end] == ".":
        after = _run(text, end + 1, LABEL)
        if after == end + 1:
            break
        end, labels = after, labels + 1
    return (start, end, True) if labels > 1 else None


_DIGITS = re.compile("[0-9]+")
_ADDRESS = re.compile(r"[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile("[0-9](?:[ -]?[0-9])+")


def ip(text, at, free):
    """Four numbers with dots; `at` is the start of a run of digits."""
    found = _ADDRESS.match(text, at)
    if not found:
        return None
    valid = all(len(n.lstrip("0")) <= 3 and int(n.lstrip("0") or 0) <= 255 for n in found[0].split("."))
    return at, found.end(), valid


def luhn(digits):
    """Whether the last digit is the check digit of the others."""
    doubled = (sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (sum(map(int, digits[-1::-2])) + sum(doubled)) % 10 == 0


def card(text, at, free):
    """Digits with single spaces or hyphens between them, which pass the check digit."""
    found = _CARD.match(text, at)
    if not found:
        return None
    digits = found[0].replace(" ", "").replace("-", "")
    return at, found.end(), 16 <= len(digits) <= 19 and luhn(digits)


def phone(text, at, free):
    """A plus sign, a digit, then digits, spaces, brackets, dots and hyphens up to the last digit."""
    if text[at + 1 : at + 2] not in DIGITS or at + 1 >= len(text):
        return None
    end = _run(text, at + 2, PHONE)
    while end > at + 2 and text[end - 1] not in DIGITS:
        end -= 1
    if end < at + 4:
        return None
    return at, end, 8 <= sum(c in DIGITS for c in text[at:end]) <= 15


def url(text, at, free):
    """Scheme and what follows up to white space, without closing punctuation."""
    end = at
    while end < len(text) and not text[end].isspace() and text[end] not in URL_STOP:
        end += 1
    while end > at and text[end - 1] in ".,;:!?)]":
        end -= 1
    return at, end, "." in text[at:end].strip("wW.")


_FILLER = "number|numero|numéro|número|nummer|num|no|nr|id|is"
_ACCOUNT_LEAD = re.compile(rf"(?:[ \t]{{0,3}}(?:{_FILLER})\b){{0,2}}[ \t:=#\"'.]{{1,4}}", re.IGNORECASE)
_GROUPS = re.compile("[A-Za-z]{2}[0-9]{2}(?: ?[A-Za-z0-9]){11,30}")
_SECRET = re.compile(r"""["']?[ \t]{0,2}[:=][ \t]{0,2}["']?([^\s"'`<>,;()\[\]{}]{4,})""")


def iban(text, at):
    """End of the longest account number there that passes its check digits, or None.

    Groups may stand apart by one space; the number ends where a group does.
    """
    found = _GROUPS.match(text, at)
    if not found:
        return None
    whole = found[0]
    ends = [i for i, c in enumerate(whole) if c == " "]
    if not text[found.end() : found.end() + 1].isalnum():
        ends.append(len(whole))
    for end in reversed(ends):
        number = whole[:end].replace(" ", "").upper()
        if len(number) >= 15 and int("".join(str(int(c, 36)) for c in number[4:] + number[:4])) % 97 == 1:
            return at + end
    return None


def account(text, at, free):
    """Account number after a cue that ends there, after separators and words that say so."""
    lead = _ACCOUNT_LEAD.match(text, at)
    if not lead:
        return None
    start = lead.end()
    end = iban(text, start)
    if end:
        return start, end, True
    if text[at - 4 : at].translate(LOWER) == "iban":
        return None
    end = _run(text, start, ACCOUNT)
    while end > start and text[end - 1] == "-":
        end -= 1
    found = text[start:end]
    return start, end, len(found) >= 6 and sum(c in DIGITS for c in found) >= 4


def secret(text, at, free):
    """Secret after a cue that ends there and a colon or an equals sign, without closing punctuation."""
    found = _SECRET.match(text, at)
    if not found:
        return None
    start, end = found.span(1)
    while end > start and text[end - 1] in ".:!?":
        end -= 1
    return start, end, end - start >= 4


def _automaton():
    cues = ahocorasick.Automaton()
    cues.add_word("@", "@")
    cues.add_word("+", "+")
    for digit in DIGITS:
        cues.add_word(digit, "0")
    for scheme in SCHEMES:
        cues.add_word(scheme, len(scheme))
    for cue in ACCOUNT_CUES:
        cues.add_word(cue, "a")
    for cue in SECRET_CUES:
        cues.add_word(cue, "s")
    cues.make_automaton()
    return cues


def spans(text):
    """Spans of a text by kind: lists of (start, end)."""
    memory = worker_memory()
    if "cues" not in memory:
        memory["cues"] = _automaton()
    found = {kind: [] for kind in KINDS}
    if not text:
        return found
    free = dict.fromkeys(KINDS, 0)

    def expand(kind, parser, at):
        span = parser(text, at, free[kind])
        if span and span[1] > span[0]:
            # a span that fails its check is used up like one that passes
            free[kind] = span[1]
            if span[2]:
                found[kind].append(span[:2])

    digits_end = 0
    for end, cue in memory["cues"].iter(text.translate(LOWER)):
        if cue == "0":
            # runs of digits are expanded from their first digit
            if end >= digits_end:
                digits_end = _DIGITS.match(text, end).end()
                if end >= free["card"]:
                    expand("card", card, end)
                if free["ip"] < digits_end:
                    expand("ip", ip, max(end, free["ip"]))
        elif cue == "@":
            expand("email", email, end)
        elif cue == "+":
            expand("phone", phone, end)
        elif cue == "a":
            if end + 1 >= free["account"]:
                expand("account", account, end + 1)
        elif cue == "s":
            if end + 1 >= free["account"]:
                expand("account", secret, end + 1)
        elif end + 1 - cue >= free["url"]:
            expand("url", url, end + 1 - cue)
    return found


def find_pii(docs, id_col="doc_id", text_col="text"):
    """Spans of each whole text: `doc_id` and for each kind `n_<kind>` and
    `<kind>_spans`, written kind:start:end with commas between them."""

    def rows(keys, texts):
        all_spans = [spans(text) for text in texts]
        out = [keys]
        for kind in KINDS:
            out.append([",".join(f"{kind}:{s}:{e}" for s, e in found[kind]) for found in all_spans])
            out.append([len(found[kind]) for found in all_spans])
        return out

    kind = dict(docs.dtypes)[id_col].replace("bigint", "long")
    schema = ", ".join(f"{k}_spans string, n_{k} long" for k in KINDS)
    columns = [F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")]
    return map_texts(docs, columns, f"doc_id {kind}, {schema}", rows)


def joined(kinds):
    """The spans of these kinds in one string."""
    return F.concat_ws(",", *(F.nullif(F.col(f"{kind}_spans"), F.lit("")) for kind in kinds))
