"""Porter stem of one word."""

# Suffix rules of the published Porter algorithm.
STEP_2 = {
    "ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize",
    "abli": "able", "alli": "al", "entli": "ent", "eli": "e", "ousli": "ous",
    "ization": "ize", "ation": "ate", "ator": "ate", "alism": "al", "iveness": "ive",
    "fulness": "ful", "ousness": "ous", "aliti": "al", "iviti": "ive", "biliti": "ble",
}
STEP_3 = {
    "icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "", "ness": "",
}
STEP_4 = (
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion",
    "ou", "ism", "ate", "iti", "ous", "ive", "ize",
)

# last two letters of the suffixes of a step: most words are passed over by one look-up
_ENDS_2, _ENDS_3, _ENDS_4 = ({s[-2:] for s in rules} for rules in (STEP_2, STEP_3, STEP_4))


def _shape(word):
    """One letter per character: v for a vowel, c for a consonant."""
    out = ""
    for ch in word:
        vowel = ch in "aeiou" or (ch == "y" and out.endswith("c"))
        out += "v" if vowel else "c"
    return out


def _measure(word):
    return _shape(word).count("vc")


def _double_end(word):
    return len(word) > 1 and word[-1] == word[-2] and _shape(word).endswith("c")


def _short_end(word):
    return _shape(word).endswith("cvc") and word[-1] not in "wxy"


def _longest(word, rules, ends):
    """Longest suffix of the rules (2 to 7 letters) that the word ends in."""
    if word[-2:] in ends:
        for n in range(min(7, len(word)), 1, -1):
            if word[-n:] in rules:
                return word[-n:]
    return None


def _plural(word):
    if word.endswith(("sses", "ies")):
        return word[:-2]
    return word if word.endswith("ss") else word[:-1]


def _past(word):
    if word.endswith("eed"):
        return word[:-1] if _measure(word[:-3]) > 0 else word
    rest = word[:-2] if word.endswith("ed") else word[:-3]
    if "v" not in _shape(rest):
        return word
    if rest.endswith(("at", "bl", "iz")):
        return rest + "e"
    if _double_end(rest):
        return rest if rest[-1] in "lsz" else rest[:-1]
    return rest + "e" if _measure(rest) == 1 and _short_end(rest) else rest


def _mapped(word, rules, ends):
    suffix = _longest(word, rules, ends)
    if suffix and _measure(word[: -len(suffix)]) > 0:
        return word[: -len(suffix)] + rules[suffix]
    return word


def _dropped(word):
    suffix = _longest(word, STEP_4, _ENDS_4)
    if suffix is None:
        return word
    rest = word[: -len(suffix)]
    allowed = suffix != "ion" or rest.endswith(("s", "t"))
    return rest if allowed and _measure(rest) > 1 else word


def _final(word):
    if word.endswith("e"):
        rest = word[:-1]
        m = _measure(rest)
        if m > 1 or (m == 1 and not _short_end(rest)):
            word = rest
    if word.endswith("ll") and _measure(word) > 1:
        word = word[:-1]
    return word


def porter(word):
    """Stem of one word, in lower case."""
    word = word.lower()
    if len(word) <= 2:
        return word
    if word.endswith("s"):
        word = _plural(word)
    if word.endswith(("ed", "ing")):
        word = _past(word)
    if word.endswith("y") and "v" in _shape(word[:-1]):
        word = word[:-1] + "i"
    word = _mapped(_mapped(word, STEP_2, _ENDS_2), STEP_3, _ENDS_3)
    return _final(_dropped(word))
