"""Word class of one word, by word list and suffix (no sentence context).

Tags follow the Penn Treebank names; counts use their prefixes V, N, PR, J and RB.
"""

# Closed word classes and frequent words of English.
WORD_TAGS = {
    "PRP": "i me myself we us ourselves you yourself he him himself she her herself it itself "
    "they them themselves one anyone someone everyone",
    "PRP$": "my our your his its their mine ours yours hers theirs",
    "DT": "the a an this that these those each every some any no all both",
    "IN": "of in on at by for from with without about into over under after before between "
    "through during since until than as if because while although though whether per like",
    "CC": "and or but nor so yet",
    "TO": "to",
    "MD": "can could may might must shall should will would",
    "WP": "who whom what which whose",
    "WRB": "how when where why",
    "VB": "be am is are was were been being have has had do does did get got make made use used "
    "need want try know think see find run set go went come take give let say said",
    "RB": "not very too also just now then here there never always often only still again "
    "already soon maybe perhaps even well almost quite rather however",
    "JJ": "new same other good bad better best different many more most few such own great "
    "small large big old high low long short first last next able",
}
# Endings tried in this order for other words; numbers come before them.
SUFFIX_TAGS = (
    (("ly",), "RB"),
    (("ing",), "VBG"),
    (("ed",), "VBD"),
    (("ize", "ise", "ify", "ate"), "VB"),
    (("able", "ible", "ful", "ous", "ive", "less", "ical", "ic", "al", "ish", "ary"), "JJ"),
)
NUMBER_TAG, PLURAL_TAG = "CD", "NNS"
DEFAULT_TAG = "NN"

COUNTED = {"verbs": "V", "nouns": "N", "pronouns": "PR", "adjectives": "J", "adverbs": "RB"}

_KNOWN = {word: tag for tag, words in WORD_TAGS.items() for word in words.split()}


def tag_word(word, lexicon=None):
    """Tag of one word: own lexicon, then word list, then ending."""
    word = word.lower()
    known = (lexicon or {}).get(word) or _KNOWN.get(word)
    if known:
        return known
    if word.isdecimal():
        return NUMBER_TAG
    for endings, tag in SUFFIX_TAGS:
        if word.endswith(endings):
            return tag
    return PLURAL_TAG if word.endswith("s") and not word.endswith("ss") else DEFAULT_TAG


def read_lexicon(table, max_words=200_000):
    """Lexicon table (token, tag) as a dictionary; raises if it is larger than allowed.

    The dictionary travels with the task, so its size is checked before it is read.
    """
    rows = table.select("token", "tag").limit(max_words + 1).collect()
    if len(rows) > max_words:
        raise ValueError(f"lexicon has more than {max_words} words")
    return {row.token.lower(): row.tag for row in rows}
