"""Byte-level BPE by prefix dynamic programming: encoding, decoding, appends and edits.

Every prefix of a byte string has exactly one valid last token: a token that ends there and that follows
the last token of the prefix before it, which means that no merge across the border of the two comes
before the merges that make up either. With the last token of each prefix at hand, an append only looks at the new bytes, and an edit
is worked off from where it starts until the table agrees with the old one again.

A null text is an empty one; empty texts have no tokens. Repeated rows are encoded like any other, an
empty table gives an empty table, and only the named columns are read.
"""

import base64
import re
from array import array

import ahocorasick
import regex
from pyspark.sql import functions as F

from .common import map_texts, travels, worker_memory

travels(__name__)

#: Chunks, pieces and pairs of tokens a Python worker remembers of each; beyond that it starts anew.
REMEMBERED = 500_000
#: White space before a space: there, a space is not the start of a chunk of its own.
RUN = re.compile(r"\s ")


class Vocabulary:
    """Byte strings and their ranks, which are also their ids; lower ranks merge first."""

    def __init__(self, ranks):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.longest = max(map(len, ranks))
        self._follows, self._halves, self._edges = {}, {}, {}
        #: Finds the tokens that end at a byte, the longest first, with their lengths. Tokens whose own
        #: bytes are encoded as something else are left out, as they are never a result.
        self.usable = ahocorasick.Automaton()
        for token, rank in ranks.items():
            if self._is_usable(token, rank):
                self.usable.add_word(token.decode("latin-1"), (rank, len(token)))
        self.usable.make_automaton()

    @classmethod
    def parse(cls, lines):
        """From the lines of a rank file: base64 of the bytes, space, rank."""
        pairs = (line.split() for line in lines.splitlines() if line.strip())
        return cls({base64.b64decode(token): int(rank) for token, rank in pairs})

    def merge(self, data, stop=None):
        """Ids of a short byte string by merging its best pair again and again, but not to `stop`."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            best, at = min(
                (self.ranks.get(a + b, 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))
            )
            if best == 1 << 60 or stop == parts[at] + parts[at + 1]:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[part] for part in parts]

    def halves(self, token):
        """The two tokens that a token is merged from; itself and None if it is one byte."""
        if token not in self._halves:
            parts = self.merge(self.tokens[token], stop=self.tokens[token])
            self._halves[token] = tuple(parts) if len(parts) == 2 else (token, None)
        return self._halves[token]

    def _is_usable(self, data, rank):
        return len(data) == 1 or self.merge(data) == [rank]

    def _edge(self, token, side):
        """Tokens at one end of a token as it grows, each with the rank of the merge that ends it."""
        key = token << 1 | side
        if key not in self._edges:
            edge, upper = [], 1 << 60
            while token is not None:
                edge.append((self.tokens[token], upper))
                upper = token
                halves = self.halves(token)
                token = None if halves[1] is None else halves[side]
            self._edges[key] = edge[::-1]
        return self._edges[key]

    def follows(self, left, right):
        """Whether `right` can come after `left` in an encoding.

        Both grow from bytes to their border as merging goes on, the lower rank first. A merge of the two
        parts at the border must never come before the next merge of either; of equal ranks the one
        further left comes first.
        """
        key = left << 32 | right
        known = self._follows.get(key)
        if known is None:
            if len(self._follows) >= REMEMBERED:
                self._follows.clear()
            known = self._follows[key] = self._holds(self._edge(left, 1), self._edge(right, 0))
        return known

    def _holds(self, lefts, rights):
        i = j = 0
        while True:
            (a, upper_a), (b, upper_b) = lefts[i], rights[j]
            across = self.ranks.get(a + b)
            if across is not None and across < upper_a and across <= upper_b:
                return False
            if upper_a <= upper_b:
                if upper_a == 1 << 60:
                    return True
                i += 1
            else:
                j += 1

    def decode(self, ids):
        """Bytes of ids."""
        return b"".join(map(self.tokens.__getitem__, ids))


class Prefixes:
    """Last token of the encoding of each prefix of a byte string."""

    def __init__(self, vocabulary, data=b""):
        self.vocabulary, self.data, self.last = vocabulary, b"", []
        self.append(data)

    def _extend(self, begin):
        """Find the one valid last token of each prefix longer than `begin` in turn; yield them."""
        v, last = self.vocabulary, self.last
        known, done = v._follows.get, begin - 1
        text = self.data.decode("latin-1")
        for end, (token, length) in v.usable.iter(text, max(0, begin - v.longest)):
            if end <= done:
                continue
            if end > done + 1:
                break
            start = end + 1 - length
            if start:
                left = last[start - 1]
                holds = known(left << 32 | token)
                if holds is None:
                    holds = v.follows(left, token)
                if not holds:
                    continue
            last.append(token)
            done = end
            yield token
        if len(last) < len(text):
            raise ValueError("the vocabulary lacks a byte of the text")

    def append(self, data):
        """Add bytes; the entries there are stay as they are."""
        begin = len(self.data)
        self.data += data
        for _ in self._extend(begin):
            pass

    def replace(self, start, end, new):
        """Put `new` in place of the bytes from `start` to `end`; returns how many entries were found anew.

        An entry depends on the bytes and entries of the longest token before it, so once as many
        entries in a row are the old ones, the rest are.
        """
        old = self.last[end:]
        self.data = self.data[:start] + new + self.data[end:]
        del self.last[start:]
        alike, edited = 0, start + len(new)
        for at, token in enumerate(self._extend(start), start + 1):
            if at > edited:
                alike = alike + 1 if old[at - edited - 1] == token else 0
                if alike >= self.vocabulary.longest:
                    self.last.extend(old[at - edited :])
                    return at - start
        return len(self.data) - start

    def ids(self):
        """Ids of the whole, from its end back."""
        found, at = [], len(self.data)
        while at:
            found.append(self.last[at - 1])
            at -= len(self.vocabulary.tokens[found[-1]])
        return found[::-1]


class Encoder:
    """Texts to ids, as little-endian bytes of four each."""

    def __init__(self, vocabulary, pattern):
        self.vocabulary = vocabulary
        self.split = regex.compile(pattern).findall
        self.pieces = _Known(self._piece)
        self.first = _Known(self._chunk)
        self.later = _Known(lambda text: self._chunk(" " + text))

    def _piece(self, text):
        data = text.encode()
        # a piece that is a token as a whole is not looked into
        token = self.vocabulary.ranks.get(data)
        ids = [token] if token is not None else Prefixes(self.vocabulary, data).ids()
        return array("I", ids).tobytes()

    def _chunk(self, text):
        return b"".join(map(self.pieces.__getitem__, self.split(text)))

    def encode(self, text):
        """Ids of a text.

        A space after anything but white space starts a piece, whatever comes next, so texts fall into
        chunks at such spaces that are encoded and remembered one by one.
        """
        if RUN.search(text):
            return self._chunk(text)
        first, *rest = text.split(" ")
        return self.first[first] + b"".join(map(self.later.__getitem__, rest))


class _Known(dict):
    """What `function` gave for short texts; a text that isn't there is put there."""

    def __init__(self, function):
        super().__init__()
        self.function = function

    def __missing__(self, text):
        found = self.function(text)
        if len(text) <= 40:
            if len(self) >= REMEMBERED:
                self.clear()
            self[text] = found
        return found


def _encoder(lines, pattern):
    """One encoder for a worker, with what it remembers."""
    memory, key = worker_memory(), (hash(lines), pattern)
    if memory.get("encoder_of") != key:
        memory["encoder"] = Encoder(Vocabulary.parse(lines), pattern)
        memory["encoder_of"] = key
    return memory["encoder"]


def _shared_lines(spark, path):
    """The rank file, read by the driver and sent to each executor once; it has a fixed size."""
    with open(path, "rb") as file:
        return spark.sparkContext.broadcast(file.read())


def encode(docs, path, pattern, id_col="doc_id", text_col="text"):
    """`doc_id` and `ids` of each text: ids as little-endian unsigned integers of four bytes."""
    lines = _shared_lines(docs.sparkSession, path)

    def rows(keys, texts):
        encoder = _encoder(lines.value, pattern)
        return keys, [encoder.encode(text or "") for text in texts]

    kind = dict(docs.dtypes)[id_col].replace("bigint", "long")
    columns = [F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")]
    return map_texts(docs, columns, f"doc_id {kind}, ids binary", rows)


def decode(encoded, path, pattern, columns=("doc_id", "ids")):
    """`encoded` with `decoded`: the bytes of its ids. `columns` are the key and the ids."""
    lines = _shared_lines(encoded.sparkSession, path)

    def rows(keys, coded):
        vocabulary = _encoder(lines.value, pattern).vocabulary
        coded = [c or b"" for c in coded]
        texts = [vocabulary.decode(memoryview(c).cast("I")) for c in coded]
        return keys, coded, texts

    kind = dict(encoded.dtypes)[columns[0]].replace("bigint", "long")
    return map_texts(encoded, list(columns), f"{columns[0]} {kind}, {columns[1]} binary, decoded binary", rows)
