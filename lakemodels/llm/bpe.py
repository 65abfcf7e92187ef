"""BPE encoding without a merge loop, and decoding.

A word is a string of symbols (bytes; the last one carries the end-of-word mark). For every prefix
there is exactly one token that its encoding ends with, so one left-to-right pass fills a table:

* the tokens that end at a position come from an automaton with suffix links over the vocabulary;
* such a token is the last one of the prefix if what is before it is empty, or ends with a token
  that fits: two tokens fit if merging their joined symbols would give the two again;
* back-pointers from the last position give the ids.

The fit test follows the merge trees of both tokens along their common border. A merge across the
border must have a lower rank than the merge that consumes its left part and not a higher one than
the merge that consumes its right part (of equal pairs the leftmost is merged first).

The vocabulary file is read once on the driver and sent to the tasks: its size is that of the file,
checked against ``MOST_BYTES``. Words and white-space-free pieces of text are remembered per task,
as many as a parameter allows.

Null and empty texts give no ids and an empty decoded text. Rows are encoded one by one, so ties,
repeated rows and null ids need no rule; other columns pass through, except that columns with the
names of result columns are replaced. Letters that Unicode assigned after version 15.1 follow the
tables of the Python libraries here, which can differ from those of another implementation.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
import unicodedata

import ahocorasick
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from lakemodels.llm.common import map_rows
from lakemodels.llm.plans import PLANS, read

MOST_BYTES = 64 << 20
REMEMBERED = 200_000
_NEVER = 1 << 60


class WordBpe:
    """Encoder and decoder of a vocabulary of words with an end mark, lower case, white space dropped."""

    def __init__(self, source: str, remembered: int = REMEMBERED):
        described = json.loads(source)
        model = described["model"]
        self.mark = model["end_of_word_suffix"]
        self.pieces = {number: piece for piece, number in model["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in described["added_tokens"]}
        self.pieces.update({number: text for text, number in self.special.items()})
        split = next(p for p in described["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self._words = regex.compile(split["pattern"]["Regex"])
        self._special = re.compile("|".join(map(re.escape, self.special))) if self.special else None
        self._remembered = remembered
        self._build(model)
        self._word_ids: dict[str, tuple[int, ...]] = {}
        self._known: dict[str, tuple[int, str, str]] = {}
        self._pair_fits: dict[int, bool] = {}

    def _build(self, model: dict) -> None:
        vocab, mark = model["vocab"], self.mark
        shown = _shown_bytes()
        self._symbols = {}
        symbol_of = {}
        for byte, sign in shown.items():
            for end, offset in (("", 0), (mark, 256)):
                if sign + end in vocab:
                    self._symbols[chr(byte + offset)] = vocab[sign + end]
                    symbol_of[vocab[sign + end]] = chr(byte + offset)
        self._merged: dict[tuple[int, int], tuple[int, int]] = {}
        self._parts: dict[int, tuple[int, int, int]] = {}
        text_of = dict(symbol_of)
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            ids = vocab[left], vocab[right]
            whole = vocab[left + right]
            self._merged[ids] = (rank, whole)
            self._parts.setdefault(whole, (*ids, rank))
            text_of[whole] = text_of[ids[0]] + text_of[ids[1]]
        self._automaton = ahocorasick.Automaton()
        self._spines: tuple[dict, dict] = ({}, {})
        self._stable: dict[int, bool] = {}
        for number, text in text_of.items():
            if self.stable(number):
                self._automaton.add_word(text, (number, len(text)))
        self._automaton.make_automaton()
        self._text = text_of

    def _spine(self, token: int, side: int) -> list[tuple[int, int]]:
        """From the symbol at an edge of a token (0: left, 1: right) up to the token: node, rank that consumes it."""
        cached = self._spines[side]
        if token not in cached:
            spine, consumed, node = [(token, _NEVER)], 0, token
            while node in self._parts:
                consumed = self._parts[node][2]
                node = self._parts[node][side]
                spine.append((node, consumed))
            cached[token] = spine[::-1]
        return cached[token]

    def fits(self, left: int, right: int) -> bool:
        """Whether the two tokens next to each other are what their joined symbols are encoded to."""
        merged = self._merged
        left_spine, right_spine = self._spine(left, 1), self._spine(right, 0)
        i = j = 0
        while True:
            x, x_ends = left_spine[i]
            y, y_ends = right_spine[j]
            found = merged.get((x, y))
            if found is not None and found[0] < x_ends and found[0] <= y_ends:
                return False
            if x_ends == y_ends == _NEVER:
                return True
            if x_ends <= y_ends:
                i += 1
            else:
                j += 1

    def stable(self, token: int) -> bool:
        """Whether the token's own symbols are encoded to it."""
        known = self._stable.get(token)
        if known is None:
            parts = self._parts.get(token)
            known = parts is None or (
                self.stable(parts[0]) and self.stable(parts[1]) and self._joins(parts[0], parts[1], parts[2])
            )
            self._stable[token] = known
        return known

    def _joins(self, left: int, right: int, rank: int) -> bool:
        """Whether no merge across the border of both comes before the one that joins them."""
        left_spine, right_spine = self._spine(left, 1), self._spine(right, 0)
        i = j = 0
        while (x_ends := left_spine[i][1]) != _NEVER or right_spine[j][1] != _NEVER:
            y_ends = right_spine[j][1]
            found = self._merged.get((left_spine[i][0], right_spine[j][0]))
            if found is not None and found[0] < x_ends and found[0] <= y_ends:
                return False
            if x_ends <= y_ends:
                i += 1
            else:
                j += 1
        return True

    def encode_word(self, word: str) -> tuple[int, ...]:
        """Ids of one word (not empty, normalised), remembered."""
        raw = word.encode("utf-8", "surrogatepass").decode("latin-1")
        symbols = raw[:-1] + chr(ord(raw[-1]) + 256)
        last: list[int | None] = [None] * (len(symbols) + 1)
        back = [0] * (len(symbols) + 1)
        pairs = self._pair_fits
        for end, (token, length) in self._automaton.iter(symbols):
            at = end + 1
            if last[at] is not None:
                continue
            begin = at - length
            if begin:
                left = last[begin]
                if left is None:
                    continue
                key = left << 20 | token
                fit = pairs.get(key)
                if fit is None:
                    fit = pairs[key] = self.fits(left, token)
                if not fit:
                    continue
            last[at], back[at] = token, begin
        if len(pairs) > 4 * self._remembered:
            pairs.clear()
        ids: list[int] = []
        at = len(symbols)
        while at:
            if last[at] is None:
                raise ValueError(f"The vocabulary cannot spell {word!r}")
            ids.append(last[at])
            at = back[at]
        if len(self._word_ids) > self._remembered:
            self._word_ids.clear()
        out = self._word_ids[word] = tuple(ids[::-1])
        return out

    def normal(self, text: str) -> str:
        """Composed and lower-cased, letter by letter."""
        # Capital sigma has a second lower-case form at the end of words, which the vocabulary's rule does not use.
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()

    def _encode_normal(self, text: str) -> list[int]:
        """Ids of a normalised text without special tokens."""
        out: list[int] = []
        for word in self._words.findall(text):
            out += self._word_ids.get(word) or self.encode_word(word)
        return out

    def encode(self, text: str | None) -> list[int]:
        """Ids of a text. Special tokens are found before anything else, as they are spelled."""
        out: list[int] = []
        at = 0
        for found in self._special.finditer(text or "") if self._special else ():
            out += self._encode_normal(self.normal(text[at : found.start()]))
            out.append(self.special[found[0]])
            at = found.end()
        return out + self._encode_normal(self.normal((text or "")[at:]))

    def decode(self, ids: list[int] | tuple[int, ...]) -> str:
        """Pieces joined by a space, special tokens included; the vocabulary file names no other decoder."""
        return " ".join(map(self.pieces.__getitem__, ids))

    def digest(self, text: str | None) -> tuple[int, str, str]:
        """(number of ids, ids joined by a space, decoded text), piece by piece between white space."""
        if not text:
            return 0, "", ""
        # Control characters that split() takes for white space and the rule does not.
        if not _ODD_SPACE.isdisjoint(text):
            ids = self.encode(text)
            return len(ids), " ".join(map(str, ids)), self.decode(ids)
        known = self._known
        if len(known) > self._remembered:
            known.clear()
        n, ids, decoded = 0, [], []
        plain = self._special is None or self._special.search(text) is None
        encode = self._encode_normal if plain else self.encode
        for chunk in (self.normal(text) if plain else text).split():
            found = known.get(chunk)
            if found is None:
                numbers = encode(chunk)
                found = known[chunk] = (len(numbers), " ".join(map(str, numbers)), self.decode(numbers))
            if found[0]:
                n += found[0]
                ids.append(found[1])
                decoded.append(found[2])
        return n, " ".join(ids), " ".join(decoded)


_ODD_SPACE = frozenset("\x1c\x1d\x1e\x1f")


def _shown_bytes() -> dict[int, str]:
    """The sign that stands for each byte in byte-level vocabularies: itself if printable, else one past U+00FF."""
    out, extra = {}, 0
    for byte in range(256):
        if 33 <= byte <= 126 or 161 <= byte <= 172 or 174 <= byte <= 255:
            out[byte] = chr(byte)
        else:
            out[byte] = chr(256 + extra)
            extra += 1
    return out


def vocabulary(path: str) -> str:
    """The vocabulary file, read on the driver."""
    with open(path, encoding="utf-8") as file:
        source = file.read(MOST_BYTES)
        if file.read(1):
            raise ValueError(f"{path} is larger than {MOST_BYTES} bytes")
    return source


@functools.lru_cache(maxsize=1)
def _ready(source: str) -> WordBpe:
    """The tables of a vocabulary, built once per Python worker."""
    return WordBpe(source)


ENCODED = "ids array<int>"
DIGESTS = "n_tokens long, ids_sha256 string, decoded_sha256 string"


def _mapped(documents: DataFrame, source: str, added: str, text: str, row) -> DataFrame:
    new = StructType.fromDDL(added)
    kept = documents.drop(*[c for c in documents.columns if c.lower() in new.names])
    names = kept.columns
    sent = documents.sparkSession.sparkContext.broadcast(source)

    def start():
        bpe = _ready(sent.value)

        def work(part):
            out = {name: part[name] for name in names}
            made = [row(bpe, value) for value in part[text]]
            for i, name in enumerate(new.names):
                out[name] = [m[i] for m in made]
            return out

        return work

    return map_rows(kept, StructType(kept.schema.fields + new.fields), start)


def encoded(documents: DataFrame, source: str, text: str = "text") -> DataFrame:
    """Add ``ids``, the token ids of every text."""
    return _mapped(documents, source, ENCODED, text, lambda bpe, value: (bpe.encode(value),))


def decoded(rows: DataFrame, source: str, ids: str = "ids") -> DataFrame:
    """Add ``decoded``, the text of every list of ids."""
    return _mapped(rows, source, "decoded string", ids, lambda bpe, value: (bpe.decode(value or []),))


def digests(documents: DataFrame, source: str, text: str = "text") -> DataFrame:
    """Add ``n_tokens`` and the SHA-256 of the joined ids and of the decoded text."""

    def row(bpe: WordBpe, value: str | None):
        n, ids, plain = bpe.digest(value)
        return n, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(plain.encode()).hexdigest()

    return _mapped(documents, source, DIGESTS, text, row)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 for every document."""
    documents = read(spark, sf_dir, "documents").select("doc_id", "text")
    return digests(documents, vocabulary(default_path())).drop("text")


PLANS["op7_bpe"] = op7_bpe
