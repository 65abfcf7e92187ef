"""Secret scans: fixed patterns, and a linear-chain conditional random field for what they miss.

*Patterns.* ``assign``, ``access`` and ``hex`` as given below, leftmost and without overlap per
kind; matches that are too short are dropped after they were consumed.

*Field.* A text is a chain of tokens with the labels O (outside), B (secret begins) and I
(inside). Emissions are sums of weights for the token's own form (kinds of characters, length,
entropy, changes between kinds), its neighbours' classes and the file (share of tokens that are
not plain words); transitions are a 3 x 3 table. It is trained on pattern matches in a bounded
sample (``Settings.sample_rows``, ``Settings.sample_parts``), so it learns what secrets and their surroundings look
like, and tags secrets without a known key word. Viterbi finds the best labelling: a token whose
O leads by more than any two transitions can give back is O in the best path, so the chain is cut
at such tokens and only the runs between them are decoded, with the same result.

Field spans that touch a pattern span are not reported again; pattern spans always stay.

Null and empty texts have no spans. Rows are scored one by one, so repeated rows get equal
results; null ids stay. Offsets are code points, ends exclusive. Columns of the input pass
through; those with the names of result columns are replaced.
"""

from __future__ import annotations

import hashlib
import math
import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakemodels.llm.common import map_rows
from lakemodels.llm.plans import PLANS, read

# The patterns with their least lengths, in their order.
ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST = {"assign": 6, "access": 20, "hex": 24}
KINDS = ["assign", "access", "hex", "crf"]
# A run of 24 digits or letters a-f starts where a run does, so this finds the matches of HEX that stay.
_LONG_HEX = re.compile(r"[0-9a-f]{24,}")
KEY_WORDS = set(
    "password passwd pwd passphrase secret token api apikey api_key key keys private_key secret_key access_key "
    "auth authorization bearer credential credentials signature".split()
)

_TOKEN = re.compile(r"[\w+/.\-]+|[^\w\s]")
_DIGIT = re.compile(r"\d")

_HEX_DIGITS = set("0123456789abcdef")
# Every sign as the kind of character it is; a run of one kind is then cut to its first sign.
_KIND_OF = {c: "?" for c in range(128)} | {ord(c): "+" for c in "+/_.-"}
_KIND_OF |= {c: "a" for c in range(97, 123)} | {c: "A" for c in range(65, 91)} | {c: "0" for c in range(48, 58)}
_KINDS = re.compile(r"(.)(?=\1)", re.DOTALL)

# Sizes of the feature tables.
N_CLASS, N_MIX, N_LENGTH, N_DISTINCT, N_CHANGES, N_FILE = 12, 16, 9, 7, 6, 6
EDGE = 9
PART = 64


@dataclass(frozen=True)
class Settings:
    """Bounds of the training sample and steps of the fit."""

    sample_rows: int = 10_000
    sample_parts: int = 8_192
    steps: int = 120
    rate: float = 0.15
    penalty: float = 0.02
    least_length: int = 8


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the pattern matches that are long enough, by kind."""
    spans = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    spans += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST["access"]]
    spans += [(m.start(), m.end(), "hex") for m in _LONG_HEX.finditer(text)]
    return spans


def _secret_parts(text: str) -> list[tuple[int, int]]:
    """Where the secret itself lies in each pattern match: the value of an assignment, else the match."""
    parts = [m.span(2) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    return parts + [(a, b) for a, b, kind in base_spans(text) if kind != "assign"]


def _form(token: str) -> tuple[int, int, int, int, int]:
    """(class, mix, length, distinct signs, changes of kind) of a token, each a small number."""
    length = min(N_LENGTH - 1, int(math.log2(len(token)) * 1.5))
    if len(token) == 1 and not token.isalnum():
        kind = 2 if token == "=" else 3 if token == ":" else 4 if token in "\"'`" else 7
        return kind, 13, 0, 0, 0
    # A path behind a colon is written like a joined word, whatever it is made of.
    core = "a.b" if token.startswith("//") else token.strip(".-")
    distinct = min(N_DISTINCT - 1, int(math.log2(len(set(core)) or 1) * 1.5))
    if core.isalpha():
        mix = 0 if core.islower() else 2 if core.isupper() else 1 if core.istitle() else 8
        if not core.isascii():
            mix = 14
        kind = 1 if core.lower() in KEY_WORDS else 8 if mix in (1, 2, 8) else 0
        return kind, mix, length, distinct, 1 if mix == 8 else 0
    shown = core if core.isascii() else core.encode("ascii", "replace").decode()
    kinds = _KINDS.sub("", shown.translate(_KIND_OF))
    changes = min(N_CHANGES - 1, int(math.log2(1 + len(kinds))))
    lower, upper, digit, joint = (k in kinds for k in "aA0+")
    if "?" in kinds:
        mix = 14
    elif joint and ("+" in core or "/" in core):
        mix = 9
    elif joint:
        mix = 11 if digit and not (lower or upper) else 12 if digit else 10
    elif digit and not (lower or upper):
        mix = 3
    elif digit and lower and not upper:
        mix = 5 if set(core) - _HEX_DIGITS else 4
    elif digit and upper and not lower:
        mix = 6
    else:
        mix = 7
    if core.lower() in KEY_WORDS:
        kind = 1
    elif mix == 3:
        kind = 5
    elif mix in (4, 5, 6, 7, 9, 12):
        kind = 11 if len(core) >= 16 else 6
    else:
        kind = 8 if mix in (1, 2, 8) else 10 if mix in (10, 11) else 0
    return kind, mix, length, distinct, changes


class Forms(dict):
    """Forms of the tokens met, by number; forgets all when it holds too many.

    With a field it also keeps which tokens could be more than O in some surroundings.
    """

    def __init__(self, field: Field | None = None, limit: int = 300_000):
        super().__init__()
        self.limit = limit
        self.field = field
        self.opens: dict[tuple, bool] = {}
        self.table = np.zeros((1024, 5), np.int16)
        self.plain = np.zeros(1024, bool)
        self.open = np.zeros(1024, bool)

    def __missing__(self, token: str) -> int:
        n = len(self)
        if n == len(self.table):
            for name in ("table", "plain", "open"):
                old = getattr(self, name)
                setattr(self, name, np.concatenate([old, np.zeros_like(old)]))
        form = _form(token)
        self.table[n] = form
        self.plain[n] = form[1] <= 2 or form[1] in (10, 14)
        if self.field is not None:
            known = self.opens.get(form)
            if known is None:
                known = self.opens[form] = self.field.may_open(form)
            self.open[n] = known
        self[token] = n
        return n

    def numbers(self, tokens: list[str]) -> np.ndarray:
        """The number of each token; numbers hold until the next call."""
        if len(self) > self.limit:
            self.clear()
        return np.fromiter(map(self.__getitem__, tokens), np.int64, len(tokens))


def _file_class(plain: np.ndarray) -> int:
    """Share of tokens that are neither plain words nor words with a capital, in steps."""
    return min(N_FILE - 1, int((1 - plain.mean()) * 10)) if len(plain) else 0


# Feature tables, each with one number per token. The first five are the token's own.
TABLES = [N_CLASS, N_MIX, N_LENGTH, N_DISTINCT, N_CHANGES, N_CLASS, N_CLASS, N_CLASS, N_CLASS * N_MIX, N_FILE]
OFFSETS = np.concatenate([[0], np.cumsum(TABLES)])


def features(table: np.ndarray, numbers: np.ndarray, file: int, at: np.ndarray) -> np.ndarray:
    """Feature numbers of the tokens at some places: own form, classes at -1, -2, +1, class at -1 with own mix, file."""
    classes = np.concatenate([[EDGE, EDGE], table[numbers, 0], [EDGE]])
    own = table[numbers[at]]
    before = classes[at + 1]
    columns = [own[:, i] for i in range(5)] + [before, classes[at], classes[at + 3], before * N_MIX + own[:, 1]]
    columns.append(np.full(len(at), file))
    return np.stack(columns, axis=1).astype(np.int32) + OFFSETS[:-1].astype(np.int32)


@dataclass
class Field:
    """Weights of the features (rows) for O, B, I (columns), and transitions from row to column."""

    weights: np.ndarray
    moves: np.ndarray

    def __post_init__(self):
        moves, tables = self.moves, np.split(self.weights, OFFSETS[1:-1])
        # The most that another label than O can win back at both of its transitions.
        gain = [
            max(moves[p, x] - moves[p, 0] for p in range(3)) + max(moves[x, q] - moves[0, q] for q in range(3))
            for x in (1, 2)
        ]
        self._gain = np.maximum(0.0, gain)
        # The least by which a surrounding can favour O, for each mix of the token itself.
        lead = [t[:, :1] - t[:, 1:] for t in tables]
        around = sum(lead[i].min(axis=0) for i in (5, 6, 7, 9))
        self._around = around + lead[8].reshape(N_CLASS, N_MIX, 2).min(axis=0)
        self._own = lead[:5]

    def may_open(self, form: tuple[int, int, int, int, int]) -> bool:
        """Whether a token of this form can be another label than O anywhere; others are O on every best path."""
        own = sum(lead[i] for lead, i in zip(self._own, form, strict=True))
        return bool((own + self._around[form[1]] <= self._gain).any())

    def emissions(self, feature_numbers: np.ndarray) -> np.ndarray:
        return self.weights[feature_numbers].sum(axis=1)

    def decode(self, at: np.ndarray, scores: np.ndarray, n: int) -> list[tuple[int, int]]:
        """(first, last) token of every secret on the best path of n tokens, of which only those at ``at`` can be in one."""
        open_ = (scores[:, :1] - scores[:, 1:] <= self._gain).any(axis=1)
        at, scores = at[open_], scores[open_]
        found: list[tuple[int, int]] = []
        if not len(at):
            return found
        cuts = np.flatnonzero(np.diff(at) > 1) + 1
        for run, rows in zip(np.split(at, cuts), np.split(scores, cuts), strict=True):
            first, last = int(run[0]), int(run[-1])
            labels = self._best(rows, first > 0, last + 1 < n)
            begin = None
            for i, label in enumerate([*labels, 0]):
                if begin is not None and label != 2:
                    found.append((first + begin, first + i - 1))
                    begin = None
                if label == 1 or (label == 2 and begin is None):
                    begin = i
        return found

    def _best(self, scores: np.ndarray, after_o: bool, before_o: bool) -> list[int]:
        """Viterbi over one run; tokens beside it are O where there are any."""
        best = scores[0] + (self.moves[0] if after_o else 0.0)
        back = []
        for row in scores[1:]:
            ways = best[:, None] + self.moves
            back.append(ways.argmax(axis=0))
            best = ways.max(axis=0) + row
        if before_o:
            best = best + self.moves[:, 0]
        labels = [int(best.argmax())]
        for step in reversed(back):
            labels.append(int(step[labels[-1]]))
        return labels[::-1]


def fit(documents: DataFrame, settings: Settings = Settings()) -> Field:
    """Train on at most ``sample_parts`` parts of 64 tokens, out of at most ``sample_rows`` ids of (doc_id, text).

    Both are chosen by hashes, so the driver holds the same bounded parts however long the texts are.
    """
    order = F.xxhash64("doc_id")
    # sample_rows ids by parameter: this bounds the broadcast.
    chosen = documents.select("doc_id").where("doc_id is not null").distinct().orderBy(order, "doc_id").limit(settings.sample_rows)
    texts = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").where("text is not null")

    def start():
        known = Forms()

        def work(part):
            out: dict[str, list] = {"digest": [], "features": [], "labels": []}
            for number, text in zip(part["doc_id"], part["text"], strict=True):
                for at, numbers, labels in _training_parts(known, number, text):
                    out["digest"].append(_digest(f"{number}:{at}"))
                    out["features"].append(numbers.ravel().tolist())
                    out["labels"].append(labels.tolist())
            return out

        return work

    parts = map_rows(texts, "digest long, features array<int>, labels array<int>", start)
    rows = parts.orderBy("digest", "labels", "features").limit(settings.sample_parts).collect()
    rows = sorted((r["labels"], r["features"]) for r in rows)
    return train(rows, settings)


def _digest(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode(), digest_size=7).digest(), "big")


def _training_parts(known: Forms, number: object, text: str):
    """(place, features, labels) of parts of a text with a pattern match or a digit, and one plain part of every sixteenth text."""
    tokens, spans = _tokens(text)
    if not tokens:
        return
    ids = known.numbers(tokens)
    numbers = features(known.table, ids, _file_class(known.plain[ids]), np.arange(len(tokens)))
    labels = np.zeros(len(tokens), np.int8)
    starts = np.array([a for a, _ in spans])
    for a, b in sorted(_secret_parts(text), key=lambda s: s[0] - s[1]):
        first, last = np.searchsorted(starts, a, "right") - 1, np.searchsorted(starts, b, "left") - 1
        first = max(0, first if spans[max(0, first)][1] > a else first + 1)
        if last >= first and not labels[first : last + 1].any():
            labels[first] = 1
            labels[first + 1 : last + 1] = 2
    for at in range(0, len(tokens), PART):
        part = slice(at, at + PART)
        digits = not known.plain[ids[part]].all() and any(_DIGIT.search(t) for t in tokens[part])
        if labels[part].any() or digits or (at == 0 and _digest(str(number)) % 16 == 0):
            yield at, numbers[part], labels[part]


def _tokens(text: str) -> tuple[list[str], list[tuple[int, int]]]:
    spans = [m.span() for m in _TOKEN.finditer(text)]
    return [text[a:b] for a, b in spans], spans


def train(rows: list[tuple[list[int], list[int]]], settings: Settings = Settings()) -> Field:
    """Maximum likelihood with a ridge by Adam; rows are (labels, features of each token in one list)."""
    weights, moves = np.zeros((int(OFFSETS[-1]), 3)), np.zeros((3, 3))
    if not rows:
        weights[:N_CLASS, 0] = 20.0  # nothing to learn from: everything is outside
        return Field(weights, moves)
    n, width = len(rows), PART
    numbers = np.zeros((n, width, len(TABLES)), np.int32)
    gold = np.zeros((n, width), np.int8)
    there = np.zeros((n, width), bool)
    for i, (labels, flat) in enumerate(rows):
        numbers[i, : len(labels)] = np.array(flat, np.int32).reshape(len(labels), len(TABLES))
        gold[i, : len(labels)] = labels
        there[i, : len(labels)] = True
    one_hot = np.eye(3)[gold] * there[..., None]
    seen_moves = np.zeros((3, 3))
    np.add.at(seen_moves, (gold[:, :-1][there[:, 1:]], gold[:, 1:][there[:, 1:]]), 1)
    flat = numbers[there]
    state = [np.zeros_like(weights), np.zeros_like(weights), np.zeros_like(moves), np.zeros_like(moves)]
    for step in range(1, settings.steps + 1):
        marginal, moved = _expected(weights[numbers].sum(axis=2), moves, there)
        residual = (one_hot - marginal)[there]
        gradient = np.zeros_like(weights)
        for column in range(len(TABLES)):
            for label in range(3):
                gradient[:, label] += np.bincount(flat[:, column], residual[:, label], len(weights))
        gradient -= settings.penalty * weights
        change = seen_moves - moved - settings.penalty * moves
        for value, slope, first, second in ((weights, gradient, *state[:2]), (moves, change, *state[2:])):
            first *= 0.9
            first += 0.1 * slope
            second *= 0.99
            second += 0.01 * slope * slope
            value += settings.rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return Field(weights, moves)


def _expected(scores: np.ndarray, moves: np.ndarray, there: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Label marginals of every token and expected transition counts, by forward and backward sums in log space."""
    n, width, _ = scores.shape

    def total(x, axis):
        top = x.max(axis=axis, keepdims=True)
        return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)

    forward = np.zeros_like(scores)
    backward = np.zeros_like(scores)
    forward[:, 0] = scores[:, 0]
    for t in range(1, width):
        step = total(forward[:, t - 1, :, None] + moves, 1) + scores[:, t]
        forward[:, t] = np.where(there[:, t, None], step, forward[:, t - 1])
    for t in range(width - 2, -1, -1):
        step = total(moves + (scores[:, t + 1] + backward[:, t + 1])[:, None, :], 2)
        backward[:, t] = np.where(there[:, t + 1, None], step, 0.0)
    whole = total(forward[:, -1], 1)
    marginal = np.exp(forward + backward - whole[:, None, None]) * there[..., None]
    moved = np.zeros((3, 3))
    for t in range(1, width):
        pair = forward[:, t - 1, :, None] + moves + (scores[:, t] + backward[:, t])[:, None, :] - whole[:, None, None]
        moved += np.exp(pair[there[:, t]]).sum(axis=0)
    return marginal, moved


def spans_of(known: Forms, text: str | None, least_length: int = 8) -> list[tuple[int, int, str]]:
    """All spans of a text in the order start, kind: pattern matches, and field spans apart from them."""
    if not text:
        return []
    spans = base_spans(text)
    tokens = _TOKEN.findall(text)
    numbers = known.numbers(tokens)
    at = np.flatnonzero(known.open[numbers])
    if len(at):
        chosen = features(known.table, numbers, _file_class(known.plain[numbers]), at)
        secrets = known.field.decode(at, known.field.emissions(chosen), len(tokens))
        if secrets:
            places = [m.span() for m in _TOKEN.finditer(text)]
            taken = list(spans)
            for first, last in secrets:
                a, b = places[first][0], places[last][1]
                while b > a and text[b - 1] in ".-":
                    b -= 1
                while b < len(text) and text[b] == "=" and text[b - 1].isalnum():
                    b += 1
                if b - a >= least_length and all(b <= x or a >= y for x, y, _ in taken):
                    spans.append((a, b, "crf"))
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2])))


ADDED = "secrets array<struct<start:int,end:int,kind:string>>"


def scan(documents: DataFrame, field: Field, text: str = "text", least_length: int = 8) -> DataFrame:
    """Add ``secrets``, the spans of every text, to every row."""
    kept = documents.drop(*[c for c in documents.columns if c.lower() == "secrets"])
    names = kept.columns

    def start():
        known = Forms(field)

        def work(part):
            out = {name: part[name] for name in names}
            out["secrets"] = [
                [{"start": a, "end": b, "kind": kind} for a, b, kind in spans_of(known, value, least_length)]
                for value in part[text]
            ]
            return out

        return work

    return map_rows(kept, StructType(kept.schema.fields + StructType.fromDDL(ADDED).fields), start)


def redacted(text: str | None, spans: list[tuple[int, int]], mark: str = "[SECRET]") -> str | None:
    """The text with every run of touching or overlapping spans replaced by a mark."""
    if not text or not spans:
        return text
    out, at = [], 0
    for a, b in sorted(spans):
        if a >= at:
            out += [text[at:a], mark]
        at = max(at, b)
    return "".join(out) + text[at:]


def redact(documents: DataFrame, field: Field, mark: str = "[SECRET]", least_length: int = 8) -> DataFrame:
    """The rows with every secret of ``text`` replaced; ``n_chars`` follows where the column exists."""
    names, schema = documents.columns, documents.schema

    def start():
        known = Forms(field)

        def work(part):
            out = dict(part)
            out["text"] = [redacted(t, [s[:2] for s in spans_of(known, t, least_length)], mark) for t in part["text"]]
            if "n_chars" in names:
                out["n_chars"] = [
                    n if new is old or new == old else len(new)
                    for n, old, new in zip(part["n_chars"], part["text"], out["text"], strict=True)
                ]
            return out

        return work

    return map_rows(documents, schema, start)



def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, counts of the patterns, digest of their spans, and all spans as text, for every document."""
    documents = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = scan(documents, fit(documents)).select("doc_id", "secrets")
    count = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long")
    written = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )
    base = F.filter("secrets", lambda s: s["kind"] != "crf")
    return found.select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(written(base), 256).alias("base_sha256"),
        written("secrets").alias("spans"),
        count("crf").alias("n_crf"),
    )


PLANS["op2_secrets"] = op2_secrets
