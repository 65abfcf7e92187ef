"""Personal data: fixed patterns with checks, and a linear-chain conditional random field over word shapes.

*Patterns.* ``email``, ``ip``, ``card`` and ``phone`` as given below, leftmost and without overlap per kind; matches
that fail their check (parts, Luhn, number of digits) are dropped after they were consumed.

*Field.* It adds what the patterns miss: national telephone numbers, cards with other separators, written-out
mail addresses, IPv6, account and insurance numbers. A stretch is a row of neighbouring words with a digit, an
at-sign or a written one (a lone slash or dash between them joins them); its tokens (letters, digits, signs, gaps) are a chain with the labels O, B-kind and I-kind.
Everything outside of stretches is O by definition, so decoding them alone is exact. Features are the
shapes of the token and of two neighbours on each side, pairs of them, the number of digits of its group and whether these
pass Luhn, and the class of the key word before the stretch. Weights and transitions are fitted by maximum likelihood with a
ridge on a small labelled table (:func:`labelled_table`, or any other of its columns; at most ``Settings.max_rows`` rows).
Stretches are decoded by Viterbi in numpy batches of like length; a long one (a text of numbers is one stretch) alone, token by
token, so that a task keeps some 20 bytes of each of its tokens.

Field spans keep the checks of their kind, and those that touch a pattern span are not reported again. Pattern spans always stay.

Null and empty texts have no spans. Rows are scored one by one, so repeated rows get equal results; null ids
stay. Offsets are code points, ends exclusive. Columns of the input pass through; those with the names of
result columns are replaced. Without labelled rows the field finds nothing.
"""

from __future__ import annotations

import random
import re
from array import array
from bisect import bisect_left
from collections import deque
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import accumulate, chain, islice, pairwise

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakemodels.llm.common import map_rows
from lakemodels.llm.plans import PLANS, read

# The patterns in their order. EMAIL is applied from its sign outwards, see _emails.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
BASE = ["email", "ip", "card", "phone"]
FOUND = ["email", "ip", "card", "phone", "id"]
KINDS = BASE + [f"crf_{kind}" for kind in FOUND]

_LOCAL = set("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
# Digits start where their run does: if the run fails, so does every later start in it.
_WHOLE_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
# The matches of CARD, without a place to go back to for every digit.
_WHOLE_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_NOT_DIGITS = re.compile(r"[^0-9]+")


def digits_of(text: str) -> str:
    return _NOT_DIGITS.sub("", text)


def luhn(digits: str) -> bool:
    """Whether every second digit from the right, doubled, and the others sum to a multiple of ten."""
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def _number(part: str) -> int:
    """Its value; the field may also take letters and signs for a part of an address, which are above any value."""
    try:
        return int(part or 0)
    except ValueError:
        return 256


def _is_ip(text: str) -> bool:
    return all(len(part) <= 3 and _number(part) <= 255 for part in (p.lstrip("0") for p in text.split(".")))


def _is_card(text: str) -> bool:
    digits = digits_of(text)
    return 12 <= len(digits) <= 19 and luhn(digits)


def _is_phone(text: str) -> bool:
    return 9 <= len(digits_of(text)) <= 15


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of EMAIL, in time that grows with the text whatever it holds."""
    last, at = 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > last and text[begin - 1] in _LOCAL:
            begin -= 1
        domain = _DOMAIN.match(text, at) if begin < at else None
        if domain:
            last = domain.end()
            yield begin, last
        at = text.find("@", max(at + 1, last))


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the pattern matches that pass their checks, by kind."""
    spans = [(a, b, "email") for a, b in _emails(text)]
    for kind, pattern, check in (("ip", _WHOLE_IP, _is_ip), ("card", _WHOLE_CARD, _is_card), ("phone", PHONE, _is_phone)):
        spans += [(m.start(), m.end(), kind) for m in pattern.finditer(text) if check(m[0])]
    return spans


# ---------------------------------------------------------------- chains

_SEED = re.compile(r"[0-9@]|[\[(](?:at|AT)[\])]")
_SPACE = re.compile(r"\s")
_TOKEN = re.compile(r"[A-Za-z]+|[0-9]+|\s+|[^\W\d_]+|[\W_]|\d+")
_BARE = {"@", "[at]", "(at)", "[AT]", "(AT)"}
_BRIDGES = {"", "/", "-", "–"}
_WORD = re.compile(r"\w+")
# Words that announce personal data, by kind.
ANNOUNCE = {
    "phone": "phone tel telephone telefon mobile mobil handy cell call fax téléphone teléfono móvil ring whatsapp sms",
    "email": "mail email contact write kontakt correo courriel",
    "card": "card visa mastercard amex credit debit karte kreditkarte carte tarjeta",
    "ip": "ip address host server ping adresse",
    "id": "ssn social security iban account konto passport ausweis insurance tax vat id nif dni",
    "other": "version page order isbn total price chapter room key token password release build serial",
}
_ANNOUNCED = {word: kind for kind, words in ANNOUNCE.items() for word in words.split()}


def stretches(text: str) -> list[tuple[int, int]]:
    """(start, end) of neighbouring words with a digit or an at-sign; a lone at-sign draws in the words beside it."""
    out: list[tuple[int, int]] = []
    seed = _SEED.search(text)
    while seed:
        a, b = _word_around(text, seed.start())
        if text[a:b] in _BARE:
            left = len(text[:a].rstrip()) if a < 200 else a - 200 + len(text[a - 200 : a].rstrip())
            if 0 < left < a:
                a = _word_around(text, left - 1)[0]
            right = next((i for i in range(b, min(b + 200, len(text))) if not text[i].isspace()), None)
            if right is not None:
                b = _word_around(text, right)[1]
        if out and (a <= out[-1][1] or (a - out[-1][1] < 9 and text[out[-1][1] : a].strip() in _BRIDGES)):
            out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
        seed = _SEED.search(text, b)
    return out


def _word_around(text: str, at: int) -> tuple[int, int]:
    a = at
    while a and not text[a - 1].isspace():
        a -= 1
    end = _SPACE.search(text, at)
    return a, end.start() if end else len(text)


def _shape(token: str) -> str:
    """Digits by their number, letters by case and number, signs as they stand."""
    first = token[0]
    if "0" <= first <= "9":
        n = len(token)
        return f"0{n if n <= 8 else 9 if n <= 11 else 12 if n <= 15 else 16 if n <= 19 else 20}"
    if first.isalpha():
        case = "a" if token.islower() else "A" if token.isupper() else "Aa" if token.istitle() else "aA"
        return f"{case}{min(len(token), 4)}"
    if first.isspace():
        return "\n" if "\n" in token else " "
    return first if first.isascii() else "?"


# Digits with signs or one gap between them; tokens that begin with a digit of another script are passed over.
_GROUP = re.compile(r"(?![0-9])\d++|([0-9+\-.()/](?:[0-9+\-.()/]|\x20(?!\s))*+)")


def _groups(text: str, start: int, end: int) -> Iterator[tuple[int, int, str]]:
    """(start, end, name) of the groups of a stretch: the name is the number of digits and whether they pass Luhn."""
    for m in _GROUP.finditer(text, start, end):
        if m[1] is None:
            continue
        joined = digits_of(m[1])
        n = len(joined)
        yield m.start(), m.end(), f"{min(n, 20)}{'L' if 12 <= n <= 19 and luhn(joined) else ''}"


def _announced(text: str, start: int) -> str:
    """Class of the last key word among the three words before a place."""
    for word in reversed(_WORD.findall(text[max(0, start - 60) : start])[-3:]):
        kind = _ANNOUNCED.get(word.lower())
        if kind:
            return kind
    return ""


def token_bounds(text: str, start: int, end: int) -> array:
    """The starts of the tokens of a stretch, and its end; a token ends where the next one starts."""
    bounds = array("l", (m.start() for m in _TOKEN.finditer(text, start, end)))
    bounds.append(end)
    return bounds


def chain_of(text: str, start: int, end: int) -> tuple[list[tuple[int, int]], Iterator[list[tuple]]]:
    """(places of the tokens, features of each) of a stretch; the features are made one token at a time."""
    bounds = token_bounds(text, start, end)
    return list(pairwise(bounds)), _features(text, bounds)


def _features(text: str, bounds: array) -> Iterator[list[tuple]]:
    shapes = chain("<<", (_shape(text[a:b]) for a, b in pairwise(bounds)), ">>")
    around = deque(islice(shapes, 4), 5)
    groups = _groups(text, bounds[0], bounds[-1])
    nothing = (bounds[-1], bounds[-1], "")
    group = next(groups, nothing)
    before = _announced(text, bounds[0])
    for a, b in pairwise(bounds):
        around.append(next(shapes))
        back2, back, own, ahead, ahead2 = around
        while group is not nothing and group[1] <= a:
            group = next(groups, nothing)
        name = group[2] if group[0] <= a else ""
        key = _ANNOUNCED.get(text[a:b].lower(), "") if own[0] in "aA" else ""
        yield [
            ("own", own), ("back", back), ("ahead", ahead), ("back2", back2), ("ahead2", ahead2), ("pair", back, own),
            ("next", own, ahead), ("three", back, own, ahead), ("wide", back2, back, ahead, ahead2), ("group", name),
            ("said", before, name), ("key", key), ("said own", before, own),
        ]


LABELS = ["O"] + [f"{part}-{kind}" for kind in FOUND for part in "BI"]
N = len(LABELS)


@dataclass
class Field:
    """Feature numbers, weights (a row per feature, a column per label) and transitions."""

    numbers: dict[tuple, int]
    weights: np.ndarray
    moves: np.ndarray

    def scores(self, rows: Iterator[list[tuple]]) -> np.ndarray:
        """Sum of the weights of the known features of each token."""
        return np.concatenate([np.zeros((0, N)), *self._blocks(rows)])

    def _blocks(self, rows: Iterator[list[tuple]], at_once: int = 4_096) -> Iterator[np.ndarray]:
        unknown = len(self.weights) - 1
        while part := list(islice(rows, at_once)):
            at = np.array([[self.numbers.get(f, unknown) for f in row] for row in part], np.int64)
            yield self.weights[at].sum(axis=1)

    def decode_long(self, rows: Iterator[list[tuple]]) -> bytes:
        """Best labels of one chain of features, of which only the way back from each token is kept."""
        ways_back, best = [], None
        for scores in self._blocks(rows):
            back = np.zeros(scores.shape, np.int8)
            for t, own in enumerate(scores):
                if best is None:
                    best = own + self.moves[0]
                    continue
                ways = best[:, None] + self.moves
                back[t] = ways.argmax(axis=0)
                best = ways.max(axis=0) + own
            ways_back.append(back)
        if best is None:
            return b""
        label, out = int((best + self.moves[:, 0]).argmax()), bytearray()
        for back in reversed(ways_back):
            for row in back[::-1].tolist():
                out.append(label)
                label = row[label]
        out.reverse()
        return bytes(out)

    def decode(self, chains: list[np.ndarray], cells: int = 1 << 16) -> list[list[int]]:
        """Best labels of every chain of scores; chains of like length are decoded together, ``cells`` tokens at a time."""
        out: list[list[int]] = [[] for _ in chains]
        order = sorted(range(len(chains)), key=lambda k: len(chains[k]), reverse=True)
        at = 0
        while at < len(order):
            width = len(chains[order[at]])
            some = order[at : at + max(1, cells // max(1, width))]
            sizes = np.array([len(chains[k]) for k in some])
            scores = np.zeros((len(some), width, N))
            for row, k in zip(scores, some, strict=True):
                row[: len(chains[k])] = chains[k]
            for k, labels in zip(some, self._viterbi(scores, sizes), strict=True):
                out[k] = labels
            at += len(some)
        return out

    def _viterbi(self, scores: np.ndarray, sizes: np.ndarray) -> list[list[int]]:
        many, width, _ = scores.shape
        if not width:
            return [[] for _ in range(many)]
        back = np.zeros((many, width, N), np.int8)
        best = scores[:, 0] + self.moves[0]
        for t in range(1, width):
            ways = best[:, :, None] + self.moves
            back[:, t] = ways.argmax(axis=1)
            best = np.where((t < sizes)[:, None], ways.max(axis=1) + scores[:, t], best)
        label = (best + self.moves[:, 0]).argmax(axis=1)
        labels = np.zeros((many, width), np.int8)
        for t in range(width - 1, -1, -1):
            inside = t < sizes
            labels[inside, t] = label[inside]
            label = np.where(inside, back[np.arange(many), t, label], label)
        return [row[:size].tolist() for row, size in zip(labels, sizes, strict=True)]


@dataclass(frozen=True)
class Settings:
    """Bounds of the labelled table and steps of the fit."""

    max_rows: int = 4_000
    max_chars: int = 1_000
    steps: int = 60
    rate: float = 0.3
    penalty: float = 0.05


def fit(labelled: DataFrame, settings: Settings = Settings()) -> Field:
    """Train on at most ``max_rows`` rows (text, spans of start, end, kind), chosen by a hash of the text; longer texts are left out."""
    short = labelled.select("text", "spans").where(F.length("text") <= settings.max_chars)
    rows = short.orderBy(F.xxhash64("text"), "text").limit(settings.max_rows).collect()
    chains = []
    for r in rows:
        spans = [(s["start"], s["end"], s["kind"]) for s in r["spans"] or []]
        chains += training_chains(r["text"], spans)
    return train(chains, settings)


def training_chains(text: str, spans: list[tuple[int, int, str]]) -> Iterator[tuple[list[list[tuple]], list[int]]]:
    """(features, labels) of every stretch of a text."""
    for start, end in stretches(text):
        places, rows = chain_of(text, start, end)
        labels = [0] * len(places)
        for a, b, kind in spans:
            inside = [i for i, (x, y) in enumerate(places) if x >= a and y <= b]
            for i in inside:
                labels[i] = 2 * FOUND.index(kind) + (1 if i == inside[0] else 2)
        yield list(rows), labels


def train(chains: list[tuple[list[list[tuple]], list[int]]], settings: Settings = Settings()) -> Field:
    """Maximum likelihood with a ridge, by Adam; impossible transitions stay impossible."""
    moves = np.zeros((N, N))
    for i in range(len(FOUND)):
        inside = 2 * i + 2
        moves[[k for k in range(N) if k not in (inside - 1, inside)], inside] = -1e4  # I follows B or I of its kind
    numbers: dict[tuple, int] = {}
    for rows, _ in chains:
        for row in rows:
            for feature in row:
                numbers.setdefault(feature, len(numbers))
    weights = np.zeros((len(numbers) + 1, N))
    if not chains:
        weights[-1, 0] = 20.0
        return Field(numbers, weights, moves)
    # Equal chains are counted once, with their number as weight; short ones come first, so that batches are of like length.
    counted: dict[tuple, int] = {}
    for rows, labels in chains:
        key = (tuple(tuple(numbers[f] for f in row) for row in rows), tuple(labels))
        counted[key] = counted.get(key, 0) + 1
    batches = []
    ordered = sorted(counted.items(), key=lambda kv: (len(kv[0][1]), kv[0]))
    for at in range(0, len(ordered), 256):
        part = ordered[at : at + 256]
        width = max(len(labels) for (_, labels), _ in part)
        features = np.full((len(part), width, len(part[0][0][0][0])), len(numbers), np.int64)
        gold, there = np.zeros((len(part), width), np.int64), np.zeros((len(part), width), bool)
        for k, ((rows, labels), _) in enumerate(part):
            features[k, : len(rows)], gold[k, : len(rows)], there[k, : len(rows)] = rows, labels, True
        batches.append((features, gold, there, np.array([n for _, n in part], float)))
    free = moves > -1e3
    state = [np.zeros_like(weights), np.zeros_like(weights), np.zeros_like(moves), np.zeros_like(moves)]
    for step in range(1, settings.steps + 1):
        slope, turn = -settings.penalty * weights, -settings.penalty * np.where(free, moves, 0)
        for features, gold, there, times in batches:
            marginal, moved = _expected(weights[features].sum(axis=2), moves, there, times)
            residual = ((np.eye(N)[gold] * times[:, None, None]) - marginal)[there]
            flat = features[there]
            for label in range(N):
                used = np.abs(residual[:, label]) > 1e-4
                if used.any():
                    own = np.repeat(residual[used, label], flat.shape[1])
                    slope[:, label] += np.bincount(flat[used].ravel(), own, len(weights))
            first, last = gold[:, 0], gold[np.arange(len(gold)), there.sum(axis=1) - 1]
            seen = np.zeros((N, N))
            pair = there[:, 1:]
            np.add.at(seen, (gold[:, :-1][pair], gold[:, 1:][pair]), np.repeat(times, pair.sum(axis=1)))
            np.add.at(seen, (0, first), times)
            np.add.at(seen, (last, 0), times)
            turn += (seen - moved) * free
        slope[-1] = 0.0
        for value, gradient, mean, spread in ((weights, slope, *state[:2]), (moves, turn, *state[2:])):
            mean *= 0.9
            mean += 0.1 * gradient
            spread *= 0.99
            spread += 0.01 * gradient * gradient
            value += settings.rate * (mean / (1 - 0.9**step)) / (np.sqrt(spread / (1 - 0.99**step)) + 1e-8)
    return Field(numbers, weights, moves)


def _expected(scores: np.ndarray, moves: np.ndarray, there: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Label marginals and expected transition counts, both weighted; O stands before and after every chain.

    Forward and backward sums are scaled to one at every token, so that they neither vanish nor overflow.
    """
    many, width, _ = scores.shape
    ways = np.exp(moves)
    own = np.exp(scores - scores.max(axis=2, keepdims=True))
    forward, backward, scale = np.zeros_like(scores), np.zeros_like(scores), np.ones((many, width))
    step = ways[0] * own[:, 0]
    for t in range(width):
        if t:
            step = np.where(there[:, t, None], (forward[:, t - 1] @ ways) * own[:, t], forward[:, t - 1])
        scale[:, t] = step.sum(axis=1)
        forward[:, t] = step / scale[:, t, None]
    backward[:, -1] = ways[:, 0]
    for t in range(width - 2, -1, -1):
        step = ((own[:, t + 1] * backward[:, t + 1]) @ ways.T) / scale[:, t + 1, None]
        backward[:, t] = np.where(there[:, t + 1, None], step, ways[:, 0])
    share = times / (forward[:, -1] @ ways[:, 0])
    marginal = forward * backward * share[:, None, None] * there[..., None]
    moved = np.zeros((N, N))
    for t in range(1, width):
        before = forward[:, t - 1] * (share * there[:, t] / scale[:, t])[:, None]
        moved += before.T @ (own[:, t] * backward[:, t])
    moved *= ways
    moved[0] += marginal[:, 0].sum(axis=0)
    last = there.sum(axis=1) - 1
    moved[:, 0] += marginal[np.arange(many), last].sum(axis=0)
    return marginal, moved


# ---------------------------------------------------------------- the labelled table

# Forms of personal data and of other numbers.
# (#: digit, ~: hexadecimal digit, ^: capital, &: number up to 255, N: first name, H: host)
FORMS = {
    "phone": [
        "(###) ###-####", "(###)###-####", "###-###-####", "###.###.####", "### ### ####", "0## #######", "0### ######", "0###/######", "0## / ### ## ##",
        "(0##) ########", "0# ## ## ## ##", "6## ## ## ##", "9## ### ###", "+## ### #######", "+# (###) ###-####", "00## ### ######", "1-###-###-####",
    ],
    "card": ["################", "#### #### #### ####", "####-####-####-####", "####.####.####.####", "#### ###### #####", "####/####/####/####"],
    "email": [
        "N.N@H.com", "N##@H.example.org", "N_N[at]H.com", "N(at)H.net", "N.N[at]H.org", "N @ H.com", "N [at] H.com", "N##(at)H.co", "N@H", "N-N@H.de",
    ],
    "ip": ["&.&.&.&", "~~~~:~~~:~~~~::~~~~:~~~:~~~~", "~~~~:~~~~:~~~~:~~~~:~~~~:~~~~:~~~~:~~~~", "fe##::~~~~:~~~~"],
    "id": ["###-##-####", "### ## ####", "^^## #### #### #### #### ##", "^^####################", "^########", "########^"],
    "": [
        "#.#", "#.#.#", "##.##.####", "####-##-##", "##/##/####", "##:##", "##:##:##", "$#,###.##", "#,### €", "##%", "###", "####", "######", "########", "################",
        "~~~~~~~~~~~~~~~~~~~~", "~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~", "~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~", "^^^^##^#^^#^^##^^#^^", "N=~~~~~~~~~~~~~~~~~~",
        'N = "~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~"', "978-#-####-####-#", "v#.##", "#x###", "^#", "^##-##", "#th", "### ### ###", "##.###", "@N", "#.###.###",
        "N##", "N_##", "##N", "[##]", "(####)", "#-#", "##-##", "#### #### ####", "####-####", "#############", "##.##.##.##.##", "N@", "@ N", "#.#.",
        "################ ################", "## ## ##",
    ],
}
_PLAIN = (
    "the and said over house river about small every often later green wind town table garden der die und haus nicht einer auch le la "
    "maison avec pour dans casa con una para los mañana tiempo school story water under night morning summer letters"
).split()
_NAMES = "anna paul maria john lena tom sofia max eva peter laura marc nina hugo clara felix".split()
_HOSTS = "example mailbox webpost acme nordic office cloudy lakeside".split()


def _filled(form: str, kind: str, draw: random.Random) -> str:
    """A form with its places filled; cards pass Luhn, plain numbers of their length do not."""
    fill = {
        "#": lambda: str(draw.randrange(10)), "~": lambda: draw.choice("0123456789abcdef"), "^": lambda: draw.choice("ABCDEFGHKLMNPRSTUVWXYZ"),
        "&": lambda: str(draw.randrange(256)), "N": lambda: draw.choice(_NAMES), "H": lambda: draw.choice(_HOSTS),
    }
    while True:
        value = re.sub("[#~^&NH]", lambda m: fill[m[0]](), form)
        digits = digits_of(value)
        if not 12 <= len(digits) <= 19 or kind not in ("card", "") or luhn(digits) == (kind == "card"):
            return value


def labelled_rows(n: int, seed: int = 11) -> Iterator[tuple[str, list[tuple[int, int, str]]]]:
    """``n`` made-up sentences, each with up to three values of FORMS among plain words, half of them behind a fitting key word."""
    draw = random.Random(seed)
    for _ in range(n):
        text, spans = " ".join(draw.choices(_PLAIN, k=draw.randrange(1, 5))), []
        for _ in range(draw.choice((1, 1, 2, 3))):
            kind = draw.choice(["", "", *FOUND])
            if draw.random() < 0.5:
                # A key word of another kind may stand before any value too.
                said = kind or "other"
                if draw.random() < 0.15:
                    said = draw.choice(list(ANNOUNCE))
                word = draw.choice(ANNOUNCE[said].split())
                text += " " + draw.choice([word, word.capitalize()]) + draw.choice(["", ":", " is", " no."])
            value = _filled(draw.choice(FORMS[kind]), kind, draw)
            text += draw.choice([" ", " ", " ", "\n", " ("])
            opened = text.endswith("(")
            if kind:
                spans.append((len(text), len(text) + len(value), kind))
            text += value + draw.choice([")" if opened else "", ")." if opened else ".", ")," if opened else ","])
            text += " " + " ".join(draw.choices(_PLAIN, k=draw.randrange(1, 4)))
        yield text, spans


def labelled_table(spark: SparkSession, n: int = 2_000, seed: int = 11) -> DataFrame:
    """The small labelled table: (text, spans of start, end, kind)."""
    return spark.createDataFrame(list(labelled_rows(n, seed)), "text string, spans array<struct<start:int,end:int,kind:string>>")


# ---------------------------------------------------------------- scanning

_EDGES = " \t\r\n.,;:()[]<>\"'"
_CHECKS = {
    "email": lambda t: "@" in t or "at" in t.lower(),
    "ip": lambda t: t.count(":") >= 2 or (t.count(".") == 3 and _is_ip(t)),
    "card": _is_card,
    "phone": lambda t: 7 <= len(digits_of(t)) <= 15,
    "id": lambda t: 7 <= len(digits_of(t)) <= (32 if t[:2].isalpha() and t[:2].isupper() else 9),
}


def spans_of(texts: list[str | None], field: Field, at_once: int = 1 << 15) -> list[list[tuple[int, int, str]]]:
    """All spans of every text, by start, then kind: pattern matches, and field spans apart from them.

    Some ``at_once`` tokens are decoded together; a stretch with more of them is decoded alone.
    """
    found = [base_spans(text) if text else [] for text in texts]
    taken: list[tuple[list[int], list[int]] | None] = [None] * len(texts)

    def add(k: int, bounds: array, labels: Iterable[int]) -> None:
        if not any(labels):
            return
        if taken[k] is None:
            spans = sorted(found[k])
            taken[k] = [a for a, _, _ in spans], list(accumulate((b for _, b, _ in spans), max))
        for first, last, kind in _labelled(labels):
            a, b = _trimmed(texts[k], bounds[first], bounds[last + 1], kind)
            if a < b and _CHECKS[kind](texts[k][a:b]) and not _touches(taken[k], a, b):
                found[k].append((a, b, f"crf_{kind}"))

    def flush() -> None:
        for (k, bounds), labels in zip(owners, field.decode(chains), strict=True):
            add(k, bounds, labels)
        chains.clear()
        owners.clear()

    chains, owners, waiting = [], [], 0
    for k, text in enumerate(texts):
        for start, end in stretches(text) if text else ():
            bounds = token_bounds(text, start, end)
            rows = _features(text, bounds)
            if len(bounds) > at_once:
                add(k, bounds, field.decode_long(rows))
                continue
            chains.append(field.scores(rows))
            owners.append((k, bounds))
            waiting += len(bounds)
            if waiting > at_once:
                flush()
                waiting = 0
    flush()
    return [sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]))) for spans in found]


def _labelled(labels: Iterable[int]) -> Iterator[tuple[int, int, str]]:
    """(first, last, kind) of every B with its I."""
    begin = None
    for i, label in enumerate(chain(labels, (0,))):
        if begin is not None and (label == 0 or label % 2):
            yield begin, i - 1, FOUND[(labels[begin] - 1) // 2]
            begin = None
        if label % 2:
            begin = i


def _trimmed(text: str, a: int, b: int, kind: str) -> tuple[int, int]:
    """The span without signs at its ends that do not belong to it; a telephone number may open with a bracket."""
    while a < b and text[a] in _EDGES and not (kind == "phone" and text[a] == "("):
        a += 1
    while b > a and text[b - 1] in _EDGES:
        b -= 1
    return a, b


def _touches(spans: tuple[list[int], list[int]], a: int, b: int) -> bool:
    """Whether [a, b) overlaps one of the spans, given as ascending starts and the greatest end up to each."""
    before = bisect_left(spans[0], b)
    return before > 0 and spans[1][before - 1] > a


ADDED = "pii array<struct<start:int,end:int,kind:string>>"


def scan(documents: DataFrame, field: Field, text: str = "text") -> DataFrame:
    """Add ``pii``, the spans of every text, to every row."""
    kept = documents.drop(*[c for c in documents.columns if c.lower() == "pii"])
    names = kept.columns

    def start():
        def work(part):
            out = {name: part[name] for name in names}
            out["pii"] = [[{"start": a, "end": b, "kind": kind} for a, b, kind in spans] for spans in spans_of(part[text], field)]
            return out

        return work

    return map_rows(kept, StructType(kept.schema.fields + StructType.fromDDL(ADDED).fields), start)


def masked(text: str | None, spans: list[tuple[int, int, str]]) -> str | None:
    """The text with every run of overlapping spans replaced by the kind of its first."""
    if not text or not spans:
        return text
    out, at = [], 0
    for a, b, kind in sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]))):
        if a >= at:
            out += [text[at:a], f"[{kind.removeprefix('crf_').upper()}]"]
        at = max(at, b)
    return "".join(out) + text[at:]


def mask(documents: DataFrame, field: Field, text: str = "text") -> DataFrame:
    """The rows with the personal data in ``text`` replaced by marks such as [EMAIL]."""

    def start():
        def work(part):
            spans = spans_of(part[text], field)
            return {**part, text: [masked(t, s) for t, s in zip(part[text], spans, strict=True)]}

        return work

    return map_rows(documents, documents.schema, start)


def op13_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, counts of the patterns, digest of their spans, and all spans as text, for every document."""
    documents = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = scan(documents, fit(labelled_table(spark))).select("doc_id", "pii")
    count = lambda kind: F.size(F.filter("pii", lambda s: s["kind"] == kind)).cast("long")
    written = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )
    base = F.filter("pii", lambda s: s["kind"].isin(BASE))
    return found.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in BASE],
        F.sha2(written(base), 256).alias("base_sha256"),
        written("pii").alias("spans"),
        F.size(F.filter("pii", lambda s: ~s["kind"].isin(BASE))).cast("long").alias("n_crf"),
    )


PLANS["op13_pii"] = op13_pii
