"""Toxicity: a learned lexicon, matched with misspellings, scored in context.

*Lexicon.* Terms are words or word beginnings that occur in toxic documents and hardly in
others, more often than chance allows (``Settings.least_evidence``). A closed word is written with the end mark ``$``, a beginning without it, so both
are plain strings of one trie. They are learned from a bounded sample of labelled rows
(``Settings.toxic_rows`` + ``Settings.clean_rows``), near copies counted once.

*Matching.* A word walks the product of that trie with a Levenshtein automaton: a state is
the set of (trie node, errors) reached, built once and then a dictionary step. A term may
differ by one error from five letters on and by two from nine on. A closed term of four letters also
matches with signs for one or both of its inner letters, and, as one error, with two neighbours swapped
or letters repeated.

*Score.* Each match weighs what its (term, errors) showed on the sample. A match within
quotation marks (an opening one before it, its own closing one behind it; a sign between letters is an
apostrophe), or after a word of reporting, counts to the quoted sum, any other to the
direct sum, which a form of address nearby raises. A logistic regression on both sums gives
the score, so it lies between 0 and 1 and rises with the evidence.

Null and empty texts have no match and get the score of a text without evidence. Nulls in
``labels`` are not learned from; of several labels of one document the largest counts. A
document row that occurs twice is scored twice. Other columns pass through the operator.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from dataclasses import dataclass, field

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakemodels.llm.common import HashedWords, ascii_words, map_rows, window_hashes
from lakemodels.llm.plans import PLANS, read

# Opening quotation marks with those that close them, words of reporting and forms of address in the four languages.
QUOTES = {"\"": "\"", "“": "”", "„": "“”", "«": "»", "»": "«", "‹": "›", "›": "‹", "‘": "’", "‚": "‘’"}
REPORTING = set(
    "said says say called calls wrote writes quoted quote quotes term word dit disait écrit appelle mot terme "
    "sagte sagt schrieb nannte wort begriff dijo dice escribió llamó palabra término".split()
)
ADDRESS = set("you your yours you're u tu toi ton ta vous votre du dich dein deine ihr tú ti tus usted eres".split())

_WORD = re.compile(r"[^\W\d_]+(?:[@$!*0-9]+[^\W\d_]+)*")
_LEET = str.maketrans("013457@$!", "oieastasi")
_MASKED = str.maketrans(dict.fromkeys("@$!*0123456789", "*"))
_RUN = re.compile(r"(.)\1+")
# Between letters a sign is an apostrophe, whatever its form.
_APOSTROPHE = re.compile(r"(?<=[^\W\d_])[’‘](?=[^\W\d_])")


@dataclass(frozen=True)
class Settings:
    """Sample bounds and thresholds of the fit; the defaults are those of the query."""

    toxic_rows: int = 4000
    clean_rows: int = 8000
    least_evidence: float = 12.0
    least_precision: float = 0.97
    shortest: int = 4
    longest: int = 12
    window: int = 5


@dataclass
class Model:
    """A fitted lexicon: weight of each (term, errors), and the regression on the two sums."""

    weights: dict[tuple[str, int], float]
    window: int
    slope: tuple[float, float] = (1.0, 0.3)
    bias: float = -4.0
    terms: list[str] = field(default_factory=list)


def words_of(text: str | None) -> list[str]:
    """Lower-cased words; digits and signs between letters are kept, as in ``st*pid``."""
    return _WORD.findall(text.lower()) if text else []


class Automaton:
    """Levenshtein automata of all terms at once, intersected with their trie, made deterministic step by step."""

    def __init__(self, terms: list[str]):
        # Node: letter -> node. allowed: most errors of any term below it. ends: term that is complete here.
        self.children: list[dict[str, int]] = [{}]
        self.allowed = [0]
        self.ends: list[str | None] = [None]
        for term in terms:
            errors = allowed_errors(term)
            node = 0
            self.allowed[0] = max(self.allowed[0], errors)
            for letter in term:
                if letter not in self.children[node]:
                    self.children[node][letter] = len(self.children)
                    self.children.append({})
                    self.allowed.append(0)
                    self.ends.append(None)
                node = self.children[node][letter]
                self.allowed[node] = max(self.allowed[node], errors)
            self.ends[node] = term
        self._states: list[dict[int, int]] = []
        self._numbers: dict[frozenset, int] = {}
        self._steps: list[dict[str, int]] = []
        self._found: list[tuple[tuple[str, int], ...]] = []
        self.start = self._state(self._with_skips({0: 0}))

    def _with_skips(self, nodes: dict[int, int]) -> dict[int, int]:
        """Add nodes reached by leaving letters of a term out of the word."""
        todo = list(nodes.items())
        while todo:
            node, errors = todo.pop()
            if nodes.get(node, 99) < errors:
                continue
            for child in self.children[node].values():
                if errors + 1 <= self.allowed[child] and nodes.get(child, 99) > errors + 1:
                    nodes[child] = errors + 1
                    todo.append((child, errors + 1))
        return nodes

    def _state(self, nodes: dict[int, int]) -> int:
        key = frozenset(nodes.items())
        if key not in self._numbers:
            self._numbers[key] = len(self._states)
            self._states.append(nodes)
            self._steps.append({})
            self._found.append(
                tuple(
                    (self.ends[n], e)
                    for n, e in nodes.items()
                    if self.ends[n] is not None and e <= allowed_errors(self.ends[n])
                )
            )
        return self._numbers[key]

    def _step(self, state: int, letter: str) -> int:
        reached: dict[int, int] = {}
        for node, errors in self._states[state].items():
            ways = [(self.children[node].get(letter), errors), (node, errors + 1)]
            ways += [(child, errors + 1) for sign, child in self.children[node].items() if sign != letter]
            for target, cost in ways:
                if target is not None and cost <= self.allowed[target] and cost < reached.get(target, 99):
                    reached[target] = cost
        return self._state(self._with_skips(reached))

    def matches(self, word: str) -> dict[str, int]:
        """Terms within their allowed distance of the word (beginnings: of a beginning of it), with the errors."""
        best: dict[str, int] = {}
        state = self.start
        for letter in word + "$":
            step = self._steps[state]
            if letter not in step:
                step[letter] = self._step(state, letter)
            state = step[letter]
            if not self._states[state]:
                break
            for term, errors in self._found[state]:
                best[term] = min(errors, best.get(term, 99))
        return best


def allowed_errors(term: str) -> int:
    letters = len(term.rstrip("$"))
    return 0 if letters < 5 else 1 if letters < 9 else 2


class Matcher:
    """Matches of the words of a text; a word is walked once per task as long as it is remembered."""

    def __init__(self, terms: list[str], remembered: int = 300_000):
        self.automaton = Automaton(terms)
        self.short: dict[str, tuple[str, int]] = {}
        self.runs: dict[str, str] = {}
        for term in (t[:4] for t in terms if len(t) == 5 and t.endswith("$")):
            a, b, c, d = term
            for masked in (f"{a}*{c}{d}", f"{a}{b}*{d}", f"{a}**{d}"):
                self.short.setdefault(masked, (f"{term}$", 0))
            for swapped in (b + a + c + d, a + c + b + d, a + b + d + c):
                if swapped != term:
                    self.short.setdefault(swapped, (f"{term}$", 1))
            self.runs.setdefault(_RUN.sub(r"\1", term), f"{term}$")
        self.known: dict[str, tuple[str, int] | None] = {}
        self.remembered = remembered

    def match(self, word: str) -> tuple[str, int] | None:
        """The closest term (fewest errors, then longest, then first in order) or None."""
        found = self.automaton.matches(word)
        plain = word.translate(_LEET)
        if plain != word:
            for term, errors in self.automaton.matches(plain).items():
                found[term] = min(errors, found.get(term, 99))
        if self.runs and len(word) >= 4:
            masked = word.translate(_MASKED)
            # Digits are letters to some and part of a name to others; two of them say too little.
            known = self.short.get(word) or (self.short.get(masked) if masked.count("*") == 1 else None)
            if known is not None:
                found[known[0]] = min(known[1], found.get(known[0], 99))
            elif len(word) > 4 and (term := self.runs.get(_RUN.sub(r"\1", word))):
                found[term] = min(1, found.get(term, 99))
        return min(found.items(), key=lambda x: (x[1], -len(x[0]), x[0])) if found else None

    def in_words(self, words: list[str]) -> dict[str, tuple[str, int]]:
        if len(self.known) > self.remembered:
            self.known.clear()
        known, out = self.known, {}
        for word in set(words):
            if word not in known:
                known[word] = self.match(word)
            if known[word] is not None:
                out[word] = known[word]
        return out


def context_of(text: str, spans: list[tuple[int, int]], words: list[str], at: int, window: int) -> tuple[bool, bool]:
    """(quoted, addressed) of the word number ``at``: marks on both sides or reporting before it; address near it."""
    lo, hi = max(0, at - window), min(len(words), at + window + 1)
    before = text[spans[lo][0] : spans[at][0]]
    after = text[spans[at][1] : spans[hi - 1][1] + 1]
    reported = any(w in REPORTING for w in words[max(0, at - 3) : at])
    addressed = any(w in ADDRESS for w in words[lo:hi])
    return _quoted(before, after) or reported, addressed


def _quoted(before: str, after: str) -> bool:
    """Whether a mark opens a quotation in ``before`` that its own closing mark ends in ``after``."""
    opened = None
    for sign in before:
        if opened and sign in QUOTES[opened]:
            opened = None
        elif opened is None and sign in QUOTES:
            opened = sign
    return opened is not None and any(sign in QUOTES[opened] for sign in after)


def evidence(matcher: Matcher, weight: dict[tuple[str, int], float], text: str | None, window: int):
    """(direct sum, quoted sum, matches) of one text."""
    words = words_of(text)
    found = {w: m for w, m in matcher.in_words(words).items() if weight.get(m, 0.0) > 0}
    if not found:
        return 0.0, 0.0, []
    lowered = _APOSTROPHE.sub("'", text.lower())
    spans = [m.span() for m in _WORD.finditer(lowered)]
    direct, quoted, matches = 0.0, 0.0, []
    for at, word in enumerate(words):
        if word not in found:
            continue
        term = found[word]
        is_quoted, addressed = context_of(lowered, spans, words, at, window)
        if is_quoted:
            quoted += weight[term]
        else:
            direct += weight[term] * (1.25 if addressed else 1.0)
        matches.append((word, term[0], term[1], is_quoted))
    return direct, quoted, matches


def fit(spark: SparkSession, documents: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model:
    """Learn lexicon, weights and regression from a bounded sample of ``labels`` (doc_id, toxic)."""
    marked = (
        labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    )
    order = F.xxhash64(F.col("doc_id"), F.lit(7))
    # At most toxic_rows + clean_rows rows by parameter: this is the proven bound of the broadcast.
    sample = (
        marked.where("toxic = 1").orderBy(order, "doc_id").limit(settings.toxic_rows)
        .unionByName(marked.where("toxic <> 1").orderBy(order, "doc_id").limit(settings.clean_rows))
    )
    texts = documents.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    counts = map_rows(
        texts.select("text", F.col("toxic").cast("int").alias("toxic")),
        "term string, toxic int, source long",
        lambda: _terms_of_slices(settings),
    )
    # Copies share their source hash: a term counts once for all of them.
    support = (
        counts.groupBy("term", "source").agg(F.max("toxic").alias("toxic"))
        .groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum(1 - F.col("toxic")).alias("clean"))
    )
    sizes = counts.where("term = ''").select("source", "toxic").distinct().groupBy("toxic").count().collect()
    n = defaultdict(lambda: 1, {r["toxic"]: max(1, r["count"]) for r in sizes})
    rate = (F.col("clean") + 0.5) / n[0]
    # Log likelihood of the term's own share of toxic documents against the sample's: what chance would need.
    share, all_of = n[1] / (n[0] + n[1]), F.col("toxic") + F.col("clean")
    evidence = F.col("toxic") * F.log(F.col("toxic") / (all_of * share)) + F.col("clean") * F.log(
        (F.col("clean") + 1e-9) / (all_of * (1 - share))
    )
    # Terms come from the bounded sample and need several of its toxic documents each: so few reach the driver.
    found = (
        support.where((F.col("term") != "") & (F.col("toxic") > 1) & (evidence >= settings.least_evidence))
        .where((F.col("toxic") / n[1]) / (F.col("toxic") / n[1] + rate) >= settings.least_precision)
        .collect()
    )
    terms = _closed_terms({r["term"]: r["toxic"] for r in found})
    return _weights(texts, terms, n, settings)


def _terms_of_slices(settings: Settings):
    numbered = HashedWords()

    def work(part):
        out: dict[str, list] = {"term": [], "toxic": [], "source": []}
        for text, toxic in zip(part["text"], part["toxic"], strict=True):
            if not text:
                continue
            source = _source(numbered, text)
            terms = {""}
            for word in set(words_of(text)):
                marked = word + "$"
                terms.update(marked[:k] for k in range(settings.shortest, min(len(marked), settings.longest) + 1))
            out["term"] += terms
            out["toxic"] += [int(toxic == 1)] * len(terms)
            out["source"] += [source] * len(terms)
        return out

    return work


def _source(numbered: HashedWords, text: str) -> int:
    """The least hash of the five-word windows: nearly always equal for near copies."""
    words = ascii_words(text)
    windows = window_hashes(numbered.hashes(words), min(5, max(1, len(words))))
    least = int(windows.min()) if len(windows) else xxhash.xxh3_64_intdigest(text.encode())
    return least >> 1


def _closed_terms(support: dict[str, int]) -> list[str]:
    """Of a chain of beginnings with nearly equal support keep the longest, then the shortest of what is left."""
    longer: dict[str, int] = defaultdict(int)
    for term, n in support.items():
        longer[term[:-1]] = max(longer[term[:-1]], n)
    closed = {t: n for t, n in support.items() if longer[t] < 0.9 * n}
    kept: dict[str, int] = {}
    for term in sorted(closed, key=lambda t: (len(t), t)):
        if not any(term[:k] in kept for k in range(1, len(term))):
            kept[term] = closed[term]
    return sorted(kept, key=lambda t: (-kept[t], t))


def _weights(texts: DataFrame, terms: list[str], n: dict[int, int], settings: Settings) -> Model:
    """Weigh each (term, errors) by the documents of the sample it occurs in, then fit the regression."""
    window = settings.window
    if not terms:
        return Model({}, window)

    def start():
        matcher, numbered = Matcher(terms), HashedWords()

        def work(part):
            out: dict[str, list] = {"term": [], "errors": [], "toxic": [], "source": []}
            for text, toxic in zip(part["text"], part["toxic"], strict=True):
                source = _source(numbered, text or "")
                for term, errors in sorted(set(matcher.in_words(words_of(text)).values())):
                    for name, value in (("term", term), ("errors", errors), ("toxic", int(toxic == 1)), ("source", source)):
                        out[name].append(value)
            return out

        return work

    seen = (
        map_rows(texts.select("text", "toxic"), "term string, errors int, toxic int, source long", start)
        .groupBy("term", "errors", "source").agg(F.max("toxic").alias("toxic"))
        .groupBy("term", "errors").agg(F.sum("toxic").alias("toxic"), F.sum(1 - F.col("toxic")).alias("clean"))
        .collect()
    )
    weight = {}
    for r in seen:
        # A rate that half a document more among the clean ones would still leave clear.
        p1, p0 = (r["toxic"] + 0.1) / n[1], (r["clean"] + 0.5) / n[0]
        if p1 / (p1 + p0) >= 0.9:
            weight[r["term"], r["errors"]] = math.log(p1 / p0)
    for term in terms:
        weight.setdefault((term, 0), 3.0)

    def sums():
        matcher = Matcher(terms)

        def work(part):
            rows = [evidence(matcher, weight, text, window)[:2] for text in part["text"]]
            return {"direct": [r[0] for r in rows], "quoted": [r[1] for r in rows], "toxic": part["toxic"]}

        return work

    # One row of three numbers per row of the bounded sample.
    sample = map_rows(
        texts.select("text", F.col("toxic").cast("int").alias("toxic")), "direct double, quoted double, toxic int", sums
    ).collect()
    if not sample:
        return Model(weight, window, terms=terms)
    x = np.array([[min(r[0], 20.0), min(r[1], 20.0)] for r in sample])
    y = np.array([float(r[2] == 1) for r in sample])
    slope, bias = _logistic(x, y)
    return Model(weight, window, (max(slope[0], 0.2), min(max(slope[1], 0.05), max(slope[0], 0.2))), bias, terms)


def _logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1.0) -> tuple[tuple[float, float], float]:
    """Penalised logistic regression by Newton steps; the order of the rows does not matter."""
    design = np.hstack([x, np.ones((len(x), 1))])
    theta = np.array([0.5, 0.2, -2.0])
    ridge = np.diag([penalty, penalty, 1e-3])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(design @ theta, -30, 30)))
        gradient = design.T @ (p - y) + ridge @ theta
        hessian = (design * (p * (1 - p))[:, None]).T @ design + ridge
        step = np.linalg.solve(hessian, gradient)
        theta = theta - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return (float(theta[0]), float(theta[1])), float(theta[2])


ADDED = "score double, n_direct int, n_quoted int, found string"


def score(documents: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add ``score``, ``n_direct``, ``n_quoted`` and ``found`` (terms with their errors) to every row.

    Input columns of these names are replaced.
    """
    added = StructType.fromDDL(ADDED).names
    kept = documents.drop(*[c for c in documents.columns if c.lower() in added])
    names = kept.columns
    schema = StructType(kept.schema.fields + StructType.fromDDL(ADDED).fields)

    def start():
        matcher = Matcher(model.terms)

        def work(part):
            out = {name: part[name] for name in names}
            out |= {name: [] for name in added}
            for value in part[text]:
                direct, quoted, matches = evidence(matcher, model.weights, value, model.window)
                z = model.bias + model.slope[0] * direct + model.slope[1] * quoted
                out["score"].append(1 / (1 + math.exp(-max(-30.0, min(30.0, z)))))
                out["n_direct"].append(sum(not m[3] for m in matches))
                out["n_quoted"].append(sum(m[3] for m in matches))
                terms = Counter(f"{m[1]}~{m[2]}" for m in matches)
                out["found"].append(",".join(f"{t}x{c}" for t, c in sorted(terms.items())))
            return out

        return work

    return map_rows(kept, schema, start)


def held_out() -> Column:
    """Rows that are never learned from: crc32 of doc_id as text, mod 3, is 1. A null doc_id counts as held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(True))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score, predicted, n_direct, n_quoted, found for every document."""
    documents = read(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read(spark, sf_dir, "labels").select("doc_id", "toxic").where(~held_out())
    model = fit(spark, documents, labels)
    return score(documents, model).select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"),
        "n_direct",
        "n_quoted",
        "found",
    )


PLANS["op3_toxicity"] = op3_toxicity
