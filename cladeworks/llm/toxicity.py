"""Toxicity by a weighted finite-state pattern grammar over clauses.

Words are read as the set of word lists that they are in (insults have weights
learned from labelled rows, on whole words and on word beginnings).  Six
weighted transducers rewrite these sets one after another:

1. insult: an insult is neither a threat nor a target as well;
2. threat: a threat is no target as well;
3. negation: marks the ``REACH`` words after a negation, within a clause;
4. reported speech: marks what follows a reporting word within a clause, or
   stands in quotes (which end with the line);
5. target: marks the end of a clause that names a target;
6. clause: weighs what is left: insults by context, threats that are neither
   negated nor reported, ends of clauses.

They are composed once into one transducer whose states and arcs are a table;
a text is one path through it, and each clause gives the sums of its arcs'
weights by context.  These are the features of a logistic layer fitted on the
labelled rows, so labels decide how much a negated or reported insult counts.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Hashable, Iterator, Sequence
from dataclasses import dataclass, field
from functools import reduce
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .quality import held_out
from .sampling import first_by_hash
from .workspace import Workspace

# Fixed word lists of the grammar (closed classes in four languages).
THREATS = frozenset("kill hurt destroy beat burn shoot stab crush tuer frapper brûler töten schlagen verbrennen matar golpear quemar".split())
TARGETS = frozenset("you your yours u he she they them him her tu toi vous ton votre il elle ils du dich dir sie ihr er ihnen tú usted ustedes vosotros él ella ellos".split())
NEGATIONS = frozenset("not never no n't isn't aren't don't without ne pas jamais sans nicht kein keine nie ohne nunca jamás sin".split())
REPORTS = frozenset("said says called wrote claims quoted according dit disait écrit selon sagte sagt schrieb laut dijo dice escribió según".split())
#: Known insults; they hold without labels, with this weight.
INSULTS = frozenset("idiot moron loser scum clown trash worthless pathetic disgusting stupid".split())
SEED_WEIGHT = 4.0

REACH = 3
#: How much more a threat weighs in a clause that names a target.
AIMED_THREAT = 2.0
STEMS = (4, 5, 6)
#: The lexicon and the logistic layer are fitted on at most so many labelled training rows of each class (the first by a hash of their id).
TRAINING_ROWS = 5_000
#: A term needs so many texts with different content, and to be so many times as frequent in toxic ones.
SUPPORT, RATIO = 5, 30.0
#: At most so many terms (those in most toxic texts) are considered and go to every task.
LEXICON_MOST = 50_000

_WORD = re.compile(r"[^\W_]+(?:'[^\W_]+)?|[.!?;:\n|\"“”«»]")
_ENDS, _QUOTES = frozenset(".!?;\n|"), frozenset("\"“”«»")
_CONTEXTS = ("plain", "aimed", "negated", "reported")
N_FEATURES = 2 * len(_CONTEXTS) + 2


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


@dataclass(frozen=True)
class Lexicon:
    terms: dict[str, float] = field(default_factory=dict)
    stems: dict[str, float] = field(default_factory=dict)

    def weight(self, word: str) -> float:
        w = self.terms.get(word, 0.0)
        for k in STEMS:
            if len(word) > k:
                w = max(w, self.stems.get(word[:k], 0.0))
        return w

    def symbols(self, distinct: set[str]) -> dict[str, float]:
        """The weights of those of the words that are insults."""
        return {w: x for w in distinct if (x := self.weight(w)) > 0}


@dataclass(frozen=True)
class Transducer:
    """A sequential weighted transducer: ``step(state, read)`` is (next state, written, weight)."""

    start: Hashable
    step: Callable[[Hashable, Hashable], tuple[Hashable, Hashable, float]]

    def then(self, other: Transducer) -> Transducer:
        """The composition: ``other`` reads what this one writes; states are pairs, weights multiply."""

        def step(state, read):
            mine, middle, w = self.step(state[0], read)
            its, written, v = other.step(state[1], middle)
            return (mine, its), written, w * v

        return Transducer((self.start, other.start), step)

    def table(self, alphabet: Sequence[Hashable]) -> list[list[tuple[int, Hashable, float]]]:
        """The arcs out of each state that can be reached, by number (the start is 0), for each symbol of the alphabet."""
        number, table = {self.start: 0}, []
        for state in (todo := [self.start]):
            arcs = [self.step(state, x) for x in alphabet]
            for to, _, _ in arcs:
                if to not in number:
                    number[to] = len(number)
                    todo.append(to)
            table.append([(number[to], y, w) for to, y, w in arcs])
        return table


def _negation(left: int, x: frozenset) -> tuple[int, frozenset, float]:
    if "end" in x or "quote" in x:
        return 0 if "end" in x else left, x, 1.0
    return REACH if "negation" in x else max(left - 1, 0), x | {"negated"} if left else x, 1.0


def _reported(state: tuple[bool, bool], x: frozenset) -> tuple[tuple[bool, bool], frozenset, float]:
    said, quoted = state
    if "end" in x:
        return (False, quoted and "line" not in x), x, 1.0
    if "quote" in x:
        return (said, not quoted), x, 1.0
    return (said or "report" in x, quoted), x | {"reported"} if said or quoted else x, 1.0


def _target(aimed: bool, x: frozenset) -> tuple[bool, frozenset, float]:
    if "end" in x:
        return False, x | {"aimed"} if aimed else x, 1.0
    return aimed or "target" in x, x, 1.0


def _clause(state: None, x: frozenset) -> tuple[None, str, float]:
    if "end" in x:
        return state, "aimed" if "aimed" in x else "end", AIMED_THREAT if "aimed" in x else 1.0
    if "insult" in x:
        return state, next((c for c in ("reported", "negated") if c in x), "plain"), 1.0
    return state, "threat" if "threat" in x and not x & {"reported", "negated"} else "", 1.0


#: What the clause transducer writes: the context of an insult, a threat, the end of a clause (``aimed``: with a target) or nothing.
CASCADE = (
    Transducer(None, lambda s, x: (s, x - {"threat", "target"} if "insult" in x else x, 1.0)),
    Transducer(None, lambda s, x: (s, x - {"target"} if "threat" in x else x, 1.0)),
    Transducer(0, _negation),
    Transducer((False, False), _reported),
    Transducer(False, _target),
    Transducer(None, _clause),
)
_LISTS = ("insult", "threat", "target", "negation", "report")
#: The sets of lists that a word may be in (by the bits of their place), then the ends of a clause and of a line, and quotes.
ALPHABET = [frozenset(c for k, c in enumerate(_LISTS) if bits >> k & 1) for bits in range(1 << len(_LISTS))]
_END, _LINE, _QUOTE = range(len(ALPHABET), len(ALPHABET) + 3)
ALPHABET += [frozenset({"end"}), frozenset({"end", "line"}), frozenset({"quote"})]
_ARCS = reduce(Transducer.then, CASCADE).table(ALPHABET)


def symbol(word: str, insult: bool) -> int:
    """The place in ALPHABET of what the grammar reads for a word or mark."""
    if word in _ENDS:
        return _LINE if word == "\n" else _END
    if word in _QUOTES:
        return _QUOTE
    return insult | (word in THREATS) << 1 | (word in TARGETS) << 2 | (word in NEGATIONS or word.endswith("n't")) << 3 | (word in REPORTS) << 4


def clauses(words: list[str], insults: dict[str, float]) -> Iterator[dict[str, float]]:
    """Runs the composed transducer; yields the weights by context of each clause that has any."""
    read = {w: symbol(w, w in insults) for w in {*words, "\n"}}
    state, got = 0, {}
    for w in chain(words, "\n"):
        state, written, weight = _ARCS[state][read[w]]
        if written in ("end", "aimed"):
            if got:
                if written == "aimed" and "plain" in got:
                    got["aimed"] = got.pop("plain")
                if "threat" in got:
                    got["threat"] *= weight
                yield got
                got = {}
        elif written:
            got[written] = got.get(written, 0.0) + weight * insults.get(w, 1.0)


def features(text: str | None, lexicon: Lexicon) -> np.ndarray:
    """Strongest clause and saturated sum by context, then threats with and without insults."""
    x = np.zeros(N_FEATURES)
    words = words_of(text)
    distinct = set(words)
    insults = lexicon.symbols(distinct)
    if not insults and not distinct & THREATS:
        return x
    sums = dict.fromkeys(_CONTEXTS, 0.0)
    threat = mixed = 0.0
    for got in clauses(words, insults):
        t = got.pop("threat", 0.0)
        threat, mixed = threat + t, mixed + t * bool(got)
        for c, w in got.items():
            k = 2 * _CONTEXTS.index(c)
            x[k] = max(x[k], w)
            sums[c] += w
    x[1 : 2 * len(_CONTEXTS) : 2] = [np.log1p(sums[c]) for c in _CONTEXTS]
    x[-2], x[-1] = np.log1p(threat), np.log1p(mixed)
    return x


@dataclass(frozen=True)
class Model:
    lexicon: Lexicon
    weights: np.ndarray
    shift: float

    def score(self, text: str | None) -> float:
        z = float(features(text, self.lexicon) @ self.weights) + self.shift
        return float(1 / (1 + np.exp(-np.clip(z, -35, 35))))


def _default() -> Model:
    """Without labels: known insults only, half as much when negated or reported."""
    weights = np.array([1.0, 0.0, 1.2, 0.0, 0.5, 0.0, 0.5, 0.0, 0.5, 1.0])
    return Model(Lexicon(dict.fromkeys(INSULTS, SEED_WEIGHT)), weights, -3.0)


def _marked(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Adds a mark that near copies share with high odds, and others hardly ever: the smallest hash of their word pairs."""
    for pdf in frames:
        yield pdf.assign(mark=[_mark(words_of(t)) for t in pdf["text"]])


def _mark(words: list[str]) -> int:
    pairs = {f"{a} {b}" for a, b in zip(words, words[1:], strict=False)} or set(words)
    return min(map(xxhash.xxh3_64_intdigest, pairs), default=0) - (1 << 63)


def _terms(text: str | None) -> set[str]:
    return {w for w in words_of(text) if len(w) > 2 and w[0].isalpha()}


def _counts(frames: Iterator[pd.DataFrame], wanted: frozenset | None) -> Iterator[pd.DataFrame]:
    """(term, stem, n): in how many marks of the partition a word, or a word beginning, occurs."""
    by_mark: dict[int, set[str]] = {}
    for pdf in frames:
        for mark, text in zip(pdf["mark"], pdf["text"], strict=True):
            by_mark.setdefault(mark, set()).update(_terms(text))
    counts: dict[tuple[str, bool], int] = {}
    while by_mark:
        _, own = by_mark.popitem()
        stems = {w[:k] for w in own for k in STEMS if len(w) > k}
        for key in chain(((w, False) for w in own), ((s, True) for s in stems)):
            if wanted is None or key in wanted:
                counts[key] = counts.get(key, 0) + 1
    yield pd.DataFrame([(*k, n) for k, n in counts.items()], columns=["term", "stem", "n"])


def _logistic(x: np.ndarray, y: np.ndarray, prior: np.ndarray, ridge: float = 1.0, rounds: int = 60) -> tuple[np.ndarray, float]:
    """Ridge logistic regression, drawn towards the prior weights."""
    scale = np.maximum(np.abs(x).max(axis=0), 1.0)
    z = np.concatenate((x / scale, np.ones((len(x), 1))), axis=1)
    penalty = ridge * np.eye(z.shape[1])
    penalty[-1, -1] = 1e-3
    center = np.concatenate((prior * scale, [0.0]))
    w = center.copy()
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -35, 35)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + penalty, z.T @ (y - p) - penalty @ (w - center))
        w += np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-6:
            break
    return w[:-1] / scale, float(w[-1])


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", rows: int = TRAINING_ROWS) -> Model:
    """Learns the lexicon and the logistic layer from at most ``rows`` labelled texts of each class.

    Rows whose crc32 of the doc_id as text leaves 0 of 5 are never read.  A
    doc_id with several labels has the largest.  Without both classes the
    grammar keeps its known insults and default weights.
    """
    own = labels.filter(F.col(label).isNotNull()).groupBy("doc_id").agg(F.max(label).cast("int").alias("y"))
    own = own.filter(~held_out(F.col("doc_id"), 5, 0))
    first = lambda y: first_by_hash(own.filter(F.col("y") == y), "doc_id", rows)
    chosen = first(0).unionByName(first(1))  # 2 * rows ids at most
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), "doc_id").select("y", "text").filter("text is not null")
    ws = Workspace(docs.sparkSession, "toxicity")
    texts = ws.table(texts.mapInPandas(_marked, "y int, text string, mark long"))
    sizes = {r[0]: r[1] for r in texts.groupBy("y").agg(F.countDistinct("mark")).collect()}
    if not (sizes.get(0) and sizes.get(1)):
        return _default()
    kind = "term string, stem boolean, n long"
    # texts with the same mark meet in one partition, where they count once
    of = lambda y: texts.filter(F.col("y") == y).repartition(16, "mark")
    often = of(1).mapInPandas(lambda f: _counts(f, None), kind).groupBy("term", "stem").agg(F.sum("n").alias("toxic")).filter(F.col("toxic") >= SUPPORT)
    often = {(r[0], r[1]): r[2] for r in often.orderBy(F.desc("toxic"), "term", "stem").limit(LEXICON_MOST).collect()}
    wanted = docs.sparkSession.sparkContext.broadcast(frozenset(often))
    clean = of(0).mapInPandas(lambda f: _counts(f, wanted.value), kind).groupBy("term", "stem").agg(F.sum("n").alias("n")).collect()
    clean = {(r[0], r[1]): r[2] for r in clean}
    terms, stems = dict.fromkeys(INSULTS, SEED_WEIGHT), {}
    for key, n in often.items():
        weight = float(np.log((n + 0.5) / (sizes[1] + 1) / ((clean.get(key, 0) + 0.5) / (sizes[0] + 1))))
        if weight >= np.log(RATIO):
            (stems if key[1] else terms)[key[0]] = weight
    lexicon = Lexicon(terms, stems)
    sent = docs.sparkSession.sparkContext.broadcast(lexicon)
    x = texts.mapInPandas(lambda f: _featured(f, sent.value), "y int, x array<double>").toPandas()
    ws.drop(texts)
    weights, shift = _logistic(np.stack(x["x"]), x["y"].to_numpy(float), _default().weights)
    return Model(lexicon, weights, shift)


def _featured(frames: Iterator[pd.DataFrame], lexicon: Lexicon) -> Iterator[pd.DataFrame]:
    for pdf in frames:
        yield pd.DataFrame({"y": pdf["y"], "x": [features(t, lexicon).tolist() for t in pdf["text"]]})


def _scores(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        p = [model.score(t) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(p, pa.float64())], ["doc_id", "score"])


def score(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """doc_id, held_out, score, predicted for every document.

    Null and empty texts match nothing and get the score of a text without
    insults.  Repeated rows are scored one by one; other columns are ignored;
    an empty table gives an empty result.
    """
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels))
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    scored = rows.mapInArrow(lambda batches: _scores(batches, model.value), f"doc_id {kind}, score double")
    return scored.select("doc_id", held_out(F.col("doc_id"), 5, 0).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
