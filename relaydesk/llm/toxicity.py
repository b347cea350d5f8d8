"""Toxicity by a weighted finite-state grammar over clauses.

Words are mapped to symbols: insult, harm, intent, target, negation, report,
copula, clause end, or none of these. Five transducers rewrite the symbols one
after the other and are composed into a single machine: negation and reported
speech weaken what stands in their scope, a target strengthens an insult beside
it, intent followed by harm becomes a threat, and an insult is a statement
(after a copula or another insult), an address (a clause of its own) or merely
named. Every symbol that the machine puts out has a weight. A clause has the
weight of its strongest match, and a document's score is that of its matched
clauses: 1 - the product of (1 - weight).

The insult words, word stems among them, and the weights are learned from
labelled rows; the closed word classes are given.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relaydesk.llm.common import labelled_sample, written

# Closed word classes, fixed values in four languages.
NEGATION = "not no never nor without isn aren wasn don doesn didn nicht kein keine keinen nie ne pas jamais aucun sin nunca ni tampoco".split()
REPORT = (
    "said says say wrote writes claimed claims quoted reported alleged according called sagte sagt schrieb behauptet "
    "laut dit disait écrit selon prétend dijo dice escribió según afirma"
).split()
TARGET = (
    "you your yours yourself he she they him her them his their these those people du dich dir dein ihr euch sie ihn "
    "tu te toi ton vous votre ils elles lui él ella usted ustedes ellos ellas vosotros"
).split()
INTENT = "will going gonna want shall must should werde werden will soll vais vas va allons voy vas van vamos quiero".split()
HARM = (
    "kill hurt beat stab shoot destroy murder attack burn töten umbringen schlagen verletzen tuer frapper blesser "
    "brûler matar golpear herir quemar"
).split()
COPULA = "am is are was were be been bist ist bin sind seid war est es suis sommes êtes sont était eres soy somos son era".split()
INSULTS = "idiot moron scum loser trash stupid worthless pathetic disgusting clown idiote arschloch dummkopf abschaum connard imbécile ordure idiota imbécil estúpido basura".split()

# Symbols. The first line comes from words; the others are put out by the transducers.
WORD, END, INSULT, HARMS, INTENDS, TARGETS, NEGATES, REPORTS, COPULAS = range(9)
INPUTS = 9
NEGATED, QUOTED, DIRECTED, THREAT, DENIED_HARM, QUOTED_HARM, STATED, ADDRESSED = range(INPUTS, 17)
SYMBOLS = 17
#: Weight of a symbol before labels are seen, and for how many labelled documents that counts.
PRIOR = {INSULT: 0.9, DIRECTED: 0.97, NEGATED: 0.6, QUOTED: 0.6, THREAT: 0.7, DENIED_HARM: 0.05, QUOTED_HARM: 0.1}
PRIOR |= {STATED: 0.95, ADDRESSED: 0.95}
PRIOR_ROWS = 4.0

STEMS = range(3, 10)
TOKENS = re.compile(r"[^\W\d_]+|[.!?;:\n]+")
REMEMBERED = 500_000


class Transducer:
    """Deterministic: ``arcs[state, symbol]`` is (next state, output); ``rest[state]`` is the next
    state where no arc is given, and the symbol then passes unchanged. State 0 is the start."""

    def __init__(self, arcs: dict[tuple[int, int], tuple[int, int]], rest: dict[int, int]):
        self.arcs, self.rest = arcs, rest

    def step(self, state: int, symbol: int) -> tuple[int, int]:
        if (state, symbol) in self.arcs:
            return self.arcs[state, symbol]
        return (0 if symbol == END else self.rest[state]), symbol


def _scope(opener: int, length: int, inside: dict[int, int]) -> Transducer:
    """After ``opener`` the symbols of the next ``length`` words are rewritten by ``inside``."""
    states = range(length + 1)
    arcs = {(s, opener): (length, opener) for s in states}
    arcs |= {(s, a): (s - 1, b) for s in states if s for a, b in inside.items()}
    return Transducer(arcs, {s: max(0, s - 1) for s in states})


def negation() -> Transducer:
    return _scope(NEGATES, 3, {INSULT: NEGATED, HARMS: DENIED_HARM})


def reported_speech() -> Transducer:
    """From the reporting word to the end of the clause."""
    arcs = {(0, REPORTS): (1, REPORTS), (1, INSULT): (1, QUOTED), (1, HARMS): (1, QUOTED_HARM)}
    return Transducer(arcs, {0: 0, 1: 1})


def target() -> Transducer:
    """An insult within three words after a target is directed; so is a target just after an insult."""
    towards = _scope(TARGETS, 3, {INSULT: DIRECTED})
    arcs = towards.arcs | {(0, INSULT): (4, INSULT), (4, TARGETS): (3, DIRECTED), (4, INSULT): (4, INSULT)}
    return Transducer(arcs, towards.rest | {4: 0})


def threat() -> Transducer:
    """Harm within four words after intent."""
    return _scope(INTENDS, 4, {HARMS: THREAT})


def insult() -> Transducer:
    """What kind of insult a clause has; a lone word inside a clause passes unchanged.

    States: 0 at the start of a clause, 1 inside, 2 after an insult that began
    it, 3 after another one, 4 to 6 as many words, less 3, still in a copula's reach.
    """
    arcs = {(s, COPULAS): (6, COPULAS) for s in range(7)}
    arcs |= {(0, INSULT): (2, INSULT), (2, END): (0, ADDRESSED), (1, INSULT): (3, INSULT)}
    arcs |= {(s, INSULT): (3, STATED) for s in (2, 3, 4, 5, 6)}
    return Transducer(arcs, {0: 1, 1: 1, 2: 1, 3: 1, 4: 1, 5: 4, 6: 5})


def compose(parts: list[Transducer]) -> tuple[list[list[int]], list[list[int]]]:
    """One machine that does what the parts do in turn: next state and output by state and symbol."""
    start = (0,) * len(parts)
    number, queue, following, outputs = {start: 0}, [start], [], []
    for states in queue:
        row, out = [], []
        for symbol in range(INPUTS):
            after, passed = [], symbol
            for part, state in zip(parts, states):
                state, passed = part.step(state, passed)
                after.append(state)
            after = tuple(after)
            if after not in number:
                number[after] = len(number)
                queue.append(after)
            row.append(number[after])
            out.append(passed)
        following.append(row)
        outputs.append(out)
    return following, outputs


@dataclass
class Grammar:
    """Lexicon and weights; at most ``max_terms`` of :func:`fit` and the closed classes."""

    words: dict[str, float] = field(default_factory=lambda: dict.fromkeys(INSULTS, 0.9))
    stems: dict[str, float] = field(default_factory=dict)
    weights: dict[int, float] = field(default_factory=lambda: dict(PRIOR))
    base: float = 0.001


class Matcher:
    """Runs the machine over texts."""

    def __init__(self, grammar: Grammar):
        self.grammar = grammar
        self.following, self.outputs = compose([negation(), reported_speech(), target(), threat(), insult()])
        self.weights = [grammar.weights.get(s, 0.0) for s in range(SYMBOLS)]
        self.known: dict[str, tuple[int, float]] = {}
        for words, symbol in ((COPULA, COPULAS), (INTENT, INTENDS), (TARGET, TARGETS), (NEGATION, NEGATES), (REPORT, REPORTS), (HARM, HARMS)):
            self.known |= dict.fromkeys(words, (symbol, 1.0))
        self.known |= {word: (INSULT, p) for word, p in grammar.words.items()}
        self.fixed, self.stems = dict(self.known), grammar.stems

    def _look(self, token: str) -> tuple[int, float]:
        found = (WORD, 0.0)
        if token[0] in ".!?;:\n":
            found = (END, 0.0)
        else:
            for size in reversed(STEMS):
                if token[:size] in self.stems:
                    found = (INSULT, self.stems[token[:size]])
                    break
        self.known[token] = found
        return found

    def _run(self, text: str) -> list[list[tuple[int, float]]]:
        """Matches by clause, for clauses that have one; most texts have none and stop at the lookup."""
        if len(self.known) > REMEMBERED:
            self.known = dict(self.fixed)
        known, look = self.known, self._look
        read = [known[t] if t in known else look(t) for t in TOKENS.findall(text.lower())]
        if not any(symbol in (INSULT, HARMS) for symbol, _ in read):
            return []
        state, clause, out, following, outputs, lexicon = 0, [], [], self.following, self.outputs, 0.0
        for symbol, weight in [*read, (END, 0.0)]:
            passed = outputs[state][symbol]
            state = following[state][symbol]
            if symbol in (INSULT, HARMS):
                lexicon = weight
            if self.weights[passed]:
                # a target after an insult, or the end of the clause, speaks for the word before it
                clause.append((passed, lexicon))
            if symbol == END and clause:
                out.append(clause)
                clause = []
        return out

    def matches(self, text: str) -> list[tuple[int, float]]:
        """(symbol, lexicon weight) of every match."""
        return [match for clause in self._run(text) for match in clause]

    def clauses(self, text: str) -> list[tuple[int, float]]:
        """(symbol, weight) of the strongest match of every matched clause."""
        weighed = [[(self.weights[symbol] * lexicon, symbol) for symbol, lexicon in clause] for clause in self._run(text)]
        return [(symbol, weight) for weight, symbol in map(max, weighed)]

    def score(self, text: str) -> float:
        left = 1 - self.grammar.base
        for _, weight in self.clauses(text):
            left *= 1 - weight
        return min(1.0, max(0.0, 1 - left))


def toxicity(text: Column, grammar: Grammar) -> Column:
    """Score from 0 to 1 of every text, null and empty ones included (they match nothing)."""

    @F.arrow_udf("double")
    def scores(texts: pa.Array) -> pa.Array:
        matcher = Matcher(grammar)
        parts = (texts.slice(at, 256) for at in range(0, len(texts), 256))
        return pa.array([matcher.score(t or "") for part in parts for t in part.to_pylist()], pa.float64())

    return scores(text.cast("string"))


def _features(words: list[str]) -> Iterator[tuple[str, str]]:
    """Each word as ``=word`` and by its stems as ``stem``, with the words beside it."""
    for i, word in enumerate(words):
        beside = f"{words[i - 1] if i else ''} {words[i + 1] if i + 1 < len(words) else ''}"
        yield f"={word}", beside
        for size in STEMS:
            if len(word) >= size:
                yield word[:size], beside


def _words(text: str) -> list[str]:
    return [t for t in TOKENS.findall(text.lower()) if t[0] not in ".!?;:\n"]


def fit(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    rows: int = 2500,
    candidates: int = 60_000,
    max_terms: int = 5_000,
    support: float = 0.004,
    precision: tuple[float, ...] = (0.98, 0.9, 0.75),
) -> Grammar:
    """Learn lexicon and weights from at most ``rows`` labelled documents of each label, none held out.

    A word or stem is a candidate if toxic documents have it in as many
    different neighbourhoods as ``support`` asks for, so copies of one text
    count once. Terms are taken in turns, one for each ``precision``: a term is
    taken if so large a part of the documents that have it are toxic, counting
    only documents that the terms of earlier turns don't match. Only counts of
    at most ``candidates`` candidates and the taken terms reach the driver.
    A key that is labelled 0 and 1 gives a document of each label. Without
    labelled toxic rows the given words stand.
    """
    sample = written(labelled_sample(docs, labels, label, rows, key, text).select("_text", "_label"), "labelled")
    known = labels.where(F.col(label).isin(0, 1)).groupBy(F.col(label).cast("int").alias("label")).count().collect()
    of_label = {r["label"]: r["count"] for r in known}
    grammar = Grammar()
    if not of_label.get(1) or not of_label.get(0):
        return grammar

    def neighbourhoods(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                found = sorted(set(_features(_words(content.as_py()))))
                yield pa.RecordBatch.from_pydict({"term": [t for t, _ in found], "beside": [b for _, b in found]})

    least = max(3, int(support * min(rows, of_label[1])))
    spread = (
        sample.where("_label = 1")
        .select("_text")
        .mapInArrow(neighbourhoods, "term string, beside string")
        .select("term", F.xxhash64("beside").alias("beside"))
        .groupBy("term")
        .agg(F.count_distinct("beside").alias("n"))
        .where(F.col("n") >= least)
    )
    terms = {r["term"] for r in spread.orderBy(F.desc("n"), "term").limit(candidates).collect()}
    terms |= {f"={word}" for word in INSULTS}
    shared = docs.sparkSession.sparkContext.broadcast(frozenset(terms))

    def document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher, counts = Matcher(grammar), Counter()
        for batch in batches:
            for content, value in zip(batch.column(0), batch.column(1).to_pylist()):
                content = content.as_py()
                counts["", value] += 1
                if matcher.score(content) < 0.5:
                    words = set(_words(content))
                    own = {f"={w}" for w in words} | {w[:size] for w in words for size in STEMS if len(w) >= size}
                    counts.update((term, value) for term in own & shared.value)
        yield pa.RecordBatch.from_pydict(
            {
                "term": pa.array([t for t, _ in counts], pa.string()),
                "label": pa.array([v for _, v in counts], pa.int32()),
                "n": pa.array(list(counts.values()), pa.int64()),
            }
        )

    # a given word needs evidence, like any other
    grammar.words = {}
    for bar in precision:
        counted = sample.mapInArrow(document_counts, "term string, label int, n long").groupBy("term")
        toxic, clean = F.sum(F.expr("if(label = 1, n, 0)")), F.sum(F.expr("if(label = 0, n, 0)"))
        by_term = {r["term"]: (r["toxic"], r["clean"]) for r in counted.agg(toxic.alias("toxic"), clean.alias("clean")).collect()}
        n_toxic, n_clean = by_term.pop("", (0, 0))
        if not n_toxic or not n_clean:
            return Grammar()
        # how many documents one of the sample stands for
        per_toxic, per_clean = of_label[1] / n_toxic, of_label[0] / n_clean
        sure = {t: a * per_toxic / (a * per_toxic + b * per_clean + 1) for t, (a, b) in by_term.items()}
        taken = _lexicon({t: a for t, (a, _) in by_term.items() if a >= 3 and sure[t] >= bar}, sure, max_terms)
        grammar.words |= {t[1:]: sure[t] for t in taken if t[0] == "="}
        grammar.stems |= {t: sure[t] for t in taken if t[0] != "="}
        judged = {t[1:] for t, counts in by_term.items() if t[0] == "=" and sum(counts)}
    grammar.words = {w: 0.9 for w in INSULTS if w not in judged} | grammar.words

    def symbol_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher, counts = Matcher(grammar), Counter()
        for batch in batches:
            for content, value in zip(batch.column(0), batch.column(1).to_pylist()):
                symbols = {symbol for symbol, _ in matcher.clauses(content.as_py())} or {WORD}
                # a document speaks for the weight of a symbol only if its clauses have no other
                counts.update((symbol, value) for symbol in symbols if len(symbols) == 1)
        yield pa.RecordBatch.from_pydict(
            {
                "symbol": pa.array([s for s, _ in counts], pa.int32()),
                "label": pa.array([v for _, v in counts], pa.int32()),
                "n": pa.array(list(counts.values()), pa.int64()),
            }
        )

    found = sample.mapInArrow(symbol_counts, "symbol int, label int, n long").groupBy("symbol", "label").agg(F.sum("n").alias("n"))
    times = {(r["symbol"], r["label"]): r["n"] for r in found.collect()}
    for symbol, prior in PRIOR.items():
        toxic, clean = times.get((symbol, 1), 0) * per_toxic, times.get((symbol, 0), 0) * per_clean
        grammar.weights[symbol] = (toxic + prior * PRIOR_ROWS) / (toxic + clean + PRIOR_ROWS)
    toxic, clean = times.get((WORD, 1), 0) * per_toxic, times.get((WORD, 0), 0) * per_clean
    grammar.base = min(0.4, toxic / (toxic + clean + 1))
    return grammar


def _lexicon(support: dict[str, int], sure: dict[str, float], max_terms: int) -> set[str]:
    """The terms worth keeping.

    Of terms that stand for the same documents the most specific is kept
    (``=loser``, not ``lose``), and no term that a shorter one judges as surely.
    """
    by_start: dict[str, list[str]] = {}
    for term in support:
        plain = term.removeprefix("=")
        for size in STEMS:
            if len(plain) >= size:
                by_start.setdefault(plain[:size], []).append(term)
    taken: set[str] = set()
    for term in sorted(support, key=lambda t: (len(t.removeprefix("=")), t[0] == "=", t)):
        plain = term.removeprefix("=")
        above = [plain[:size] for size in STEMS if size < len(plain) or term[0] == "=" and size == len(plain)]
        if any(t in taken and sure[t] >= sure[term] - 0.03 for t in above):
            continue
        if term[0] != "=":
            close = [t for t in by_start.get(term, [term]) if support[t] >= 0.97 * support[term]]
            term = max(close, key=lambda t: (t[0] == "=", len(t), t))
        taken.add(term)
    return set(sorted(taken, key=lambda t: (-support[t], t))[:max_terms])


def score_documents(docs: DataFrame, grammar: Grammar, text: str = "text") -> DataFrame:
    """``docs`` with score (0 to 1, for null and empty texts too) and predicted (1 from 0.5 on).

    Each row is scored by its whole text alone, so repeated rows score alike.
    Columns of ``docs`` named score or predicted are replaced; all others stay.
    """
    out = docs.withColumn("score", toxicity(F.col(text), grammar))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
