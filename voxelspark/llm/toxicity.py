"""Toxicity by a weighted finite-state pattern grammar.

Weighted transducers over word classes (``Machine``: states, arcs, weights, as data) are composed into one machine for
insults and one for threats:

* lexicon: words to classes, an insult, a threat, a target (who is meant), a negation, a verb of reported speech, a quotation
  mark, or other;
* choice: takes one insult (or threat) of a clause as the head of the match, by guessing;
* report: a head after a verb of saying, or inside quotation marks, weighs less;
* negation: a head within a few words after a negation weighs little;
* target: a head within a few words of a target weighs more, and a threat without one little. A target that comes after
  its head is guessed at the head; the path dies where the guess was wrong.

A path's weight is the product of its arcs' weights. A clause is scored by its best path (the weight of the strongest
match) and by the sum over its paths (all its matches). A text's features are sums and maxima over its clauses, and a
logistic layer learned from labelled texts turns them into a probability.

Insult words are given for a few languages as seeds; the rest of the lexicon, whole words and stems, is learned from the
labelled texts: a stem is an insult if it stands in many different surroundings in toxic texts and in next to none in
others. Surroundings and not texts are counted, so that copies of one toxic text don't make its rare words insults.
Training reads ``per_label`` ids of each label at most (1500), those with the least hashes, one text an id, and of a text
over ``text_bytes`` (64 KB) sixteen stretches of its whole length (200 MB in all at most).
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc32_text, text_slices
from .sampling import labelled_ids, texts_of

OTHER, TARGET, NEGATION, REPORT, THREAT, INSULT, QUOTE, HEAD = range(8)
SEEDS = {
    INSULT: "idiot idiots moron morons stupid scum trash loser losers pathetic worthless disgusting clown fool imbecile dumb filth vermin scumbag idiota imbécil estúpido estúpida basura asqueroso asquerosa inútil idiote imbécile stupide ordure minable dégoûtant abruti abrutie blödmann dumm abschaum dreck erbärmlich wertlos ekelhaft versager trottel",
    THREAT: "kill hurt destroy beat murder stab shoot burn crush matar mataré matarte golpear destruir tuer tuerai frapper détruire töten umbringen schlagen vernichten",
    TARGET: "you your yourself he him she her they them u tu tú te ti usted ustedes él ella ellos vous toi ton ta votre il elle ils elles du dich dir ihr euch sie er ihn",
    NEGATION: "not no never n't isn't aren't wasn't don't doesn't didn't without nunca jamás sin pas jamais sans nicht kein keine keinen nie niemals ohne",
    REPORT: "said says say told tells claimed claims wrote writes quoted quote reported reports called dijo dice escribió afirmó dit disait écrit affirme sagte sagt schrieb behauptete meinte",
}
#: Words that a negation, and a target, reach.
NEGATION_REACH, TARGET_REACH = 3, 4
NEGATED, REPORTED, AIMED, UNAIMED_THREAT = 0.1, 0.35, 1.5, 0.15
_TOKEN = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)?|[.!?;:\n\"“”«»]")
_END = frozenset(".!?;:\n")
_QUOTE = frozenset("\"“”«»")
STEM = range(4, 9)


@dataclass
class Lexicon:
    """Weights of whole insult words and of insult stems, and the classes of the other words."""

    words: dict[str, float] = field(default_factory=dict)
    stems: dict[str, float] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.classes = {w: c for c, text in SEEDS.items() for w in text.split()}
        self.memo: dict[str, tuple[int, float]] = {}
        self.heads: set[str] = set()

    def look(self, word: str) -> tuple[int, float]:
        """Class and weight of a lower-case word."""
        weight = self.words.get(word) or max((self.stems.get(word[:n], 0.0) for n in STEM if n <= len(word)), default=0.0)
        kind = INSULT if weight else self.classes.get(word, OTHER)
        return kind, weight or float(kind in (INSULT, THREAT))

    def read(self, words: list[str], limit: int = 400_000) -> list[tuple[int, float]]:
        """Classes and weights of a text's words, empty where none is an insult or a threat. Known answers are kept, up to a
        bound."""
        new = set(words).difference(self.memo)
        if len(self.memo) + len(new) > limit:
            self.memo.clear()
            self.heads.clear()
            new = set(words)
        for word in new:
            found = self.memo[word] = self.look(word)
            if found[0] in (INSULT, THREAT):
                self.heads.add(word)
        return [] if self.heads.isdisjoint(words) else [self.memo[w] for w in words]


@dataclass(frozen=True)
class Machine:
    """A weighted transducer: arcs[state, symbol read] are the (symbol written, weight, next state) from a state. It starts
    in ``start`` and accepts in the states of ``final``."""

    start: object
    arcs: dict[tuple, list[tuple[int, float, object]]]
    final: frozenset


READ = (OTHER, TARGET, NEGATION, REPORT, THREAT, INSULT, QUOTE)


def choice(kind: int) -> Machine:
    """One word of ``kind`` becomes the head; insults and threats that are not chosen become other words."""
    arcs: dict[tuple, list] = {}
    for state in (0, 1):
        for symbol in READ:
            arcs[state, symbol] = [(OTHER if symbol in (INSULT, THREAT) else symbol, 1.0, state)]
    arcs[0, kind].append((HEAD, 1.0, 1))
    return Machine(0, arcs, frozenset({1}))


def report() -> Machine:
    """States (a verb of saying was read, inside quotation marks)."""
    arcs: dict[tuple, list] = {}
    for said in (0, 1):
        for quoted in (0, 1):
            for symbol in (OTHER, TARGET, NEGATION):
                arcs[(said, quoted), symbol] = [(symbol, 1.0, (said, quoted))]
            arcs[(said, quoted), REPORT] = [(OTHER, 1.0, (1, quoted))]
            arcs[(said, quoted), QUOTE] = [(OTHER, 1.0, (said, 1 - quoted))]
            arcs[(said, quoted), HEAD] = [(HEAD, REPORTED if said or quoted else 1.0, (said, quoted))]
    return Machine((0, 0), arcs, frozenset((a, b) for a in (0, 1) for b in (0, 1)))


def negation() -> Machine:
    """States: how many of the next words a negation still reaches."""
    arcs: dict[tuple, list] = {}
    for left in range(NEGATION_REACH + 1):
        after = max(0, left - 1)
        for symbol in (OTHER, TARGET):
            arcs[left, symbol] = [(symbol, 1.0, after)]
        arcs[left, NEGATION] = [(OTHER, 1.0, NEGATION_REACH)]
        arcs[left, HEAD] = [(HEAD, NEGATED if left else 1.0, after)]
    return Machine(0, arcs, frozenset(range(NEGATION_REACH + 1)))


def target(unaimed: float) -> Machine:
    """States: before the head, how many of the next words the last target still reaches; after it, that a target must come
    ("wait") or must not come ("none") within so many words; or that nothing matters any more."""
    arcs: dict[tuple, list] = {("done", s): [(s, 1.0, "done")] for s in (OTHER, TARGET)}
    for left in range(TARGET_REACH + 1):
        arcs[("near", left), OTHER] = [(OTHER, 1.0, ("near", max(0, left - 1)))]
        arcs[("near", left), TARGET] = [(TARGET, 1.0, ("near", TARGET_REACH))]
        guesses = [(HEAD, AIMED, ("wait", TARGET_REACH)), (HEAD, unaimed, ("none", TARGET_REACH))]
        arcs[("near", left), HEAD] = [(HEAD, AIMED, "done")] if left else guesses
    for left in range(1, TARGET_REACH + 1):
        arcs[("wait", left), TARGET] = [(TARGET, 1.0, "done")]
        arcs[("wait", left), OTHER] = [(OTHER, 1.0, ("wait", left - 1))] if left > 1 else []
        arcs[("none", left), OTHER] = [(OTHER, 1.0, ("none", left - 1) if left > 1 else "done")]
    return Machine(("near", 0), arcs, frozenset({"done", *(("none", n) for n in range(1, TARGET_REACH + 1))}))


def compose(first: Machine, second: Machine) -> Machine:
    """The machine that reads what ``first`` reads and writes what ``second`` writes of what ``first`` writes: its states
    are pairs, its weights products. States that are not reached are left out; the others are numbered."""
    number, todo = {(first.start, second.start): 0}, [(first.start, second.start)]
    arcs: dict[tuple, list] = {}
    by_state: dict[object, list] = defaultdict(list)
    for (state, symbol), out in first.arcs.items():
        by_state[state].append((symbol, out))
    while todo:
        a, b = todo.pop()
        for symbol, out in by_state[a]:
            own = []
            for middle, w, a2 in out:
                for written, v, b2 in second.arcs.get((b, middle), ()):
                    if (a2, b2) not in number:
                        number[a2, b2] = len(number)
                        todo.append((a2, b2))
                    own.append((written, w * v, number[a2, b2]))
            if own:
                arcs[number[a, b], symbol] = own
    return Machine(0, arcs, frozenset(n for (a, b), n in number.items() if a in first.final and b in second.final))


def grammar(kind: int, unaimed: float) -> Machine:
    return compose(compose(compose(choice(kind), report()), negation()), target(unaimed))


INSULTS, THREATS = grammar(INSULT, 1.0), grammar(THREAT, UNAIMED_THREAT)


def paths(machine: Machine, clause: list[tuple[int, float]]) -> tuple[float, float]:
    """The weight of the best path over a clause of (class, weight of the word), and the sum over all paths; a head's weight
    counts its word's. 0 where no path is accepted."""
    front = {machine.start: (1.0, 1.0)}
    for symbol, word in clause:
        reached: dict[object, tuple[float, float]] = {}
        for state, (best, total) in front.items():
            for written, w, after in machine.arcs.get((state, symbol), ()):
                if written == HEAD:
                    w *= word
                old = reached.get(after, (0.0, 0.0))
                reached[after] = max(old[0], best * w), old[1] + total * w
        front = reached
    ends = [v for state, v in front.items() if state in machine.final]
    return max((b for b, _ in ends), default=0.0), sum(t for _, t in ends)


def clauses(parts: list[str], classes: list[tuple[int, float]]) -> Iterator[list[tuple[int, float]]]:
    """The clauses that hold an insult or a threat. One that begins inside quotation marks begins with one; a line's end
    ends a quotation."""
    clause: list[tuple[int, float]] = []
    quoted = found = False
    for part, known in zip([*parts, "\n"], [*classes, (OTHER, 0.0)]):
        if part in _END:
            if found:
                yield clause
            quoted &= part != "\n"
            clause, found = [(QUOTE, 1.0)] if quoted else [], False
        elif part in _QUOTE:
            quoted = not quoted
            clause.append((QUOTE, 1.0))
        else:
            clause.append(known)
            found |= known[0] in (INSULT, THREAT)


def features(text: str, lexicon: Lexicon) -> np.ndarray:
    """Sums over all matches and the best match, of insults and of threats, how many clauses have a strong match, and words
    on a log scale."""
    parts = _TOKEN.findall(text.lower())
    known = lexicon.read(parts)
    scores = [(*paths(INSULTS, c), *paths(THREATS, c)) for c in clauses(parts, known)] if known else []
    if not scores:
        return np.array([0, 0, 0, 0, 0, np.log1p(len(parts))])
    insult, insults, threat, threats = np.array(scores).T
    return np.array([min(insults.sum(), 4), min(insult.max(), 3), min(threats.sum(), 4), min(threat.max(), 3), min((np.maximum(insult, threat) >= 0.5).sum(), 4), np.log1p(len(parts))])


def learn_lexicon(texts: list[str], toxic: np.ndarray, least: int = 6, purity: float = 0.9) -> Lexicon:
    """Insult words and stems: those with at least ``least`` different surroundings (the words on both sides) in toxic
    texts, of which at least the share ``purity`` is toxic when both labels weigh the same."""
    def surroundings(label: int, wanted) -> dict[str, int]:
        """How many different surroundings each wanted word has."""
        seen: dict[str, set[int]] = defaultdict(set)
        for text, own in zip(texts, toxic.tolist()):
            if own == label:
                words = [w for w in _TOKEN.findall(text.lower()) if w[0].isalpha()]
                for left, word, right in zip(["", *words], words, [*words[1:], ""]):
                    if len(word) >= 3 and wanted(word):
                        seen[word].add(hash((left, right)))
        return {w: len(s) for w, s in seen.items()}

    def by_stem(words: dict[str, int]) -> dict[str, int]:
        stems: dict[str, int] = defaultdict(int)
        for word, n_around in words.items():
            for n in STEM:
                if n <= len(word):
                    stems[word[:n]] += n_around
        return stems

    bad = surroundings(1, lambda w: True)
    endings = by_stem(dict.fromkeys(bad, 1))
    # only what is frequent enough in toxic texts is looked for in the others
    stems = {k: n for k, n in by_stem(bad).items() if n >= 2 * least and endings[k] >= 3}
    good = surroundings(0, lambda w: bad.get(w, 0) >= least or any(w[:n] in stems for n in STEM))
    rate = max(1, int((toxic == 1).sum())) / max(1, int((toxic == 0).sum()))

    def sure(p: int, n: int) -> float:
        return p / (p + n * rate) if p >= least else 0.0

    lexicon = Lexicon({w: 1.0 for w in SEEDS[INSULT].split()})
    for word, n in bad.items():
        if sure(n, good.get(word, 0)) >= purity:
            lexicon.words[word] = 1.0
    others = by_stem(good)
    for stem in sorted(stems, key=lambda k: (len(k), k)):
        pure = sure(stems[stem], others.get(stem, 0)) >= max(purity, 0.97)
        if pure and not any(stem[:n] in lexicon.stems for n in STEM if n < len(stem)):
            lexicon.stems[stem] = 1.0
    return lexicon


def learn_logistic(x: np.ndarray, y: np.ndarray, rounds: int = 400, ridge: float = 0.02) -> np.ndarray:
    """Weights and bias of a logistic layer by Newton steps with a ridge; both labels weigh as often as they occur."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    for _ in range(min(rounds, 40)):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + ridge * w
        hessian = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(x.shape[1])
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


@dataclass
class Model:
    lexicon: Lexicon
    weights: np.ndarray

    def score(self, text: str | None) -> float:
        x = features(text or "", self.lexicon)
        return float(1 / (1 + np.exp(-np.clip(x @ self.weights[:-1] + self.weights[-1], -30, 30))))


def train_on(docs: DataFrame, labels: DataFrame, per_label: int = 1500, seed: int = 4, text_bytes: int = 1 << 16) -> Model:
    """A model from docs(doc_id, text) and labels(doc_id, toxic), of rows where crc32(id) mod 5 is not 0: ``per_label`` ids of
    each label at most, and ``text_bytes`` of each text. Ids whose labels disagree are left out. Without labelled texts the seeds alone score."""
    keep = crc32_text("doc_id") % 5 != 0
    chosen = labelled_ids(labels.where(keep & F.col("toxic").isin(0, 1)).select("doc_id", F.col("toxic").alias("label")), per_label, seed)
    rows = texts_of(docs, chosen, text_bytes).toArrow().sort_by("doc_id")
    texts, toxic = [t or "" for t in rows.column("text").to_pylist()], np.array(rows.column("label").to_pylist(), np.int64)
    if len(set(toxic.tolist())) < 2:
        return Model(Lexicon({w: 1.0 for w in SEEDS[INSULT].split()}), np.array([1.5, 0.5, 1.5, 0.5, 0.5, 0.0, -4.0]))
    # the layer is learned on texts that the lexicon it sees was not learned from; then the lexicon takes all
    half = np.zeros(len(toxic), bool)
    for label in (0, 1):
        half[np.flatnonzero(toxic == label)[::2]] = True  # half of each label's texts
    x, y = [], []
    for a, b in ((half, ~half), (~half, half)):
        own = learn_lexicon([t for t, k in zip(texts, a) if k], toxic[a])
        x += [features(t, own) for t, k in zip(texts, b) if k]
        y += toxic[b].tolist()
    weights = learn_logistic(np.array(x), np.array(y, float))
    return Model(learn_lexicon(texts, toxic), weights)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every row of docs(doc_id, text); null and empty texts get the score of no match."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            values = [model.score(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(values, pa.float64())], ["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, score double")


def keep_below(docs: DataFrame, model: Model, limit: float) -> DataFrame:
    """The rows of docs(..., text) whose score is under ``limit``, with all their columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            yield batch.filter(pa.array([model.score(t) < limit for t in batch.column("text").to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def toxicity(docs: DataFrame, labels: DataFrame, **training) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of docs(doc_id, text). Null ids are not held out and train nothing;
    null and empty texts get the score of no match; repeated rows are rows of their own; without labels of both kinds the
    seeds alone score; an empty table gives no rows."""
    model = train_on(docs, labels, **training)
    held = F.coalesce(crc32_text("doc_id") % 5 == 0, F.lit(False))
    return score(docs, model).select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
