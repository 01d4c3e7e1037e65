"""Toxicity by a weighted finite-state pattern grammar.

A text is a string of symbols: insults, threats, targets, negations, reports, will-words, quote marks, clause ends and other
words. Five transducers read it and rewrite it, each with a few states: negation (a scope of words), reported speech (a
clause), quotes (until they close or the line ends), targets (a clause) and threats (a will-word, a verb of harm, and a
target before or behind it in the clause). They are composed, by the product of their states, into one machine that is run
over the text once and gives marks: an insult or a threat with the states it stands in. A mark weighs what its word weighs
times what its states weigh; a clause counts its heaviest mark, and a document all its clauses.

The lexicon of insults is learned from a bounded sample of labelled documents: terms that tell toxic documents apart by the
log-likelihood ratio of the documents that hold them outside of negation, reported speech and quotes (copies of a text
count once). A term is a whole word, or a stem (a beginning) where many words of which none prevails share it, so that a word
does not put others under suspicion that merely begin alike. The weights of the states are learned from the same
sample, with a prior that discounts what is negated, reported or quoted.

Labels are read of rows whose crc32(doc_id as text) mod 4 is not 2 only. Null and empty texts score 0; repeated rows are
scored each. Without labels the lexicon is empty and only threats count. An empty table gives no rows; further columns
are ignored.
"""

from __future__ import annotations

import functools
import re
from collections import Counter
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import pieces, shingle_sets, small_batches, stash
from .quality_knn import held_out, sample

#: Toxic documents of the sample, at most (three times as many others); terms of the lexicon, at most.
BOUND, LEXICON = 3000, 2048
FOLDS, FOLD = 4, 2
NEGATIONS = frozenset("not no never nor without isn't aren't don't nicht kein keine keinen nie ohne pas jamais sans nunca jamás sin".split())
REPORTS = frozenset("said says quoted quote reported reports claimed wrote writes alleged sagte schrieb zitierte behauptete dit écrit affirme dijo escribió afirmó".split())
TARGETS = frozenset("you your yours u they them their du dich dir dein ihr euch tu te toi vous ton votre tú ti usted vosotros tus".split())
#: Tenses that need no will-word, and all forms of verbs of harm.
FUTURE = frozenset({v + e for v in ("tuer", "détruir", "frapper") for e in ("ai", "as", "a", "ons", "ez", "ont")} | {v + e for v in ("matar", "destruir", "golpear") for e in ("é", "ás", "á", "emos", "éis", "án")})
#: Forms that hold their target.
AIMED = frozenset(v + x for v in ("matar", "destruir", "golpear") for x in ("te", "os", "los", "las"))
THREATS = FUTURE | frozenset(
    {v + e for v in ("kill", "destroy", "murder", "burn") for e in ("", "s", "ed", "ing")}
    | set("tuer frapper détruire matar destruir golpear".split())
    | set("hurt hurts hurting stab stabs stabbed stabbing shoot shoots shot shooting strangle strangles strangled strangling burnt".split())
    | set("töten töte tötest tötet tötete töteten getötet umbringen umbringe umbringst umbringt umgebracht umzubringen vernichten vernichte vernichtest vernichtet vernichtete vernichteten".split())
    | set("tue tues tuons tuez tuent tué tués tuée tuées tuant détruis détruit détruisons détruisez détruisent détruite détruits détruisant frappe frappes frappons frappez frappent frappé frappés frappée frappées frappant".split())
    | set("mato matas mata matamos matáis matan matado matando destruyo destruyes destruye destruimos destruís destruyen destruido destruyendo golpeo golpeas golpea golpeamos golpeáis golpean golpeado golpeando".split())
    | AIMED
)
WILL = frozenset("will shall gonna going must werde werden wird vais va allons voy vamos".split())
#: Prior weight of a mark by state, as (negated, reported, quoted, targeted), and what it counts against observed marks.
PRIOR = {(n, r, q, t): (0.25 if n else 1.0) * (0.4 if r else 0.6 if q else 1.0) * (1.0 if t else 0.95) for n in (0, 1) for r in (0, 1) for q in (0, 1) for t in (0, 1)}
PRIOR_STRENGTH = 4.0
THREAT_WEIGHT = 0.9
TOKEN = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?|[.!?;:\n]|[\"“”„«»]")
#: What closes a quote, by what opened it (»so«, „so“ and «so» are all used).
CLOSES = {'"': '"', "“": "”", "”": "”", "„": "“”", "«": "»", "»": "«"}
STEMS = (4, 5, 6)
#: A stem needs so many words, of which none is in more than this share of its documents.
STEM_WORDS, STEM_SHARE = 4, 0.5
SCOPE = 4


def terms_of(word: str):
    """What of a word can stand in the lexicon: itself, and its beginnings."""
    yield word
    for n in STEMS:
        if len(word) > n:
            yield word[:n] + "*"


class Transducer:
    """step(state, symbol) -> (state, symbols): a state from 0, and what is written for a symbol read. A written symbol is a
    name and the tags that it has so far."""

    def __init__(self, states: int, step):
        self.states, self.step = states, step

    def after(self, first: "Transducer") -> "Transducer":
        """This one over what `first` writes: the product of their states."""

        def step(state: int, symbol):
            a, b = divmod(state, self.states)
            a, written = first.step(a, symbol)
            out = []
            for x in written:
                b, more = self.step(b, x)
                out += more
            return a * self.states + b, tuple(out)

        return Transducer(first.states * self.states, step)


def tagging(tag: str, states: int, move) -> Transducer:
    """Copies what it reads; insults and threats that are read in a state above 0 get the tag."""

    def step(state, symbol):
        state = move(state, symbol[0])
        return state, ((symbol[0], symbol[1] | {tag}) if state and symbol[0] in ("insult", "threat", "future", "aimed") else symbol,)

    return Transducer(states, step)


def _threats(state: int, symbol):
    """Writes marks only. States: nothing, a will-word, a threat that waits for its target (negated or not, reported, quoted)."""
    name, tags = symbol
    waiting = WAITING[state - 2] if state >= 2 else None
    if name in ("end", "line"):
        return 0, ()
    if name == "insult":
        return state, (("insult", tags),)
    if name == "target" and waiting is not None:
        return 1, (("threat", waiting | {"target"}),)
    if name == "will":
        return max(state, 1), ()
    if name in ("future", "aimed") or name == "threat" and state >= 1:
        if "target" in tags or name == "aimed" and state >= 1:
            return state, (("threat", tags | {"target"}),)
        return 2 + WAITING.index(tags - {"target"}), ()
    return state, ()


WAITING = [frozenset(t for t, on in zip(("negated", "reported", "quoted"), bits, strict=True) if on) for bits in product((0, 1), repeat=3)]
NEGATION = tagging("negated", SCOPE + 1, lambda s, x: SCOPE if x == "negation" else 0 if x in ("end", "line") else max(0, s - 1) if x not in ("quote", "close") else s)
REPORTED = tagging("reported", 2, lambda s, x: 1 if x == "report" else 0 if x in ("end", "line") else s)
QUOTED = tagging("quoted", 2, lambda s, x: 1 if x == "quote" else 0 if x in ("close", "line") else s)
TARGETED = tagging("target", 2, lambda s, x: 1 if x == "target" else 0 if x in ("end", "line") else s)
GRAMMAR = Transducer(2 + len(WAITING), _threats).after(TARGETED).after(QUOTED).after(REPORTED).after(NEGATION)
SYMBOLS = ("insult", "threat", "future", "aimed", "target", "negation", "report", "will", "quote", "close", "end", "line", "word")


@functools.cache
def machine() -> tuple[dict[tuple[int, str], int], dict[tuple[int, str], tuple]]:
    """The states that the composed grammar reaches, as tables: the next state, and the marks (kind, state) that are written."""
    moves, marks, left = {}, {}, [0]
    while left:
        s = left.pop()
        for name in SYMBOLS:
            to, written = GRAMMAR.step(s, (name, frozenset()))
            if (s, name) in moves:
                continue
            moves[s, name] = to
            if written:
                marks[s, name] = tuple((kind, tuple(int(t in tags) for t in ("negated", "reported", "quoted", "target"))) for kind, tags in written)
            if (to, "word") not in moves:
                left.append(to)
    return moves, marks


class Lexicon:
    def __init__(self, weights: dict[str, float]):
        self.weights = weights
        self.states = dict(PRIOR)

    def insult(self, word: str) -> float:
        return max((self.weights.get(t, 0.0) for t in terms_of(word)), default=0.0)

    def automaton(self):
        import ahocorasick

        a = ahocorasick.Automaton()
        for t in [*self.weights, *THREATS]:
            a.add_word(t.rstrip("*"), True)
        a.make_automaton()
        return a

    @staticmethod
    def symbols(text: str):
        """(symbol, word) of a lower-case text; insults are words still. A colon ends nothing."""
        opened = ""
        for m in TOKEN.finditer(text):
            w = m[0]
            if w[0].isalpha():
                kind = "negation" if w in NEGATIONS else "report" if w in REPORTS else "will" if w in WILL else "target" if w in TARGETS else "future" if w in FUTURE else "aimed" if w in AIMED else "threat" if w in THREATS else "word"
                yield kind, w
            elif w in CLOSES:
                if opened and w in CLOSES[opened]:
                    opened = ""
                    yield "close", w
                elif not opened:
                    opened = w
                    yield "quote", w
            elif w != ":":
                opened = "" if w == "\n" else opened
                yield "line" if w == "\n" else "end", w

    def marks(self, text: str, every: bool = False):
        """(clause, weight, state, kind, word) of each mark of a lower-case text, by one run of the composed machine. every:
        plain words are read as insults of no weight, to learn which are."""
        moves, written = machine()
        state = clause = 0
        known: dict[str, float] = {}
        for name, w in self.symbols(text):
            weight = 0.0
            if name == "word":
                weight = known.get(w, -1.0)
                if weight < 0:
                    weight = known[w] = self.insult(w)
                if weight or every:
                    name = "insult"
            for kind, tags in written.get((state, name), ()):
                yield clause, THREAT_WEIGHT if kind == "threat" else weight, tags, kind, w
            state = moves[state, name]
            clause += name in ("end", "line")

    def score(self, text: str) -> float:
        best: dict[int, float] = {}
        for clause, weight, state, _, _ in self.marks(text):
            best[clause] = max(best.get(clause, 0.0), weight * self.states[state])
        return 1.0 - float(np.prod([1.0 - x for x in best.values()])) if best else 0.0


def tells(pos: np.ndarray, neg: np.ndarray, all_pos: int, all_neg: int, least: float = 37.0, precise: float = 0.97) -> np.ndarray:
    """Which terms mark toxic documents: by the log-likelihood ratio of the two counts (37: one term in a million by
    chance, times a hundred) and by precision at equal numbers of both kinds."""
    share = all_pos / (all_pos + all_neg)
    n = pos + neg
    with np.errstate(divide="ignore", invalid="ignore"):
        g = 2 * (pos * np.log(pos / (n * share)) + np.where(neg > 0, neg * np.log(neg / (n * (1 - share))), 0.0))
    rate = (pos / all_pos) / (pos / all_pos + (neg + 0.5) / all_neg)
    return (g >= least) & (rate >= precise) & (pos > n * share) & (24 * neg <= pos)


def terms(names: list[str], pos: np.ndarray, picked, tally: DataFrame) -> list[int]:
    """Of the terms that tell, those for the lexicon: whole words; a stem if STEM_WORDS words at least share it and none has
    more than STEM_SHARE of its documents; of stems within each other the longest that keeps nine tenths of them."""
    stems = {names[i][:-1]: i for i in picked if names[i].endswith("*")}
    if not stems:
        return list(picked)
    own = tally.filter(~F.col("term").endswith("*") & (F.col("pos") > 0))
    begins = F.array(*[F.substring("term", 1, n) for n in STEMS])
    hit = own.select("pos", F.explode(F.array_distinct(begins)).alias("stem"), "term").filter(F.col("stem").isin([*stems]) & (F.col("stem") != F.col("term")))
    seen = {r.stem: r for r in hit.groupBy("stem").agg(F.count("*").alias("n"), F.max("pos").alias("top")).collect()}  # a row for each stem
    broad = {s: i for s, i in stems.items() if s in seen and seen[s].n >= STEM_WORDS and seen[s].top <= STEM_SHARE * pos[i]}
    for n in sorted(STEMS):  # a stem gives way to a longer one that keeps most of it
        for s in [s for s in broad if len(s) == n]:
            if any(len(t) > n and t.startswith(s) and pos[broad[t]] >= 0.9 * pos[broad[s]] for t in broad):
                del broad[s]
    kept = [i for s, i in broad.items() if not any(len(t) < len(s) and s.startswith(t) for t in broad)]
    return kept + [i for i in picked if not names[i].endswith("*") and not any(names[i].startswith(s) and len(names[i]) > len(s) for s in broad)]


def fit(spark: SparkSession, docs: DataFrame, labels: DataFrame, bound: int = BOUND) -> Lexicon:
    chosen = sample(docs, labels, "toxic", (3 * bound, bound), FOLDS, FOLD)

    def one_each(batches):  # copies of a text count once: their smallest shingle is the same
        for batch in batches:
            low = [int(x[0].view(np.int64)) if len(x) else 0 for x in shingle_sets(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(low, pa.int64())], names=[*batch.schema.names, "low"])

    chosen = chosen.mapInArrow(one_each, "doc_id long, text string, label int, low long").orderBy("doc_id").limit(4 * bound).dropDuplicates(["label", "low"])
    chosen = stash(spark, chosen, "sample")

    def plain(text):
        return {w for _, _, (negated, reported, quoted, _), kind, w in Lexicon({}).marks(text, every=True) if kind == "insult" and not (negated or reported or quoted)}

    def counts(batches):
        total: Counter = Counter()
        for batch in batches:
            for text, y in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist(), strict=True):
                total.update((t, y) for t in {t for w in plain((text or "").lower()) if len(w) > 2 for t in terms_of(w)})
                if len(total) > 300_000:
                    yield out(total)
                    total = Counter()
        yield out(total)

    def out(total):
        return pa.RecordBatch.from_arrays([pa.array([t for t, _ in total], pa.string()), pa.array([n * y for (_, y), n in total.items()], pa.int64()), pa.array([n * (1 - y) for (_, y), n in total.items()], pa.int64())], names=["term", "pos", "neg"])

    sizes = {r.label: r["count"] for r in chosen.groupBy("label").count().collect()}
    tally = chosen.select("text", "label").mapInArrow(counts, "term string, pos long, neg long").groupBy("term").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    told = tally.filter("pos >= 24 * neg and pos > 0").orderBy(F.desc(F.expr("pos - 6 * neg")), "term").limit(LEXICON).toArrow().to_pydict()
    pos, neg = np.array(told["pos"], dtype=float), np.array(told["neg"], dtype=float)
    names = told["term"]
    picked = np.flatnonzero(tells(pos, neg, sizes.get(1, 0), sizes.get(0, 0))) if len(sizes) == 2 and len(pos) else []
    chosen_terms = terms(names, pos, picked, tally)
    lexicon = Lexicon({names[i]: float((pos[i] + 0.5) / (pos[i] + neg[i] + 1.0)) for i in chosen_terms})

    def states(batches):
        for batch in batches:
            rows = []
            for text, y in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist(), strict=True):
                found = {s for _, _, s, kind, _ in lexicon.marks((text or "").lower()) if kind == "insult"}
                if len(found) == 1:  # what a document with marks in one state only tells of that state
                    rows.append((*found.pop(), y))
            cols = list(zip(*rows, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32()) for c in cols], names=["n", "r", "q", "t", "y"])

    seen = chosen.select("text", "label").mapInArrow(states, "n int, r int, q int, t int, y int").groupBy("n", "r", "q", "t").agg(F.count("*").alias("k"), F.sum("y").alias("y"))
    for r in seen.collect():  # sixteen rows at most
        key = (r.n, r.r, r.q, r.t)
        lexicon.states[key] = float((r.y + PRIOR_STRENGTH * PRIOR[key]) / (r.k + PRIOR_STRENGTH))
    return lexicon


def score_toxicity(spark: SparkSession, docs: DataFrame, labels: DataFrame, bound: int = BOUND, keep: int | None = None) -> DataFrame:
    """doc_id, held_out, score, predicted of every document. With keep: the rows of docs that are predicted so."""
    small_batches(spark, 2000)
    sent = spark.sparkContext.broadcast(fit(spark, docs, labels, bound))  # LEXICON terms at most

    def run(batches):
        lexicon = sent.value
        machine = lexicon.automaton()
        for batch in batches:
            for part in pieces(batch, "text", 8 << 20):
                scores = []
                for text in part.column("text").to_pylist():
                    low = (text or "").lower()
                    hit = next(machine.iter(low), None) if low else None
                    scores.append(lexicon.score(low) if hit else 0.0)
                if keep is not None:
                    yield part.filter(pa.array((np.array(scores) >= 0.3) == bool(keep)))
                    continue
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    if keep is not None:
        return docs.mapInArrow(run, docs.schema)
    scored = docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", held_out("doc_id", FOLDS, FOLD).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
