"""Toxicity by a weighted grammar of finite-state transducers over clauses.

Tokens become symbols: insults, verbs of harm, modals, targets, negations, reporting verbs, quotation marks and ends
of clauses. Small transducers each mark some of them: one knows whether speech is reported, one whether a negation
reaches this far, one whether an insult has a target nearby, one whether a verb of harm is turned on a target.
Their composition, one table of states, reads a text once. A clause scores by its marked matches: a threat or an insult
counts more if aimed at someone, less if negated or reported; a word alone is a match without marks. The score of a
document is a logistic function of its clauses' scores.

Which words are insults is learned. Patterns are whole words, and beginnings that several words share, if that so
many of their occurrences are in toxic training texts is no chance, given how many patterns were tried. They weigh the
logarithm of how many times likelier they are there, less a standard error. Occurrences count once for each context,
as copies of one text say nothing new. The other classes are closed lists of function words and verbs in four languages.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from dqspark.llm._arrow import LOWER, SpanHasher, chunks, mix, runs

SAMPLE_PER_LABEL = 8000
"""The model is fitted on about so many labelled documents of each label, chosen by a hash of the id."""
TOXIC_FROM = 0.7
LEAST_CONTEXTS = 3
LEAST_WORDS = 4
"""Words that a beginning must have for it to stand for words not seen before."""
LEAST_WEIGHT = 1.0
PREFIX_BYTES = range(4, 13)
THREAT_WEIGHT = 4.0
FACTORS = {"aimed": 1.5, "negated": 0.3, "reported": 0.5}
NEGATION_REACH = 3
TARGET_REACH = 4
REPORT_REACH = 12
PRIOR = np.array([-4.0, 2.0, 1.0])
"""Logistic coefficients (constant, sum, best clause) towards which the fit is pulled."""

# Closed word classes of the grammar, in English, German, French and Spanish.
WORDS = {
    "target": "you your yours yourself he him she her they them their these those people everyone"
    " du dich dir dein deine ihr euch ihn ihm sie leute tu toi te ton ta vous votre il elle ils elles lui leur"
    " tú ti usted ustedes él ella ellos ellas vosotros",
    "negation": "not no never nobody nothing without don doesn didn isn aren wasn weren nor"
    " nicht kein keine keinen nie niemals ohne pas jamais sans aucun aucune nunca jamás tampoco sin ningún ninguna",
    "report": "said says say saying told tells wrote writes claimed claims reported reports called calls quoted quotes"
    " sagte sagt schrieb meinte nannte behauptete dit disait écrit affirme appelé dijo dice escribió llamó afirmó",
    "harm": "kill hurt destroy burn beat hang shoot stab murder slap punch attack töten umbringen schlagen verletzen"
    " tuer frapper brûler détruire matar golpear quemar destruir",
    "modal": "will shall would gonna going must should werde werden wird sollte vais va vont devrait voy vas van debe",
}


@dataclass(frozen=True)
class Transducer:
    """Moves ``(state, symbol) -> (state, marks)``. Without a move the state falls to ``rests[state]``, with no marks."""

    start: str
    moves: Mapping[tuple[str, str], tuple[str, frozenset[str]]]
    rests: Mapping[str, str]

    def step(self, state: str, symbol: str) -> tuple[str, frozenset[str]]:
        return self.moves.get((state, symbol)) or (self.rests.get(state, state), frozenset())


SYMBOLS = ("other", "insult", "harm", "modal", "target", "negation", "report", "quote", "comma", "stop", "line")
MATCHES = ("insult", "harm")


def _reach(name: str, size: int) -> dict[str, str]:
    """States that count down to ``none``."""
    return {f"{name}{i}": f"{name}{i - 1}" if i > 1 else "none" for i in range(1, size + 1)}


def _mark(*marks: str) -> frozenset[str]:
    return frozenset(marks)


def reported_speech() -> Transducer:
    """Matches in quotation marks, up to the end of the line, or shortly after a reporting verb."""
    rests = _reach("said", REPORT_REACH)
    moves = {("none", "quote"): ("quote", _mark()), ("quote", "quote"): ("none", _mark()), ("quote", "line"): ("none", _mark())}
    moves |= {("quote", s): ("quote", _mark("reported")) for s in MATCHES}
    for state in ("none", *rests):
        moves[state, "report"] = (f"said{REPORT_REACH}", _mark())
    for state in rests:
        moves |= {(state, "quote"): ("quote", _mark()), (state, "stop"): ("none", _mark()), (state, "line"): ("none", _mark())}
        moves |= {(state, s): (rests[state], _mark("reported")) for s in MATCHES}
    return Transducer("none", moves, rests)


def negation() -> Transducer:
    """Matches shortly after a negation in the same clause."""
    rests = _reach("not", NEGATION_REACH)
    moves = {}
    for state in ("none", *rests):
        moves[state, "negation"] = (f"not{NEGATION_REACH}", _mark())
        moves |= {(state, end): ("none", _mark()) for end in ("comma", "stop", "line")}
    for state in rests:
        moves |= {(state, s): (rests[state], _mark("negated")) for s in MATCHES}
    return Transducer("none", moves, rests)


def target() -> Transducer:
    """Insults shortly after a target, and targets right after an insult, in the same sentence."""
    rests = _reach("near", TARGET_REACH) | _reach("named", 2)
    moves = {}
    for state in ("none", *rests):
        moves[state, "target"] = (f"near{TARGET_REACH}", _mark("aimed") if state.startswith("named") else _mark())
        moves[state, "insult"] = ("named2", _mark("aimed") if state.startswith("near") else _mark())
        moves |= {(state, end): ("none", _mark()) for end in ("stop", "line")}
    return Transducer("none", moves, rests)


def threat() -> Transducer:
    """Verbs of harm followed by a target, of more weight after a modal: the target completes the threat."""
    rests = _reach("will", 3) | _reach("harm", 2) | _reach("willharm", 2)
    moves = {}
    for state in ("none", *rests):
        moves[state, "modal"] = ("will3", _mark())
        moves[state, "harm"] = ("willharm2" if state.startswith("will") else "harm2", _mark())
        moves |= {(state, end): ("none", _mark()) for end in ("stop", "line")}
        if "harm" in state:
            marks = _mark("threat", "aimed") if state.startswith("willharm") else _mark("threat")
            moves[state, "target"] = ("none", marks)
    return Transducer("none", moves, rests)


@cache
def grammar() -> tuple[list[list[tuple[int, frozenset[str]]]], int]:
    """The composition of the transducers as rows of ``(next state, marks)`` by symbol, and the first state.

    Each transducer passes the symbols on to the next and adds its marks, so a state of the whole is one of each.
    """
    parts = (reported_speech(), negation(), target(), threat())
    start = tuple(p.start for p in parts)
    number, rows, todo = {start: 0}, [], [start]
    while todo:
        state = todo.pop(0)
        row = []
        for symbol in SYMBOLS:
            steps = [p.step(s, symbol) for p, s in zip(parts, state, strict=True)]
            after = tuple(s for s, _ in steps)
            if after not in number:
                number[after] = len(number)
                todo.append(after)
            row.append((number[after], frozenset().union(*(m for _, m in steps))))
        rows.append(row)
    return rows, 0


CLASS = {w.encode(): SYMBOLS.index(k) for k, words in WORDS.items() for w in words.split()}
INSULT, HARM, TARGET = (SYMBOLS.index(s) for s in ("insult", "harm", "target"))
NO_LETTER = np.zeros(256, bool)
NO_LETTER[[*range(0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = True
HARMS = frozenset(WORDS["harm"].split())
SLOTS = 1 << 16


def letters(low: np.ndarray) -> np.ndarray:
    """Where the bytes of words are: ASCII letters and characters beyond ASCII, without general punctuation and guillemets."""
    inside = ~NO_LETTER[low]
    at = np.flatnonzero((low[:-2] == 0xE2) & (low[1:-1] == 0x80))
    inside[at] = inside[at + 1] = inside[at + 2] = False
    at = np.flatnonzero((low[:-1] == 0xC2) & (low[1:] >= 0xA0) & (low[1:] < 0xC0))
    inside[at] = inside[at + 1] = False
    return inside


def gap_symbols(gap: bytes) -> list[int]:
    """The symbols between two words."""
    if gap == b" ":
        return []
    out = []
    if b'"' in gap or b"\xe2\x80\x9c" in gap or b"\xe2\x80\x9d" in gap or b"\xe2\x80\x9e" in gap or b"\xc2\xab" in gap or b"\xc2\xbb" in gap:
        out.append(SYMBOLS.index("quote"))
    if b"\n" in gap:
        out.append(SYMBOLS.index("line"))
    elif any(c in gap for c in b".!?;:"):
        out.append(SYMBOLS.index("stop"))
    elif b"," in gap:
        out.append(SYMBOLS.index("comma"))
    return out


@dataclass
class ToxicityModel:
    """Insult patterns by their size in bytes (0: whole words) as sorted hashes and weights, and the logistic function."""

    patterns: dict[int, tuple[np.ndarray, np.ndarray]]
    coefficients: np.ndarray | None = None

    def __post_init__(self) -> None:
        self.slots = {}
        for size, (hashes, _) in self.patterns.items():
            self.slots[size] = np.zeros(SLOTS, bool)
            self.slots[size][(hashes & np.uint64(SLOTS - 1)).astype(np.int64)] = True
        data = b"".join(w.encode() for w in sorted(HARMS))
        ends = np.cumsum([len(w.encode()) for w in sorted(HARMS)])
        starts = np.append(0, ends[:-1])
        self.harms = np.sort(SpanHasher(np.frombuffer(data, np.uint8))(starts, ends))

    def _match(self, size: int, hashes: np.ndarray) -> np.ndarray:
        known, weights = self.patterns[size]
        out = np.zeros(len(hashes))
        maybe = np.flatnonzero(self.slots[size][(hashes & np.uint64(SLOTS - 1)).astype(np.int64)])
        place = np.minimum(np.searchsorted(known, hashes[maybe]), len(known) - 1)
        found = known[place] == hashes[maybe]
        out[maybe[found]] = weights[place[found]]
        return out

    def insults(self, hasher: SpanHasher, starts: np.ndarray, ends: np.ndarray, words: np.ndarray) -> np.ndarray:
        """The weight of each word: its own if it is a pattern, else that of its longest beginning that is one, else 0."""
        weight = self._match(0, words) if 0 in self.patterns else np.zeros(len(words))
        for size in sorted((s for s in self.patterns if s), reverse=True):
            left = np.flatnonzero((weight == 0) & (ends - starts >= size))
            weight[left] = self._match(size, hasher(starts[left], starts[left] + size))
        return weight

    def clauses(
        self, low: np.ndarray, begin: int, starts: np.ndarray, ends: np.ndarray, weight: np.ndarray
    ) -> list[tuple[bytes, float]]:
        """The matched words and the scores of the clauses that have a match, of the words of a line from ``begin`` on."""
        rows, state = grammar()
        raw = low[begin : ends[-1]].tobytes()
        scores, current, matched, last = [], 0.0, b"", 0
        for a, b, w in zip((starts - begin).tolist(), (ends - begin).tolist(), weight.tolist(), strict=True):
            for symbol in gap_symbols(raw[last:a]):
                state = rows[state][symbol][0]
                if symbol >= SYMBOLS.index("stop") and current:
                    scores.append((matched, current))
                    current, matched = 0.0, b""
            last = b
            symbol = INSULT if w else CLASS.get(raw[a:b], 0)
            state, marks = rows[state][symbol]
            if symbol == INSULT or (symbol == TARGET and "threat" in marks):
                score = w if symbol == INSULT else THREAT_WEIGHT
                for m in marks:
                    score *= FACTORS.get(m, 1.0)
                current += score
                matched += raw[a:b] + b" "
            elif symbol == TARGET and "aimed" in marks:
                current *= FACTORS["aimed"]
        return [*scores, (matched, current)] if current else scores

    def features(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        """``(1, log1p(sum), log1p(best))`` of the clauses' scores of each row; of clauses with the same matches, the best."""
        low = LOWER[data]
        starts, ends, counts = runs(letters(low), at)
        hasher = SpanHasher(low)
        words = hasher(starts, ends)
        weight = self.insults(hasher, starts, ends, words)
        out = np.zeros((len(counts), 3))
        out[:, 0] = 1
        place = np.minimum(np.searchsorted(self.harms, words), len(self.harms) - 1)
        hit = np.flatnonzero((weight > 0) | (self.harms[place] == words))
        if not len(hit):
            return out
        # Only lines with an insult or a verb of harm can score, and no state outlives a line.
        breaks = np.flatnonzero(low == 10)
        row_of = np.repeat(np.arange(len(counts)), counts)
        line_of = np.searchsorted(breaks, starts)
        lines = (row_of[hit], line_of[hit])
        new = np.append(True, (np.diff(lines[0]) != 0) | (np.diff(lines[1]) != 0))
        first_word = np.cumsum(counts) - counts
        found: dict[tuple[int, bytes], float] = {}
        for row, line in zip(lines[0][new].tolist(), lines[1][new].tolist(), strict=True):
            a = max(int(np.searchsorted(line_of, line)), int(first_word[row]))
            b = min(int(np.searchsorted(line_of, line, "right")), int(first_word[row] + counts[row]))
            begin = max(int(at[row]), int(breaks[line - 1]) + 1 if line else 0)
            for matched, score in self.clauses(low, begin, starts[a:b], ends[a:b], weight[a:b]):
                found[row, matched] = max(found.get((row, matched), 0.0), score)
        for (row, _), score in found.items():
            out[row, 1] += score
            out[row, 2] = max(out[row, 2], score)
        out[:, 1:] = np.log1p(out[:, 1:])
        return out

    def scores(self, features: np.ndarray) -> np.ndarray:
        if self.coefficients is None:
            return np.zeros(len(features))
        return 1 / (1 + np.exp(-np.clip(features @ self.coefficients, -30, 30)))


def _context_bits(words: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """For each word, one of 64 bits chosen by the words on either side of it in its row."""
    before, after = np.zeros_like(words), np.zeros_like(words)
    before[1:], after[:-1] = words[:-1], words[1:]
    firsts = (np.cumsum(counts) - counts)[counts > 0]
    before[firsts] = 0
    after[firsts[1:] - 1] = 0
    return _bit(before * np.uint64(0x9E3779B97F4A7C15) + after)


def _bit(hashes: np.ndarray) -> np.ndarray:
    return np.uint64(1) << (mix(hashes) >> np.uint64(58))


def _patterns(data: np.ndarray, at: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """``(size, hashes, rows, context bits, word bits)`` of the whole words, size 0, and of beginnings of longer words."""
    low = LOWER[data]
    starts, ends, counts = runs(letters(low), at)
    hasher = SpanHasher(low)
    words = hasher(starts, ends)
    row, bits = np.repeat(np.arange(len(counts)), counts), _context_bits(words, counts)
    own = _bit(words)
    yield 0, words, row, bits, own
    for size in PREFIX_BYTES:
        held = np.flatnonzero(ends - starts > size)
        held = held[(low[starts[held] + size] & 0xC0) != 0x80]  # not within a character
        yield size, hasher(starts[held], starts[held] + size), row[held], bits[held], own[held]


def pattern_counts(rows: DataFrame, known: np.ndarray | None = None) -> DataFrame:
    """``(size, pattern, docs, bits, words)`` over a column of texts; of the patterns ``known``, if given."""
    shared = rows.sparkSession.sparkContext.broadcast(known)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only = shared.value
        for batch in batches:
            for _, _, data, at in chunks(batch.column(0), 1 << 22):
                for size, hashes, row, bits, words in _patterns(data, at):
                    if only is not None:
                        place = np.minimum(np.searchsorted(only, hashes), max(len(only) - 1, 0))
                        held = only[place] == hashes if len(only) else np.zeros(len(hashes), bool)
                        hashes, row, bits, words = hashes[held], row[held], bits[held], words[held]
                    if not len(hashes):
                        continue
                    order = np.lexsort((row, hashes))
                    hashes, row, bits, words = hashes[order], row[order], bits[order], words[order]
                    new = np.append(True, hashes[1:] != hashes[:-1])
                    in_row = new | np.append(True, row[1:] != row[:-1])
                    at_new = np.flatnonzero(new)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(at_new), size, np.int32)),
                            pa.array(hashes[at_new].view(np.int64)),
                            pa.array(np.add.reduceat(in_row.astype(np.int64), at_new)),
                            pa.array(np.bitwise_or.reduceat(bits, at_new).view(np.int64)),
                            pa.array(np.bitwise_or.reduceat(words, at_new).view(np.int64)),
                        ],
                        ["size", "pattern", "docs", "bits", "words"],
                    )

    made = rows.mapInArrow(read, "size int, pattern long, docs long, bits long, words long")
    return made.groupBy("size", "pattern").agg(
        F.sum("docs").alias("docs"), F.bit_or("bits").alias("bits"), F.bit_or("words").alias("words")
    )


def times() -> F.Column:
    """Distinct contexts, by linear counting over 64 bits, and no more than documents."""
    empty = 64 - F.bit_count("bits")
    return F.when(empty > 0, F.least(F.col("docs").cast("double"), -64 * F.log(empty / 64))).otherwise(F.col("docs").cast("double"))


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, text: str = "text", label: str = "toxic", doc_id: str = "doc_id"
) -> ToxicityModel:
    """Learn insult patterns and the logistic function from the documents that have a label, 1 for toxic. This runs jobs.

    About ``SAMPLE_PER_LABEL`` labelled ids of each label are taken, by a hash, so what is sent to executors and brought
    to the driver is bounded at any size: the ids, the patterns and two numbers of a quarter of the documents. Three
    quarters give the patterns, one quarter the function, with each label weighted as it is among all. Rows without an
    id, label or text are left out. If either label is absent, every document scores 0.
    """
    marks = labels.select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("label")).distinct()
    marks = marks.filter(F.col("id").isNotNull() & F.col("label").isin(0, 1))
    sizes = {r["label"]: r["n"] for r in marks.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return ToxicityModel({})
    place = F.pmod(F.xxhash64("id", F.lit("toxicity")), F.lit(1_000_003))
    part = F.when(F.col("label") == 1, min(1.0, SAMPLE_PER_LABEL / sizes[1])).otherwise(min(1.0, SAMPLE_PER_LABEL / sizes[0]))
    chosen = marks.withColumn("place", place).filter(F.col("place") < part * 1_000_003)
    texts = docs.select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("text")).filter("text is not null")
    rows = texts.join(F.broadcast(chosen), "id").select("text", "label", (F.col("place") % 4).alias("fold"))

    learned = rows.filter("fold > 0")
    bad = pattern_counts(learned.filter("label = 1").select("text"))
    bad = bad.filter((F.col("size") == 0) | (F.bit_count("words") >= LEAST_WORDS))
    bad = bad.select("size", "pattern", times().alias("bad")).filter(F.col("bad") >= LEAST_CONTEXTS).toArrow()
    known = np.unique(bad["pattern"].to_numpy().view(np.uint64))
    good = pattern_counts(learned.filter("label = 0").select("text"), known)
    good = good.select("size", "pattern", times().alias("good")).toArrow()
    totals = {r["label"]: r["n"] for r in learned.groupBy("label").agg(F.count("*").alias("n")).collect()}
    table = bad.join(good, ["size", "pattern"], join_type="left outer")
    size_bad, size_good = totals.get(1, 0) + 1, totals.get(0, 0) + 1
    b, g = table["bad"].to_numpy() + 0.5, table["good"].fill_null(0.0).to_numpy() + 0.5
    weight = np.log(b / size_bad) - np.log(g / size_good) - np.sqrt(1 / b + 1 / g)
    # Half the likelihood ratio of this split of occurrences: chance reaches the log of the number of patterns once.
    expected = size_bad / (size_bad + size_good)
    surprise = b * np.log(b / ((b + g) * expected)) + g * np.log(g / ((b + g) * (1 - expected)))
    held = (weight >= LEAST_WEIGHT) & (surprise >= np.log(max(len(b), 2)))
    size, pattern = table["size"].to_numpy(), table["pattern"].to_numpy().view(np.uint64)
    patterns = {}
    for s in np.unique(size[held]).tolist():
        mine = np.flatnonzero((size == s) & held)
        mine = mine[np.argsort(pattern[mine])]
        patterns[s] = (pattern[mine], weight[mine])
    model = ToxicityModel(patterns)

    made = _with_features(rows.filter("fold = 0").select("label", "text"), model, "text").select("label", "sum", "best").toArrow()
    x = np.stack([np.ones(made.num_rows), made["sum"].to_numpy(), made["best"].to_numpy()], axis=1)
    y = made["label"].to_numpy().astype(float)
    # A document weighs as much as those of its label that it stands for, a document in the mean.
    here = np.array([(y == k).sum() for k in (0, 1)])
    share = np.array([sizes[k] for k in (0, 1)]) / (sizes[0] + sizes[1])
    each = share * max(len(y), 1) / np.maximum(here, 1)
    model.coefficients = logistic(x, y, each[y.astype(int)])
    return model


def logistic(x: np.ndarray, y: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Coefficients by Newton's method, pulled towards ``PRIOR``."""
    out = PRIOR.copy()
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ out, -30, 30)))
        slope = x.T @ (weights * (y - p)) - (out - PRIOR)
        bend = (x * (weights * p * (1 - p))[:, None]).T @ x + np.eye(len(out))
        out = out + np.linalg.solve(bend, slope)
    return out


def _with_features(docs: DataFrame, model: ToxicityModel, text: str) -> DataFrame:
    """``docs`` with the sum of the clauses' scores and the best one, as logarithms, and the score."""
    names, at_text = docs.columns, docs.columns.index(text)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, at in chunks(batch.column(at_text)):
                x = shared.value.features(data, at)
                new = [pa.array(v) for v in (x[:, 1], x[:, 2], shared.value.scores(x))]
                rows = batch.slice(first, end - first)
                yield pa.RecordBatch.from_arrays([*rows.columns, *new], [*names, "sum", "best", "score"])

    made = StructType.fromDDL("sum double, best double, score double")
    return docs.mapInArrow(read, StructType(docs.schema.fields + made.fields))


def score_toxicity(docs: DataFrame, model: ToxicityModel, text: str = "text") -> DataFrame:
    """``docs`` with ``score``, 0 to 1 and higher for toxic texts, and ``predicted``, 1 from ``TOXIC_FROM`` on, else 0.

    Only the text is looked at, the whole of it. NULL and empty texts score as texts without any match. Repeated rows
    score alike, an empty table gives an empty result; columns named as the results are replaced.
    """
    docs = docs.drop("score", "predicted", "sum", "best")
    scored = _with_features(docs, model, text)
    return scored.drop("sum", "best").withColumn("predicted", (F.col("score") >= TOXIC_FROM).cast("int"))
