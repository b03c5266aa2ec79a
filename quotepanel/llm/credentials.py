"""Operator 12, secrets by rules and by inferred grammars of their formats.

The rules below find labelled credentials. Of each kind's distinct values a
bounded sample becomes a prefix tree; states whose ends and symbols agree within
Hoeffding's bound are merged, in order of depth, into a probabilistic automaton.
So are other long tokens, as the background. The merged structures come from the
sample; their probabilities are counted over every distinct value of the corpus.

Every token that touches no rule's span is then scored: the log-likelihood under
a kind's automaton minus that under the background, per symbol. It is added,
under the kind that explains it best, if the score reaches the kind's threshold:
not below zero, nor below half of what all but ``MISSED`` of the kind's labelled
values reach, nor so low that more than ``PASSED`` of the other tokens would pass;
all values of the corpus count for that. It must also look like the kind by
itself: its likelihood per symbol may be ``ODD`` below what all but ``MISSED`` of the
labelled values have, so an address of digits and dots is no number.

Sample: about ``EXAMPLES`` distinct values a kind by a hash of the value, of at most
``LONGEST`` characters each. Everything else covers all rows and whole texts.

Defined cases: null and empty texts have no spans; a kind without labelled
values, or a corpus without other tokens, adds nothing; copies of a value count
once in a model and are found wherever they stand; a token that touches a
rule's span is not judged again; rows may repeat and ids be null. Other columns
are not read, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from quotepanel.llm.textbytes import LOWER, Texts, slices, words
from quotepanel.session import stored

# The rules, their kinds in order and the least length of a secret.
ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE)
KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
LEAST = {"assign": 12, "access": 18, "hex": 16}
KINDS = tuple(LEAST)

#: Tokens that no rule touches, from this length on.
OTHER = "other"
TOKEN_LEAST = 12

EXAMPLES = 2000
LONGEST = 256
ALPHA = 0.05
MISSED, PASSED = 0.01, 0.01
ODD = 0.5
#: Width of a bin in which scores are counted, and the bins on either side of zero.
BIN, BINS = 0.01, 2000


def _table(letters: bytes) -> np.ndarray:
    out = np.full(256, 0x20, np.uint8)
    out[list(letters)] = list(letters)
    return out


SYMBOLS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"
TOKEN_BYTES = _table(SYMBOLS)
HEX_BYTES = _table(b"0123456789abcdef")
#: Number of each symbol; the end of a value comes after the last.
NUMBER = np.zeros(256, np.uint8)
NUMBER[list(SYMBOLS)] = np.arange(len(SYMBOLS))
END = len(SYMBOLS)

MARKS = "array<struct<kind:string,start:bigint,end:bigint,value:string>>"


# Rules and tokens.


def _runs(texts: Texts, letters: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    found = words(Texts(texts.first, letters[texts.data], texts.offsets))
    long = found.end - found.start >= least
    return found.start[long], found.end[long], found.doc[long]


def _places(data: bytes, word: bytes) -> Iterator[int]:
    at = data.find(word)
    while at >= 0:
        yield at
        at = data.find(word, at + 1)


def _texts_with(texts: Texts, data: bytes, marks: tuple[bytes, ...]) -> list[int]:
    at = np.fromiter((p for word in marks for p in _places(data, word)), np.int64)
    return np.unique(np.searchsorted(texts.offsets, at, "right") - 1).tolist()


def spans(texts: Texts) -> list[list[tuple[str, int, int, bytes]]]:
    """Per text its rule spans (kind, start, end, secret) and other tokens, in bytes, by kind and start."""
    out: list[list[tuple[str, int, int, bytes]]] = [[] for _ in range(len(texts))]
    data = texts.data.tobytes()
    for i in _texts_with(texts, LOWER[texts.data].tobytes(), KEYWORDS):
        for m in ASSIGN.finditer(texts.text(i)):
            if len(m.group(2)) >= LEAST["assign"]:
                out[i].append(("assign", m.start(), m.end(), m.group(2)))
    for i in _texts_with(texts, data, (b"AKIA",)):
        for m in ACCESS.finditer(texts.text(i)):
            if len(m.group()) >= LEAST["access"]:
                out[i].append(("access", m.start(), m.end(), m.group()))
    for start, end, doc in zip(*_runs(texts, HEX_BYTES, LEAST["hex"]), strict=True):
        first = texts.offsets[doc]
        out[doc].append(("hex", int(start - first), int(end - first), data[start:end]))
    covered = np.zeros(len(data) + 1, np.int32)
    for i, found in enumerate(out):
        for _, start, end, _ in found:
            covered[texts.offsets[i] + start] += 1
            covered[texts.offsets[i] + end] -= 1
    upto = np.concatenate([[0], np.cumsum(np.cumsum(covered[:-1]) > 0)])
    for start, end, doc in zip(*_runs(texts, TOKEN_BYTES, TOKEN_LEAST), strict=True):
        if upto[end] == upto[start]:
            first = texts.offsets[doc]
            out[doc].append((OTHER, int(start - first), int(end - first), data[start:end]))
    return out


def marked(documents: DataFrame) -> DataFrame:
    """doc_id and ``marks``: rule spans and other tokens with code point bounds."""
    rows = documents.select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column(1)):
                points = np.concatenate([[0], np.cumsum((part.data & 0xC0) != 0x80)])
                marks = []
                for first, found in zip(part.offsets, spans(part), strict=False):
                    at = points[first]
                    marks.append([{"kind": k, "start": points[first + a] - at, "end": points[first + b] - at, "value": v.decode()} for k, a, b, v in found])
                kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("value", pa.string())]))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(part.first, len(part)), pa.array(marks, kind)], names=["doc_id", "marks"])

    return rows.mapInArrow(run, f"doc_id {documents.schema['doc_id'].dataType.simpleString()}, marks {MARKS}")


# Grammar inference.


@dataclass
class Prefixes:
    """A prefix tree, then the automaton it is merged into. State 0 is the start."""

    kids: list[dict[int, int]] = field(default_factory=lambda: [{}])
    arrived: list[int] = field(default_factory=lambda: [0])
    ended: list[int] = field(default_factory=lambda: [0])

    def add(self, value: bytes) -> None:
        state = 0
        self.arrived[0] += 1
        for symbol in NUMBER[np.frombuffer(value, np.uint8)].tolist():
            found = self.kids[state].get(symbol)
            if found is None:
                found = self.kids[state][symbol] = len(self.kids)
                self.kids.append({})
                self.arrived.append(0)
                self.ended.append(0)
            state = found
            self.arrived[state] += 1
        self.ended[state] += 1


def compatible(tree: Prefixes, passed: list[dict[int, int]], a: int, b: int, alpha: float) -> bool:
    """Whether ends and symbols of two states, and of all that follows both, agree within Hoeffding's bound."""
    width = np.sqrt(0.5 * np.log(2 / alpha))
    pairs = [(a, b)]
    while pairs:
        a, b = pairs.pop()
        n, m = tree.arrived[a], tree.arrived[b]
        bound = width * (n**-0.5 + m**-0.5)
        if bound >= 1:  # no two shares differ by more, and counts only fall further on
            continue
        if abs(tree.ended[a] / n - tree.ended[b] / m) > bound:
            return False
        for symbol in passed[a].keys() | passed[b].keys():
            if abs(passed[a].get(symbol, 0) / n - passed[b].get(symbol, 0) / m) > bound:
                return False
            if symbol in tree.kids[a] and symbol in tree.kids[b]:
                pairs.append((tree.kids[a][symbol], tree.kids[b][symbol]))
    return True


def folded(tree: Prefixes, passed: list[dict[int, int]], into: int, state: int) -> None:
    """Adds a state and the tree below it to another state."""
    pairs = [(into, state)]
    while pairs:
        into, state = pairs.pop()
        tree.arrived[into] += tree.arrived[state]
        tree.ended[into] += tree.ended[state]
        for symbol, n in passed[state].items():
            passed[into][symbol] = passed[into].get(symbol, 0) + n
        for symbol, kid in tree.kids[state].items():
            if symbol in tree.kids[into]:
                pairs.append((tree.kids[into][symbol], kid))
            else:
                tree.kids[into][symbol] = kid


def inferred(values: list[bytes], alpha: float = ALPHA) -> list[tuple[int, int, int]]:
    """Transitions (state, symbol, next) of the automaton merged from the values' prefix tree."""
    tree = Prefixes()
    for value in sorted(values):
        tree.add(value)
    passed = [{symbol: tree.arrived[kid] for symbol, kid in kids.items()} for kids in tree.kids]
    number, settled, at = {0: 0}, [0], 0
    while at < len(settled):
        # Kids of settled states in turn are merged with a settled state or settled themselves.
        state = settled[at]
        at += 1
        for symbol in sorted(tree.kids[state]):
            kid = tree.kids[state][symbol]
            if kid in number:
                continue
            same = next((s for s in settled if compatible(tree, passed, s, kid, alpha)), None)
            if same is None:
                number[kid] = len(settled)
                settled.append(kid)
            else:
                tree.kids[state][symbol] = same
                folded(tree, passed, same, kid)
                at = min(at, number[same])  # it may have new kids
    return [(number[s], symbol, number[kid]) for s in settled for symbol, kid in tree.kids[s].items()]


# Automata over values.


@dataclass
class Automaton:
    next: np.ndarray  # states x symbols; a symbol never seen leads to the start
    log: np.ndarray | None = None  # states x (symbols and end), log probabilities


def automaton(transitions: list[tuple[int, int, int]]) -> Automaton:
    n = 1 + max((max(s, t) for s, _, t in transitions), default=0)
    table = np.zeros((n, END), np.int32)
    for state, symbol, after in transitions:
        table[state, symbol] = after
    return Automaton(table)


def _coded(values: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols of all values, where each begins and its length."""
    size = np.array([len(v) for v in values], np.int64)
    return NUMBER[np.frombuffer(b"".join(values), np.uint8)], np.cumsum(size) - size, size


#: With fewer values left than this, each is walked by itself.
FEW = 8


def walked(table: np.ndarray, values: list[bytes], visit) -> None:
    """Walks all values at once; ``visit(value numbers, states, symbols)`` at each step and at the end."""
    code, begin, size = _coded(values)
    turn = np.argsort(-size, kind="stable")
    begin, size = begin[turn], size[turn]
    state = np.zeros(len(values), np.int64)
    place, left = 0, len(values)
    while left:
        still = int(np.searchsorted(-size, -place, "left"))  # values longer than place
        if still < left:
            visit(turn[still:left], state[still:left], np.full(left - still, END))
            left = still
        if left < FEW:
            break
        symbol = code[begin[:left] + place].astype(np.int64)
        visit(turn[:left], state[:left], symbol)
        state[:left] = table[state[:left], symbol]
        place += 1
    rows = table.tolist() if left else []
    for i in range(left):
        symbols = code[begin[i] + place : begin[i] + size[i]]
        states, now = [int(state[i])], int(state[i])
        for symbol in symbols.tolist():
            now = rows[now][symbol]
            states.append(now)
        visit(np.full(len(states), turn[i]), np.array(states), np.append(symbols, END).astype(np.int64))


def scored(model: Automaton, values: list[bytes]) -> np.ndarray:
    """Log-likelihood of each value, its end included."""
    total = np.zeros(len(values))

    def visit(who, state, symbol):
        gain = model.log[state, symbol]
        if len(who) and who[0] == who[-1] and len(who) > 1:
            total[who[0]] += gain.sum()
        else:
            total[who] += gain

    walked(model.next, values, visit)
    return total


def ratios(models: dict[str, Automaton], values: list[bytes]) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """For each kind, per symbol: log-likelihood over that of other tokens, and log-likelihood."""
    steps = np.array([len(v) + 1 for v in values], float)
    base = scored(models[OTHER], values) / steps
    own = {kind: scored(models[kind], values) / steps for kind in KINDS if kind in models}
    return {kind: (likely - base, likely) for kind, likely in own.items()}


def _bins(x: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(x / BIN).astype(np.int64), -BINS, BINS - 1) + BINS


def _reached(table: np.ndarray) -> int:
    """The bin that all but ``MISSED`` of the counted values reach."""
    return int(np.searchsorted(np.cumsum(table), MISSED * table.sum(), "right"))


# Models from the corpus.


def _strings(column: pa.Array) -> list[bytes]:
    return [v.encode() for v in column.to_pylist()]


def _inferred_of(rows: pd.DataFrame) -> pd.DataFrame:
    found = inferred([v.encode() for v in rows["value"]])
    out = pd.DataFrame(found, columns=["state", "symbol", "after"])
    out.insert(0, "kind", rows["kind"].iloc[0])
    return out


def _by_kind(batch: pa.RecordBatch) -> Iterator[tuple[str, list[bytes]]]:
    kinds = np.array(batch.column(0).to_pylist(), object)
    values = batch.column(1)
    for kind in np.unique(kinds) if len(kinds) else []:
        yield kind, _strings(values.take(pa.array(np.flatnonzero(kinds == kind))))


def learn(found: DataFrame, examples: int = EXAMPLES) -> tuple[dict[str, Automaton], dict[str, tuple[float, float]]]:
    """Automata and thresholds by kind from the rows of ``marked``; both empty where nothing can be added."""
    spark = found.sparkSession
    values = stored(found.select(F.explode("marks").alias("mark")).select("mark.kind", "mark.value").distinct(), "secrets-values")
    short = F.length("value") <= LONGEST
    sizes = {r["kind"]: r["n"] for r in values.filter(short).groupBy("kind").agg(F.count(F.lit(1)).alias("n")).collect()}
    if OTHER not in sizes or len(sizes) == 1:
        return {}, {}
    share = F.lit(0.0)
    for kind, n in sizes.items():
        share = F.when(F.col("kind") == kind, examples / n).otherwise(share)
    place = F.pmod(F.xxhash64("value", F.lit("secrets sample")), F.lit(1 << 20)) / (1 << 20)
    sample = values.filter(short & (place < share))
    rows = sample.groupBy("kind").applyInPandas(_inferred_of, "kind string, state long, symbol long, after long").collect()
    models = {kind: automaton([(r["state"], r["symbol"], r["after"]) for r in rows if r["kind"] == kind]) for kind in sizes}
    _count(values, models)
    return models, _thresholds(values, models, spark)


def _count(values: DataFrame, models: dict[str, Automaton]) -> None:
    """Probabilities of every automaton from all distinct values of its kind."""
    shared = values.sparkSession.sparkContext.broadcast({kind: model.next for kind, model in models.items()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = shared.value
        counts = {kind: np.zeros((len(table), END + 1), np.int64) for kind, table in tables.items()}
        for batch in batches:
            for kind, members in _by_kind(batch):
                if kind in tables:
                    into = counts[kind].reshape(-1)
                    walked(tables[kind], members, lambda _, state, symbol, into=into: np.add.at(into, state * (END + 1) + symbol, 1))
        for kind, table in counts.items():
            state, symbol = np.nonzero(table)
            yield pa.RecordBatch.from_arrays(
                [pa.array([kind] * len(state), pa.string()), pa.array(state), pa.array(symbol), pa.array(table[state, symbol])], names=["kind", "state", "symbol", "n"]
            )

    found = values.mapInArrow(run, "kind string, state long, symbol long, n long").groupBy("kind", "state", "symbol").agg(F.sum("n").alias("n"))
    counts = {kind: np.full((len(model.next), END + 1), 0.5) for kind, model in models.items()}
    for row in found.collect():  # states and symbols of the automata, whatever the corpus
        counts[row["kind"]][row["state"], row["symbol"]] += row["n"]
    for kind, table in counts.items():
        models[kind].log = np.log(table / table.sum(axis=1, keepdims=True))


def _thresholds(values: DataFrame, models: dict[str, Automaton], spark) -> dict[str, tuple[float, float]]:
    shared = spark.sparkContext.broadcast(models)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        counts: dict[tuple[str, str], np.ndarray] = {}
        for batch in batches:
            for kind, members in _by_kind(batch):
                for model, (ratio, likely) in ratios(own, members).items():
                    wanted = [(kind, ratio)] if kind in (model, OTHER) else []
                    for name, x in [*wanted, *([("likely", likely)] if kind == model else [])]:
                        known = counts.setdefault((model, name), np.zeros(2 * BINS, np.int64))
                        known += np.bincount(_bins(x), minlength=2 * BINS)
        for (model, kind), table in counts.items():
            at = np.flatnonzero(table)
            yield pa.RecordBatch.from_arrays(
                [pa.array([model] * len(at), pa.string()), pa.array([kind] * len(at), pa.string()), pa.array(at), pa.array(table[at])], names=["model", "kind", "bin", "n"]
            )

    counts = {}
    for row in values.mapInArrow(run, "model string, kind string, bin long, n long").groupBy("model", "kind", "bin").agg(F.sum("n").alias("n")).collect():
        counts.setdefault((row["model"], row["kind"]), np.zeros(2 * BINS, np.int64))[row["bin"]] = row["n"]
    limits = {}
    for kind in KINDS:
        if kind in models:
            other = counts[kind, OTHER]
            reached, likely = _reached(counts[kind, kind]), _reached(counts[kind, "likely"])
            above = np.cumsum(other[::-1])[::-1]  # other tokens from each bin on
            strict = int(np.searchsorted(-above, -PASSED * other.sum(), "left"))
            limits[kind] = (max((reached - BINS) // 2, strict - BINS, 0) * BIN, (likely - BINS) * BIN - ODD)
    return limits


def judged(models: dict[str, Automaton], limits: dict[str, tuple[float, float]], values: list[bytes]) -> list[str | None]:
    """For each value the kind it is added under, if any."""
    if not limits or not values:
        return [None] * len(values)
    best, kinds = np.full(len(values), -np.inf), [None] * len(values)
    for kind, (ratio, likely) in ratios(models, values).items():
        least, usual = limits[kind]
        passed = (np.floor(ratio / BIN) * BIN >= least - BIN / 2) & (likely >= usual) & (ratio > best)
        for i in np.flatnonzero(passed):
            best[i], kinds[i] = ratio[i], kind
    return kinds


def joined(marks: list[tuple[str, int, int]]) -> str:
    """Spans as kind:start:end, by start, kind in the order of the rules, and end."""
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(marks, key=lambda m: (m[1], KINDS.index(m[0]), m[2])))


def found_secrets(documents: DataFrame, examples: int = EXAMPLES) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base (rule spans), spans (all spans) and n_added; one row per document."""
    found = stored(marked(documents), "secrets-marks")
    models, limits = learn(found, examples)
    shared = documents.sparkSession.sparkContext.broadcast((models, limits))
    counts = [f"n_{kind}" for kind in KINDS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, limit = shared.value
        for batch in batches:
            rows = batch.column(1).to_pylist()
            # Every token is scored once a batch, however often it stands there.
            tokens = sorted({m["value"] for marks in rows for m in marks if m["kind"] == OTHER})
            kind_of = dict(zip(tokens, judged(own, limit, [t.encode() for t in tokens]), strict=True))
            base = [[(m["kind"], m["start"], m["end"]) for m in marks if m["kind"] != OTHER] for marks in rows]
            more = [[(kind_of[m["value"]], m["start"], m["end"]) for m in marks if m["kind"] == OTHER and kind_of[m["value"]]] for marks in rows]
            numbers = [pa.array([sum(m[0] == kind for m in marks) for marks in base], pa.int64()) for kind in KINDS]
            texts = [pa.array([joined(marks) for marks in base], pa.string()), pa.array([joined(a + b) for a, b in zip(base, more, strict=True)], pa.string())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *numbers, *texts, pa.array([len(m) for m in more], pa.int64())], names=["doc_id", *counts, "base", "spans", "n_added"]
            )

    id_type = documents.schema["doc_id"].dataType.simpleString()
    return found.mapInArrow(run, f"doc_id {id_type}, {', '.join(f'{c} long' for c in counts)}, base string, spans string, n_added long")
