"""Operator 4, quality rules by tokeniser fertility.

Two public byte-level vocabularies read every word. From their tokens come,
per document,

* chars_per_token, the mean over both vocabularies of code points of words
  divided by tokens;
* byte_share, the share of tokens that are no whole UTF-8 string, where a
  vocabulary falls back to single bytes, again the mean of both;
* token_entropy, the entropy of the document's tokens (second vocabulary) in
  bits, as a share of the most that so many tokens can have.

Rejection bands are set per group, the language if it is known and else the
script of most letters: the group's median minus and plus its ``WIDTHS`` times
its spread (the distance from the median to the quartile on that side, and no
less than a floor). Medians and quartiles come from all documents of the
group that pass the base rules. A document outside a band is rejected, as is
one that fails the base rules.

Each measure and side has its own width. Text that a tokeniser knows badly has
few characters a token, so that side is the narrow one: the narrowest, in half
steps, that loses at most 1 % of the documents labelled good on every table
measured. The other sides hold next to no poor documents and stay wide.

Each distinct word of a slice is tokenised once and counted as often as it
occurs; a table of words met before is emptied when it has ``REMEMBERED`` bytes,
which changes only the time.

Defined cases: null and empty texts have no words, fail the base rules and
have null measures; texts without a token cannot be outside a band; a group
has bands as soon as it has a document; repeated rows count as often as they
occur; columns of the input other than those named pass through ``judged``.
"""

from __future__ import annotations

import math
import re
import uuid
from collections.abc import Iterator
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import Column, DataFrame, functions as F

from quotepanel.llm.common import as_row, lookup_join, passed, unpacked
from quotepanel.llm.textbytes import IS_SEPARATOR, Texts, distinct, per_text, slices, word_hashes, word_windows, words
from quotepanel.llm.workers import held, lean
from quotepanel.session import stored

MIN_WORDS = 50
MAX_REPEATED = 50  # percent of words
#: Widths of the band below and above the median.
WIDTHS = {"chars_per_token": (5.5, 10.0), "byte_share": (10.0, 10.0), "token_entropy": (10.0, 10.0)}
FLOORS = {"chars_per_token": 0.015, "byte_share": 0.01, "token_entropy": 0.02}
#: Quartiles are exact to one in so many of a group's documents.
ACCURACY = 20_000
#: Bytes of text worked on at once.
SLICE = 1 << 19
WIDE_SPACE = re.compile(r"[^\S ]")
#: Keys of rejected documents (three numbers each) that may be broadcast; more are joined by shuffle.
BROADCAST_REJECTED = 500_000
#: Bytes of words and their tokens that a worker remembers.
REMEMBERED = 16 << 20

SYMBOL = np.zeros(256, bool)
SYMBOL[list(b"#*$%&|<>")] = True
#: First code points of scripts, for documents without a language.
SCRIPTS = ((0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0590, "hebrew"), (0x0600, "arabic"), (0x0900, "indic"), (0x0E00, "other"), (0x3040, "cjk"))

MEASURES = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long,"
    " chars_per_token double, byte_share double, token_entropy double, script string"
)


def _dup_lines(text: bytes) -> int:
    lines = [line for line in text.split(b"\n") if line.strip(b" \t\n\x0b\x0c\r")]
    return len(lines) - len(set(lines))


def _repeated(value: np.ndarray, at: np.ndarray, w, n_texts: int) -> np.ndarray:
    """Words of each text that lie in a window of three that occurs again in it."""
    out = np.zeros(n_texts, np.int64)
    first = np.searchsorted(w.doc[at], np.arange(n_texts + 1)) if len(at) else np.zeros(n_texts + 1, np.int64)
    for i in range(n_texts):
        a, b = first[i], first[i + 1]
        if b - a < 2:
            continue
        order = np.argsort(value[a:b], kind="stable")
        same = value[a:b][order]
        same = same[1:] == same[:-1]
        if same.any():
            twice = np.zeros(b - a + 2, bool)
            again = np.zeros(b - a, bool)
            again[order[1:][same]] = True
            again[order[:-1][same]] = True
            for k in range(3):
                twice[k : b - a + k] |= again
            out[i] = int(twice.sum())
    return out


def _scripts(texts: Texts) -> list[str]:
    """The script of most non-ASCII letters by their lead bytes; Latin if ASCII letters prevail."""
    names = []
    for i in range(len(texts)):
        raw = texts.data[texts.offsets[i] : texts.offsets[i + 1]]
        lead = raw[raw >= 0xCE]
        if 8 * len(lead) <= len(raw):
            names.append("latin")
            continue
        common = int(np.bincount(lead).argmax())
        point = (common - 0xC0) << 6 if common < 0xE0 else (common - 0xE0) << 12 if common < 0xF0 else 0x10000
        names.append([name for start, name in SCRIPTS if start <= point][-1])
    return names


class Reader:
    """Tokens of words by several vocabularies; words stay known by their hash until there are too many."""

    def __init__(self, vocabularies: list[list[bytes]], pattern: str):
        self.encode, self.length, self.part = [], [], []
        for tokens in vocabularies:
            ranks = {token: i for i, token in enumerate(tokens)}
            self.encode.append(tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary)
            self.length.append(np.array([len(t) for t in tokens]))
            self.part.append(np.array([_is_part(t) for t in tokens]))
        self.forget()

    def forget(self) -> None:
        self.hash, self.row = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.size = [np.zeros(0, np.int64) for _ in self.encode]
        self.broken = [np.zeros(0, np.int64) for _ in self.encode]
        self.tokens = np.zeros(0, np.int64)  # by the last vocabulary

    @property
    def held(self) -> int:
        """Bytes of what is remembered."""
        arrays = [self.hash, self.row, self.tokens, *self.size, *self.broken]
        return sum(a.nbytes for a in arrays)

    def _read(self, k: int, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of the words and how many each has; every word is read after a space."""
        text = "".join(f" {word}" for word in words)
        if WIDE_SPACE.search(text):  # such a space may meet the one before the next word
            found = [self.encode[k](f" {word}") for word in words]
            return np.fromiter(chain.from_iterable(found), np.int64), np.array([len(x) for x in found], np.int64)
        tokens = np.array(self.encode[k](text), np.int64)
        upto = np.cumsum([len(word.encode()) + 1 for word in words])
        count = np.searchsorted(np.cumsum(self.length[k][tokens]), upto, "right")
        return tokens, np.diff(count, prepend=0)

    def rows(self, h: np.ndarray, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The rows of distinct words in this reader's columns; new ones are read first."""
        if self.held > REMEMBERED:
            self.forget()
        at = np.minimum(np.searchsorted(self.hash, h), max(len(self.hash) - 1, 0))
        new = np.flatnonzero(self.hash[at] != h) if len(self.hash) else np.arange(len(h))
        if len(new):
            words = [data[a:b].tobytes().decode() for a, b in zip(start[new].tolist(), end[new].tolist(), strict=True)]
            first = len(self.size[0])
            for k, part in enumerate(self.part):
                tokens, size = self._read(k, words)
                self.size[k] = np.concatenate([self.size[k], size])
                self.broken[k] = np.concatenate([self.broken[k], per_text(part[tokens], np.concatenate([[0], np.cumsum(size)]))])
            self.tokens = np.concatenate([self.tokens, tokens])
            self.begin = np.cumsum(self.size[-1]) - self.size[-1]
            hash_, row = np.concatenate([self.hash, h[new]]), np.concatenate([self.row, first + np.arange(len(new))])
            order = np.argsort(hash_, kind="stable")
            self.hash, self.row = hash_[order], row[order]
        return self.row[np.searchsorted(self.hash, h)]


def _is_part(token: bytes) -> bool:
    try:
        token.decode()
    except UnicodeDecodeError:
        return True
    return False


def measures(texts: Texts, reader: Reader) -> dict[str, object]:
    n, data = len(texts), texts.data
    w = words(texts)
    h = word_hashes(data, w)
    value, at = word_windows(h, w, 3)
    code_point = (data & 0xC0) != 0x80
    out: dict[str, object] = {
        "n_words": np.diff(w.first),
        "word_chars": per_text(code_point & ~IS_SEPARATOR[data], texts.offsets),
        "n_symbols": per_text(SYMBOL[data], texts.offsets),
        "n_dup_lines": np.array([_dup_lines(texts.text(i)) for i in range(n)], np.int64),
        "n_repeat_words": _repeated(value, at, w, n),
    }
    one, number = distinct(h)
    word = reader.rows(h[one], data, w.start[one], w.end[one])[number]
    chars, share = np.zeros(n), np.zeros(n)
    for size, broken in zip(reader.size, reader.broken, strict=True):
        n_tokens = per_text(size[word], w.first)
        some = np.maximum(n_tokens, 1)
        chars += out["word_chars"] / some / len(reader.size)
        share += per_text(broken[word], w.first) / some / len(reader.size)
    spread = np.zeros(n)
    for i in range(n):
        own = word[w.first[i] : w.first[i + 1]]
        total = int(n_tokens[i])
        if total > 1:
            lengths = size[own]
            place = np.arange(total) + np.repeat(reader.begin[own] - (np.cumsum(lengths) - lengths), lengths)
            ids = np.sort(reader.tokens[place])
            counts = np.diff(np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1], [True]])))
            spread[i] = (math.log2(total) - float((counts * np.log2(counts)).sum()) / total) / math.log2(total)
    empty = n_tokens == 0
    for name, x in (("chars_per_token", chars), ("byte_share", share), ("token_entropy", spread)):
        out[name] = pa.array(x, pa.float64(), mask=empty)
    out["script"] = _scripts(texts)
    return out


def measured(documents: DataFrame, vocabularies: list[list[bytes]], pattern: str, text: str = "text") -> DataFrame:
    """Every row of ``documents`` but its text, with the base counts and the measures."""
    shared, name = documents.sparkSession.sparkContext.broadcast((vocabularies, pattern)), uuid.uuid4().hex
    names = [part.split()[0] for part in MEASURES.split(",")]
    keep = passed(documents.columns, text, *names)
    rows = documents.select(*[f"`{c}`" for c in keep], f"`{text}`")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = held(name, lambda: Reader(*shared.value))
        for batch in batches:
            for part in slices(batch.column(len(keep)), SLICE):
                found = measures(part, reader)
                columns = [batch.column(i).slice(part.first, len(part)) for i in range(len(keep))]
                yield pa.RecordBatch.from_arrays([*columns, *[pa.array(found[x]) for x in names]], names=[*keep, *names])

    schema = rows.drop(text).schema
    for part in MEASURES.split(","):
        schema = schema.add(*part.split())
    return rows.mapInArrow(lean(run), schema)


def judged(measured_rows: DataFrame, lang: str = "lang", widths: dict[str, tuple[float, float]] = WIDTHS) -> DataFrame:
    """Adds the verdicts base_failed and kept to rows of ``measured``.

    The bands are one row per group and are broadcast while they are few.
    """
    group = F.coalesce(F.concat(F.lit("lang "), F.col(f"`{lang}`")), F.concat(F.lit("script "), F.col("script")))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    columns = passed(measured_rows.columns, "base_failed", "kept")
    rows = measured_rows.select(as_row(columns), failed.alias("base_failed"), group.alias("group"), *FLOORS)
    quartiles = [F.percentile_approx(F.when(~F.col("base_failed"), F.col(x)), [0.25, 0.5, 0.75], ACCURACY).alias(x) for x in FLOORS]
    by_group = rows.groupBy("group").agg(*quartiles)

    def low(x: str) -> Column:
        q = F.col(x)
        return (q[1] - widths[x][0] * F.greatest(q[1] - q[0], F.lit(FLOORS[x]))).alias(f"low_{x}")

    def high(x: str) -> Column:
        q = F.col(x)
        return (q[1] + widths[x][1] * F.greatest(q[2] - q[1], F.lit(FLOORS[x]))).alias(f"high_{x}")

    bands = stored(by_group.select(F.col("group").alias("of"), *[low(x) for x in FLOORS], *[high(x) for x in FLOORS]), "bands")
    joined = lookup_join(rows, bands, F.col("group") == F.col("of"), bands.count())
    outside = [(F.col(x) < F.col(f"low_{x}")) | (F.col(x) > F.col(f"high_{x}")) for x in FLOORS]
    rejected = reduce(Column.__or__, [F.coalesce(x, F.lit(False)) for x in outside])
    return joined.select(*unpacked(columns), "base_failed", (~F.col("base_failed") & ~rejected).alias("kept"))


def kept_documents(documents: DataFrame, vocabularies: list[list[bytes]], pattern: str) -> DataFrame:
    """The rows of ``documents`` (doc_id, lang, text and others) that the rules keep, with all columns.

    Rows with one id, language and text have one verdict, so the rejected ones
    are told by those; texts are not written again.
    """
    key = {"_id": F.col("doc_id"), "_lang": F.col("lang"), "_sign": F.xxhash64(F.coalesce("text", F.lit("")))}
    slim = documents.select(*[value.alias(name) for name, value in key.items()], "text")
    rows = stored(measured(slim, vocabularies, pattern), "quality-measures")
    gone = judged(rows, "_lang").filter(~F.col("kept")).select(*[F.col(name).alias(f"{name}_gone") for name in key]).distinct()
    gone = stored(gone, "rejected")
    same = reduce(Column.__and__, [value.eqNullSafe(F.col(f"{name}_gone")) for name, value in key.items()])
    return documents.join(F.broadcast(gone) if gone.count() <= BROADCAST_REJECTED else gone, same, "left_anti")
