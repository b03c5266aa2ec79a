"""Stages of the pipeline, and the whole of it, against plain Python."""

import hashlib
import math
import re
import sys
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from quotepanel.llm import quality
from quotepanel.llm.entries import byte_vocabulary, fertility_vocabularies
from tests.llm.conftest import SCHEMA, prose

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))


def test_stage_keeps_documents_that_came_in_empty(spark):
    import corpus_pipeline

    text = prose(1, 40)
    rows = [(1, None, "en", "a", None), (2, "", "en", "a", 0), (3, text, "en", "a", len(text)), (4, text, "en", "b", len(text)), (None, "", "en", "a", 0)]
    out = corpus_pipeline.repeated_passages(spark, spark.createDataFrame(rows, SCHEMA), "").collect()
    assert sorted(map(tuple, out), key=repr) == sorted(rows[:3] + rows[4:], key=repr)


def documents():
    """Prose in three groups, some of it ever more junk, with copies, near copies, shared passages and texts that fail the base rules."""
    texts = [prose(i, 60 + i % 20) for i in range(150)]
    for i in range(60, 70):
        texts[i] = " ".join([*texts[i - 60].split()[:-1], "changed"])
    for i in range(70, 80):
        texts[i] = " ".join([*texts[i].split()[:30], *texts[i - 50].split()[5:20], *texts[i].split()[30:]])
    texts[80], texts[81], texts[82] = texts[5], prose(81, 10), "word " * 100
    for i in range(110, 150):
        w = texts[i].split()
        texts[i] = " ".join(f"#{j}@x%" if j * 97 % 60 < i - 110 else x for j, x in enumerate(w))
    return [(i, t, ("en", "de", None)[i % 3], "abc"[i % 4 % 3], len(t)) for i, t in enumerate(texts)]


def encoder(tokens):
    ranks = {token: i for i, token in enumerate(tokens)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


def brute_quality(rows, widths=quality.WIDTHS):
    vocabularies = [(tokens, encoder(tokens)) for tokens in fertility_vocabularies()]
    found, groups = {}, defaultdict(list)
    for i, text, lang, *_ in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        windows = [tuple(words[j : j + 3]) for j in range(len(words) - 2)]
        count = Counter(windows)
        again = {j + k for j, w in enumerate(windows) if count[w] > 1 for k in range(3)}
        if len(words) < 50 or 2 * len(again) > len(words):
            continue
        chars = share = 0.0
        for tokens, encode in vocabularies:
            ids = [x for w in words for x in encode(" " + w)]
            chars += sum(map(len, words)) / len(ids) / 2
            share += sum(quality._is_part(tokens[x]) for x in ids) / len(ids) / 2
        entropy = -sum(c / len(ids) * math.log2(c / len(ids)) for c in Counter(ids).values()) / math.log2(len(ids))
        found[i] = (lang, dict(chars_per_token=chars, byte_share=share, token_entropy=entropy))
        groups[lang].append(found[i][1])

    def inside(lang, own):
        for x, floor in quality.FLOORS.items():
            values = sorted(m[x] for m in groups[lang])
            a, b, c = (values[math.ceil(p * len(values)) - 1] for p in (0.25, 0.5, 0.75))
            if own[x] < b - widths[x][0] * max(b - a, floor) or own[x] > b + widths[x][1] * max(c - b, floor):
                return False
        return True

    return [r for r in rows if r[0] in found and inside(*found[r[0]])]


def brute_groups(rows):
    sets, first = {}, {}
    for i, text, *_ in rows:
        w = text.lower().split()
        sets[i], first[i] = {tuple(w[j : j + 5]) for j in range(len(w) - 4)}, i
    for _ in rows:  # the least id spreads
        for i in sets:
            for j in sets:
                both = len(sets[i] & sets[j])
                if first[j] < first[i] and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                    first[i] = first[j]
        if all(first[first[i]] == first[i] for i in first):
            break
    return [r for r in rows if first[r[0]] == r[0]]


def brute_passages(rows):
    seen, out = {}, []
    for i, text, lang, source, _ in sorted(rows):
        gone = [False] * len(text)
        for p in range(len(text) - 49):
            if seen.setdefault(text[p : p + 50], i) < i:
                gone[p : p + 50] = [True] * 50
        kept = "".join(c for c, g in zip(text, gone, strict=True) if not g)
        if kept:
            out.append((i, kept, lang, source, len(kept)))
    return out


def brute_mix(rows):
    weights, size = {"a": 5.0, "b": 2.0, "c": 1.0}, Counter()
    for r in rows:
        size[r[3]] += len(r[1].split())
    target, left = {}, 1.5 * sum(size.values())
    while len(target) < len(size):
        level = left / sum(w for s, w in weights.items() if s not in target)
        full = [s for s in size if s not in target and weights[s] * level > 2 * size[s]]
        if not full:
            target |= {s: weights[s] * level for s in size if s not in target}
        for s in full:
            target[s] = 2.0 * size[s]
            left -= target[s]
    out = []
    for s in size:
        whole = int(target[s] // size[s])
        budget, upto = target[s] - whole * size[s], 0
        own = sorted((hashlib.md5(str(r[0]).encode()).hexdigest()[:9] + hashlib.md5(r[1].encode()).hexdigest()[:9], r) for r in rows if r[3] == s)
        for _, r in own:
            n = len(r[1].split())
            more = upto + n <= budget or upto <= budget and 2 * (budget - upto) >= n
            out += [r] * (whole + more)
            upto += n
    return out


def brute_tokens(rows):
    encode = encoder(byte_vocabulary()[0])
    ids = {r[0]: encode(r[1]) for r in rows}
    return [(r[0], r[3], len(ids[r[0]]), np.array(ids[r[0]], "<u4").tobytes(), True) for r in rows]


def plain(rows):
    return sorted((tuple(bytes(x) if isinstance(x, bytearray) else x for x in r) for r in rows), key=repr)


@pytest.fixture(scope="module")
def expected():
    """The input and what each stage makes of the one before."""
    out = [documents()]
    for brute in (brute_quality, brute_groups, brute_passages, brute_mix, brute_tokens):
        out.append(brute(out[-1]))
    return out


def test_fixture_tells_cuts_apart(expected):
    """Each stage does something, and bands as wide on every side would keep more."""
    sizes = [len(x) for x in expected]
    assert sizes[0] > sizes[1] + 2 and sizes[1] > sizes[2] and sizes[3] < sizes[4] == sizes[5]
    assert sum(map(len, (r[1] for r in expected[2]))) > sum(map(len, (r[1] for r in expected[3])))
    assert len(brute_quality(expected[0], {x: (10.0, 10.0) for x in quality.FLOORS})) > sizes[1]


@pytest.mark.parametrize("k", range(5))
def test_stage_is_plain_python(spark, expected, k):
    import corpus_pipeline

    docs = spark.createDataFrame(expected[k], SCHEMA).repartition(3)
    assert plain(corpus_pipeline.STAGES[k][1](spark, docs, "").collect()) == plain(expected[k + 1])


def test_run_is_plain_python(spark, expected, tmp_path):
    import corpus_pipeline

    spark.createDataFrame(expected[0], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.columns == ["doc_id", "source", "n_tokens", "ids", "round_trip"]
    assert plain(out.collect()) == plain(expected[5])
