"""Nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from quotepanel.llm import bpe, chat, jaccard, langid, mixing, neardup, quality, repeats, sharding, toxicity
from quotepanel.llm.entries import byte_vocabulary, fertility_vocabularies
from tests.llm.conftest import SCHEMA, hard_rows, prose

EMBEDDINGS = "vec_id long, embedding array<float>, label int"


def by_id(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


# --- mixing


def test_mixing_hard_rows(hard, clash):
    rows = mixing.mixture(hard).collect()
    assert len(rows) == hard.count()
    sizes = {r["doc_id"]: r["size"] for r in rows}
    assert sizes[1] == sizes[2] == sizes[3] == 0 and sizes[13] == 2 and sizes[4] == 80
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in rows)
    assert {r["taken"] for r in rows if r["doc_id"] == 5} == {r["taken"] for r in rows if r["doc_id"] == 5}
    assert by_id(mixing.mixture(clash), "doc_id", "taken") == by_id(mixing.mixture(hard), "doc_id", "taken")


def test_mixed_keeps_columns_and_repeats(clash):
    taken = mixing.mixture(clash).filter("doc_id IS NOT NULL AND size > 0").selectExpr("doc_id", "taken / size AS times")
    out = mixing.mixed(clash)
    assert out.columns == clash.columns
    wanted = {}
    for r in taken.collect():
        wanted[r["doc_id"]] = wanted.get(r["doc_id"], 0) + int(r["times"])
    got = {r["doc_id"]: r["count"] for r in out.filter("doc_id IS NOT NULL").groupBy("doc_id").count().collect()}
    assert got == {k: v for k, v in wanted.items() if v}


def test_mixing_targets_by_hand(spark):
    sized = spark.createDataFrame([("0a", 100), ("0b", 1000), ("0c", 10)], "key string, size long")
    # 1665 words to share; a and c stop at 200 and 20, b takes the rest.
    got = {r["key"]: r["target"] for r in mixing.targets(sized).collect()}
    assert got == {"0a": 200.0, "0b": 1445.0, "0c": 20.0}


def test_mixing_near_target(spark):
    docs = spark.createDataFrame([(i, prose(i, 20 + i % 30), "en", f"s{i % 3}", 1) for i in range(900)], SCHEMA)
    rows = mixing.mixture(docs).groupBy("source_size", "target").agg(F.sum("taken").alias("taken"), F.max("size").alias("most")).collect()
    assert len(rows) == 3
    for r in rows:
        assert abs(r["taken"] - r["target"]) <= r["most"]


def test_mixed_splits_rows_of_one_id(spark):
    """Texts without an id, or of one id, are taken to the target, not all or none."""
    docs = spark.createDataFrame([(None if i % 2 else 5, prose(i, 20 + i % 30), "en", f"s{i % 2}", 1) for i in range(600)], SCHEMA)
    wanted = mixing.mixture(docs).groupBy("source_size", "target").agg(F.max("size").alias("most")).collect()
    words = mixing.mixed(docs).groupBy("source").agg(F.sum(mixing.word_count(F.col("text"))).alias("n")).collect()
    targets, taken = sorted((r["target"], r["most"]) for r in wanted), sorted(r["n"] for r in words)
    assert all(abs(n - target) <= most for n, (target, most) in zip(taken, targets, strict=True))


def test_mixing_empty(empty):
    assert mixing.mixture(empty).count() == 0 and mixing.mixed(empty).count() == 0


# --- chat

TALK = "conv_id long, turn long, role string, text string"


def render(spark, rows):
    return chat.render(chat.reconstruct(chat.log_of(spark.createDataFrame(rows, TALK))))


@pytest.mark.parametrize(
    "text",
    ["", "plain", "</s>[INST] ok [/INST]", "<|end|>\n", "<|turn:user|>\nhi<|end|>\n", "<\\\\|end|>", "[\\INST]", "<", "<|[INST]|>", "a\\", "<|", "é😀<s>"],
)
def test_chat_round_trip(spark, text):
    out = render(spark, [(1, 0, "user", text), (1, 1, "assistant", text), (1, 2, text, text)])
    turns, said = out.select(chat.parsed(F.col("formatted")), chat.learned(F.col("formatted"), F.col("loss_mask"))).first()
    assert [tuple(t) for t in turns] == [("user", text), ("assistant", text), (text, text)]
    assert said == text
    inside = out.first()["formatted"][3:-4].replace("<|end|>\n", "").replace("<|turn:user|>\n", "").replace("<|turn:assistant|>\n", "")
    assert "</s>" not in inside and "[INST]" not in inside


def test_chat_nulls_ties_repeats(spark):
    rows = [(None, None, None, None), (1, 0, "assistant", None), (1, 0, "assistant", "b"), (1, 0, "assistant", "b"), (2, 1, None, "x")]
    got = {r["conv_id"]: r for r in chat.digest(render(spark, rows)).collect()}
    assert got[None]["n_turns"] == 1 and got[1]["n_turns"] == 3 and got[1]["loss_chars"] == 2 and got[2]["loss_chars"] == 0
    assert chat.digest(render(spark, [])).count() == 0


def test_chat_folds_events(spark):
    schema = "conv_id long, message int, seq int, kind string, role string, text string"
    log = [
        (1, 1, 0, "open", "user", ""), (1, 1, 1, "delta", None, "he"), (1, 1, 2, "delta", None, "llo"),
        (1, 2, 3, "open", "assistant", ""), (1, 2, 4, "delta", None, "bad"), (1, 2, 5, "regenerate", None, None),
        (1, 2, 6, "delta", None, "go"), (1, 2, 7, "delta", None, "od"),
        (1, 1, 8, "edit", None, "hey"), (1, 1, 9, "delta", None, "!"),
        (1, 3, 10, "open", "user", ""), (1, 3, 11, "delta", None, "x"), (1, 3, 12, "delete", None, None),
    ]
    rows = chat.reconstruct(spark.createDataFrame(log[::-1], schema)).orderBy("message").collect()
    assert [(r["role"], r["text"]) for r in rows] == [("user", "hey!"), ("assistant", "good")]


def test_chat_null_kind_is_a_delta(spark):
    schema = "conv_id long, message int, seq int, kind string, role string, text string"
    log = [
        (1, 1, 0, "open", "user", ""), (1, 1, 1, None, None, "he"), (1, 1, 2, "delta", None, "llo"), (1, 1, 3, None, None, "!"),
        (1, 2, 4, None, "assistant", "bad"), (1, 2, 5, "regenerate", None, None), (1, 2, 6, None, None, "good"),
    ]
    rows = chat.reconstruct(spark.createDataFrame(log, schema)).orderBy("message").collect()
    assert [(r["role"], r["text"]) for r in rows] == [("user", "hello!"), ("assistant", "good")]


# --- Jaccard join


def test_jaccard_hard_rows(hard, clash):
    rows = jaccard.similar_components(hard, 3, 90, 100)
    got = {r["doc_id"]: r for r in rows.collect()}
    assert rows.count() == hard.count()
    assert [got[i]["n_shingles"] for i in (1, 2, 3, 10, 13)] == [0, 0, 0, 1, 1]
    assert [got[i]["component_id"] for i in (1, 2, 3)] == [1, 2, 3]
    assert got[5]["component_id"] == got[6]["component_id"] == 4 and got[9]["component_id"] == 8
    assert got[None]["component_id"] is None and got[None]["n_shingles"] == 78
    out = jaccard.one_per_group(clash, 3, 90, 100)
    assert out.columns == clash.columns
    assert sorted(r["doc_id"] for r in out.collect() if r["doc_id"]) == [1, 2, 3, 4, 7, 7, 8, 10, 11, 12, 13, 14]
    assert out.filter("doc_id IS NULL").count() == 2


def test_one_row_per_group_of_near_copies(spark):
    """A document is its id and text: repeated rows go, another text under the same id is judged by itself."""
    one, two, three = prose(1, 80), prose(2, 80), prose(3, 80)
    rows = [
        (1, one, "en", "a", 1), (7, one + " end", "en", "a", 1), (7, two, "en", "a", 1),  # the second 7 is like no other
        (3, three, "en", "b", 1), (3, three, "en", "b", 1), (3, three, "en", "c", 1),
        (9, two + " end", "en", "a", 1), (2, "", "en", "a", 0), (2, "", "en", "a", 0),
    ]
    out = [(r["doc_id"], r["text"]) for r in jaccard.one_per_group(spark.createDataFrame(rows, SCHEMA), 5, 80, 100).collect()]
    assert sorted(out) == [(1, one), (2, ""), (2, ""), (3, three), (7, two)]


def test_jaccard_empty(empty):
    assert jaccard.similar_components(empty, 3, 90, 100).count() == 0 and jaccard.one_per_group(empty, 5, 80, 100).count() == 0


@pytest.mark.parametrize("k,num", [(3, 90), (5, 80), (1, 60)])
def test_jaccard_brute_force(spark, k, num):
    texts = {}
    for i in range(160):
        base = prose(i % 7, 60).split()
        for j in range(i % 11):
            base[(i * 13 + j * 17) % len(base)] = f"edit{i}x{j}" if i % 2 else f"edit{j}"
        texts[i] = " ".join(base[: 60 - i % 5])
    sets = {}
    for i, text in texts.items():
        w = text.lower().split()
        sets[i] = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} or {tuple(w)}
    root = {i: i for i in texts}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in texts:
        for j in range(i):
            both = len(sets[i] & sets[j])
            if 100 * both >= num * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in texts.items()], SCHEMA)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.similar_components(docs, k, num, 100).collect()}
    assert got == {i: (len(sets[i]), find(i)) for i in texts}


# --- suffix-array dedup


def brute_repeats(rows):
    import hashlib

    first, out = {}, {}
    for i, raw in sorted(rows):
        gone = bytearray(len(raw))
        for p in range(len(raw) - 49):
            w = raw[p : p + 50]
            if first.setdefault(w, i) < i:
                gone[p : p + 50] = b"\1" * 50
        runs = sum(1 for p in range(len(raw)) if gone[p] and not (p and gone[p - 1]))
        out[i] = (len(raw), sum(gone), runs, hashlib.sha256(bytes(b for b, g in zip(raw, gone, strict=True) if not g)).hexdigest())
    return out


def removed(docs):
    rows = repeats.without_repeats(docs).withColumn("sha", F.sha2("kept", 256)).collect()
    return {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["sha"]) for r in rows}


def test_repeats_brute_force(spark):
    shared = [prose(50 + i, 12) for i in range(6)]
    texts = [(i, " ".join([prose(i, 10 + i % 9), shared[i % 6], "é" * (i % 4), shared[(i * 5 + 1) % 6], prose(i % 3, 25)])) for i in range(60)]
    texts += [(100, "ab" * 400), (101, "ab" * 300 + "c"), (102, "x" * 49), (103, "x" * 50), (104, "x" * 200), (105, shared[0][:50]), (106, shared[0][:49])]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in texts], SCHEMA).repartition(5)
    assert removed(docs) == brute_repeats([(i, t.encode()) for i, t in texts])


def test_repeats_hard_rows(hard, clash, empty):
    rows = repeats.without_repeats(clash)
    assert rows.count() == hard.count() and set(clash.columns) - {"text", "kept"} <= set(rows.columns)
    got = rows.collect()
    nameless = [r for r in got if r["doc_id"] is None]
    assert all(r["n_removed"] == 0 for r in nameless)
    whole = {r["doc_id"]: r["n_removed"] == r["n_bytes"] for r in got if r["doc_id"] in (4, 5)}
    assert whole == {4: False, 5: True}
    assert {r["doc_id"]: r["n_bytes"] for r in got}[1] == 0
    unique = [(i, t) for i, t, *_ in hard_rows() if i and i not in (5, 7)]
    mine = removed(hard.filter("doc_id NOT IN (5, 7)"))
    assert mine == brute_repeats([(i, (t or "").encode()) for i, t in unique])
    assert repeats.without_repeats(empty).count() == 0


def test_repeats_as_text(spark):
    docs = spark.createDataFrame([(1, "x" * 60 + "é", None, None, None), (2, "x" * 60 + "è", None, None, None)], SCHEMA)
    kept = {r["doc_id"]: r["kept"] for r in repeats.without_repeats(docs, as_text=True).collect()}
    assert kept == {1: "x" * 60 + "é", 2: ""}


# --- quality


def brute_quality(text):
    import re
    from collections import Counter

    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    count = Counter(windows)
    again = {i + j for i, w in enumerate(windows) if count[w] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(again))


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def judged(docs):
    return quality.judged(quality.measured(docs, fertility_vocabularies(), public_tokenizers.PATTERN))


def test_quality_counts(spark, hard, clash, empty):
    texts = [t for _, t, *_ in hard_rows()] + ["a b c a b c\na b c\n\na b c\n", "# | <x> $5 & 3%\n \n \n", "a a a a", "\n\n"]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts)], SCHEMA)
    got = {r["doc_id"]: tuple(r[c] for c in COUNTS) for r in judged(docs).collect()}
    assert got == {i: brute_quality(t) for i, t in enumerate(texts)}
    assert judged(hard).count() == judged(clash).count() == hard.count()
    assert not judged(hard).filter("base_failed AND kept").count()
    assert judged(empty).count() == 0
    kept = quality.kept_documents(clash, fertility_vocabularies(), public_tokenizers.PATTERN)
    assert kept.columns == clash.columns and kept.filter("doc_id = 8").count() == 1


def test_quality_measures_brute_force(spark):
    import math
    from collections import Counter

    import tiktoken

    texts = [prose(1, 60), "é日本 " * 30 + prose(2, 5), hard_rows()[-3][1], "one"]
    docs = spark.createDataFrame([(i, t, "en", None, None) for i, t in enumerate(texts)], SCHEMA)
    got = quality.measured(docs, fertility_vocabularies(), public_tokenizers.PATTERN).orderBy("doc_id").collect()
    for text, r in zip(texts, got, strict=True):
        words = __import__("re").findall(r"[^\x20\x09-\x0D]+", text)
        chars = share = 0.0
        for tokens in fertility_vocabularies():
            encode = tiktoken.Encoding(
                "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks={t: i for i, t in enumerate(tokens)}, special_tokens={}
            ).encode_ordinary
            ids = [i for w in words for i in encode(" " + w)]
            chars += sum(map(len, words)) / len(ids) / 2
            share += sum(quality._is_part(tokens[i]) for i in ids) / len(ids) / 2
        n = Counter(ids)
        entropy = -sum(c / len(ids) * math.log2(c / len(ids)) for c in n.values()) / math.log2(len(ids)) if len(ids) > 1 else 0
        assert r["chars_per_token"] == pytest.approx(chars) and r["byte_share"] == pytest.approx(share)
        assert r["token_entropy"] == pytest.approx(entropy)


# --- toxicity and language ID


def test_toxicity_hard_rows(spark, hard, clash, empty):
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 15)] + [(None, 1), (3, None), (5, 1)], "doc_id long, toxic int")
    model = toxicity.learn(hard, labels)
    rows = toxicity.scored(clash, model).collect()
    assert len(rows) == hard.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert toxicity.scored(empty, model).count() == 0
    nothing = toxicity.learn(empty, labels.limit(0))
    assert all(r["score"] < 0.01 for r in toxicity.scored(hard, nothing).collect())


def test_language_hard_rows(hard, clash, empty):
    model = langid.learn(hard)
    rows = {r["doc_id"]: r for r in langid.predicted(clash, model).collect()}
    assert rows[1]["lang_pred"] == rows[2]["lang_pred"] == rows[3]["lang_pred"] == "und" and rows[1]["score"] == 0
    assert rows[12]["lang_pred"] != "und" and all(0 <= r["score"] <= 1 for r in rows.values())
    nothing = langid.learn(empty)
    assert nothing is None
    assert {r["lang_pred"] for r in langid.predicted(hard, nothing).collect()} == {"und"}
    assert langid.predicted(empty, model).count() == 0


def test_every_labelled_language_is_learned(spark):
    """Also one whose only documents with letters would all just calibrate."""
    calibrates = F.pmod(F.xxhash64("id", F.lit("calibration")), F.lit(4)) == 0
    ids = spark.range(400).select("id", calibrates.alias("c"), F.col("id").alias("doc_id")).filter(~langid.held_out()).collect()
    only, other = [r["id"] for r in ids if r["c"]], [r["id"] for r in ids if not r["c"]]
    greek = "η γρήγορη καφέ αλεπού πηδά πάνω από τον τεμπέλη σκύλο"
    rows = [(i, prose(i, 60), "en", None, None) for i in other[:20]]
    rows += [(only[0], greek, "el", None, None), (other[20], "12 34", "el", None, None)]
    model = langid.learn(spark.createDataFrame(rows, SCHEMA))
    found = langid.predicted(spark.createDataFrame([(1, "η αλεπού και ο σκύλος", None, None, None)], SCHEMA), model).first()
    assert model.languages == ["el", "en"] and found["lang_pred"] == "el" and not found["rejected"]
    alone = langid.learn(spark.createDataFrame([(only[0], greek, "el", None, None)], SCHEMA))
    assert alone is not None and alone.languages == ["el"]
    assert langid.learn(spark.createDataFrame([(only[0], greek, "el", None, None)] * 40, SCHEMA), docs_per_language=0).languages == ["el"]


def test_language_model_is_a_distribution(spark):
    """For any context the probabilities of all letters and the unknown one add up to one."""
    import numpy as np
    import pandas as pd

    text = "   " + prose(1, 200) + " "
    text = "".join(c if c.isalpha() else " " for c in text)
    grams = pd.Series([text[i : i + 4] for i in range(len(text) - 3)]).value_counts().rename_axis("gram").reset_index(name="n")
    model = langid.fit(grams.assign(lang="en"))
    letters = sorted({g[3] for g in grams["gram"]})
    for context in ("the", " br", "zzz", "   "):
        total = 0.0
        for letter in [*letters, "一"]:
            codes = np.array([ord(c) for c in context + letter], np.uint64)
            total += float(np.exp(model.place_scores(codes)[0, 0]))
        assert total == pytest.approx(1, abs=2e-3)


# --- embeddings


def test_vectors_hard_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, None, 0), (2, [0.0, 0.0], 0), (3, [1.0, None], 0), (4, [nan, 1.0], 0), (5, [inf, 1.0], 0), (6, [], 0),
        (7, [1.0, 0.0], 0), (8, [2.0, 0.0], 0), (9, [1.0, 0.1], None), (10, [1.0, 0.0], 0), (11, [0.0, 1.0], 0),
        (12, [1.0, 0.0, 0.0], 0), (13, [1.0, 0.0, 0.01], 0), (None, [1.0, 0.0], 0), (14, [-1.0, 0.0], 0), (15, [0.0, 3.0], 0), (15, [0.0, 3.0], 0),
    ]
    df = spark.createDataFrame(rows, EMBEDDINGS).selectExpr("*", "1 AS class", "2 AS rep", "3 AS n")
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in neardup.near_duplicates(df).collect()}
    assert {i: got[i] for i in (1, 2, 3, 4, 5, 6, 14)} == {i: (0, i, True) for i in (1, 2, 3, 4, 5, 6, 14)}
    assert [got[i] for i in (7, 8, 9, 10)] == [(3, 7, True), (3, 7, False), (3, 7, False), (3, 7, False)]
    assert got[11] == (2, 11, True) and got[15] == (2, 11, False) and got[12] == (1, 12, True) and got[13] == (1, 12, False)
    assert got[None] == (0, None, True)
    assert neardup.near_duplicates(df.limit(0)).count() == 0


@pytest.mark.parametrize("chunk", [7, 16_384])
def test_vectors_brute_force(spark, monkeypatch, chunk):
    import numpy as np

    monkeypatch.setattr(neardup, "CHUNK", chunk)
    rng = np.random.default_rng(3)
    base = rng.normal(size=(12, 20))
    x = (base[rng.integers(0, 12, 150)] + rng.normal(size=(150, 20)) * rng.uniform(0.05, 0.5, (150, 1))).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], EMBEDDINGS)
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    near = (u @ u.T >= 0.9) & ~np.eye(150, dtype=bool)
    root = np.arange(150)
    for _ in range(150):
        root = np.array([min([root[i], *root[near[i]]]) for i in range(150)])
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in neardup.near_duplicates(df).collect()}
    assert got == {i: (int(near[i].sum()), int(root[i])) for i in range(150)}


def test_vectors_leave_tasks_once(spark, monkeypatch, tmp_path):
    """What the tasks give out grows with the vectors, not with the pairs of chunks."""
    import numpy as np

    rng = np.random.default_rng(5)
    x = rng.normal(size=(600, 24))
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], EMBEDDINGS).coalesce(1)
    plain, given = type(df).mapInArrow, {}

    def counted(self, run, schema, *args, **more):
        noted = str(tmp_path / f"{chunk}-{len(list(tmp_path.iterdir()))}")

        def task(batches):
            for batch in run(batches):
                with open(noted, "a") as file:
                    print(batch.nbytes, file=file)
                yield batch

        open(noted, "w").close()
        return plain(self, task, schema, *args, **more)

    monkeypatch.setattr(type(df), "mapInArrow", counted)
    for chunk in (600, 30):
        monkeypatch.setattr(neardup, "CHUNK", chunk)
        assert neardup.near_duplicates(df).filter("n_links > 0").count() == 0
        given[chunk] = sum(int(line) for path in tmp_path.glob(f"{chunk}-*") for line in path.read_text().split())
    assert given[600] > x.nbytes and given[30] < 1.5 * given[600]


def test_equal_vectors_need_no_chunks(spark, monkeypatch):
    made = []

    class Seen(neardup.Blocks):
        def __init__(self, *args):
            super().__init__(*args)
            made.append(self.chunks)

    monkeypatch.setattr(neardup, "CHUNK", 30)
    monkeypatch.setattr(neardup, "Blocks", Seen)
    df = spark.createDataFrame([(i, [1.0, float(i % 3), 5.0 * (i % 3 == 2)], 0) for i in range(300)], EMBEDDINGS)
    assert {(r["n_links"], r["component_id"]) for r in neardup.near_duplicates(df).collect()} == {(99, 0), (99, 1), (99, 2)}
    assert made == [1]


@pytest.mark.parametrize(("length", "threshold"), [(1, 0.9), (3, 0.5), (70, 0.9), (300, 0.99)])
def test_vectors_of_any_length(spark, monkeypatch, length, threshold):
    """Families that share a tile, equal vectors, vectors of unlike weight: all pairs against all, whichever block finds them."""
    import numpy as np

    monkeypatch.setattr(neardup, "CHUNK", 100)
    monkeypatch.setattr(neardup, "TILE", 4)
    monkeypatch.setattr(neardup, "PENDING", 50)
    monkeypatch.setattr(neardup, "MANY", 64)
    monkeypatch.setattr(neardup, "WIDE", 16)
    rng = np.random.default_rng(length)
    base = rng.normal(size=(9, length)) * np.geomspace(1, 0.05, length)
    x = base[rng.integers(0, 9, 260)] * rng.uniform(0.01, 100, (260, 1))
    x += rng.normal(size=x.shape) * np.abs(x).mean(axis=1, keepdims=True) * rng.uniform(0, 0.8, (260, 1))
    x = np.vstack([x, x[:40]])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = (u @ u.T >= threshold) & ~np.eye(300, dtype=bool)
    got = {r["vec_id"]: r["n_links"] for r in neardup.near_duplicates(df, threshold).collect()}
    assert got == {i: int(near[i].sum()) for i in range(300)}


# --- byte-level BPE


def test_bpe_is_the_public_library(spark, hard, clash, empty):
    import numpy as np
    import tiktoken

    tokens, pattern = byte_vocabulary()
    encode = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks={t: i for i, t in enumerate(tokens)}, special_tokens={}).encode_ordinary
    extra = ["a" * 6000, "ab" * 700 + "😀" * 400, "\n\n  x \t\t y   ", " " * 1000, "don't WE'LL 123abc", "<|endoftext|>"]
    docs = hard.unionByName(spark.createDataFrame([(100 + i, t, None, None, None) for i, t in enumerate(extra)], SCHEMA))
    for r in docs.join(bpe.tokenized(docs.select("doc_id", "text"), tokens, pattern).distinct(), "doc_id").filter("doc_id NOT IN (5, 7)").collect():
        text = r["text"] or ""
        assert bytes(r["ids"]) == np.array(encode(text), "<u4").tobytes() and bytes(r["decoded"]) == text.encode()
    assert bpe.tokenized(clash, tokens, pattern).count() == hard.count() and bpe.tokenized(empty, tokens, pattern).count() == 0


# --- sharding


def brute_table(names, slots):
    import hashlib

    def h(text):
        return int(hashlib.md5(text.encode()).hexdigest()[:12], 16)

    order = [(h(f"{x} offset") % slots, h(f"{x} skip") % (slots - 1) + 1) for x in names]
    filled, tried = [-1] * slots, [0] * len(names)
    for turn in range(slots):
        s = turn % len(names)
        while filled[(order[s][0] + tried[s] * order[s][1]) % slots] >= 0:
            tried[s] += 1
        filled[(order[s][0] + tried[s] * order[s][1]) % slots] = s
        tried[s] += 1
    return filled


@pytest.mark.parametrize("n,slots", [(1, 3), (5, 7), (7, 101), (3, 3)])
def test_shard_table_is_filled_in_turns(spark, n, slots):
    rows = sharding.lookup_table(spark, sharding.shard_names(n), slots).orderBy("slot").collect()
    assert [r["shard"] for r in rows] == brute_table(sharding.shard_names(n), slots)


def test_shards_of_hard_rows(hard, clash, empty):
    names = sharding.shard_names(4)
    rows = sharding.place(clash, F.col("doc_id"), names, 101)
    assert rows.count() == hard.count() and "shard" in rows.columns
    by_key = rows.groupBy("doc_id").agg(F.count_distinct("shard").alias("n")).collect()
    assert {r["n"] for r in by_key} == {1}
    assert sharding.place(empty, F.col("doc_id"), names, 101).count() == 0
    with pytest.raises(ValueError):
        sharding.lookup_table(hard.sparkSession, names, 100)
    with pytest.raises(ValueError):
        sharding.lookup_table(hard.sparkSession, ["a", "a"], 101)


def test_a_shard_that_leaves_moves_few_others():
    names = sharding.shard_names(8)
    before, after = brute_table(names, 1009), brute_table(names[:-1], 1009)
    stayed = [a == b for a, b in zip(before, after, strict=True) if a < 7]
    assert sum(stayed) > 0.7 * len(stayed)
