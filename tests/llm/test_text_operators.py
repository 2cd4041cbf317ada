"""Contamination, repeated passages, near copies, token counts and toxicity against plain versions."""

from __future__ import annotations

import random
import zlib

import brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tables import FOLDER, documents, ordered, pairs

import __spark_entry__ as driver
from parcelflow.llm import near, substrings, suffixes, tokens, toxicity
from parcelflow.llm.queries import _definition
from parcelflow.llm.shared import table

QUERIES = driver.queries()


def given(spark):
    return pairs(table(spark, FOLDER, "documents"))


# Benchmark decontamination


ITEMS = [(1, "Word1x1 word2x2 word3x3"), (2, None), (3, ""), (None, "one"), (4, "ONE"), (5, " ".join(f"Passage{i}" for i in range(5, 40))), (5, "漢字"), (10, "--")]


def _contaminated(spark, docs, items):
    found = suffixes.counted(suffixes.matches(docs, spark.createDataFrame(items, "item_id long, text string")))
    return found.select("row.doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()


def test_contamination_query(spark):
    items = [tuple(r) for r in table(spark, FOLDER, "benchmark").select("item_id", "text").collect()]
    got = QUERIES["op1_benchmark_decontamination"](spark, FOLDER).collect()
    assert ordered(got) == ordered(brute.contamination(given(spark), items))
    assert sum(r["contaminated"] for r in got) > 0


@pytest.mark.parametrize("block", [suffixes.BLOCK_BYTES, 40])
def test_contamination_edges_and_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(suffixes, "BLOCK_BYTES", block)
    docs = documents(spark)
    known = [i for i in ITEMS if i[0] is not None]
    assert ordered(_contaminated(spark, docs, ITEMS)) == ordered(brute.contamination(pairs(docs), known))


def test_contamination_of_nothing(spark):
    docs = documents(spark)
    assert all(not r["contaminated"] for r in _contaminated(spark, docs, []))
    assert _contaminated(spark, documents(spark, []), ITEMS) == []
    kept = suffixes.clean(docs, spark.createDataFrame(ITEMS, "item_id long, text string"))
    assert kept.columns == docs.columns and kept.count() < docs.count()


def test_longest_match_goes_on_past_the_window(spark):
    words = [f"w{i}" for i in range(40)]
    docs = spark.createDataFrame([(1, "x " + " ".join(words[:20])), (2, " ".join(words[5:35]) + " y")], "doc_id long, text string")
    items = spark.createDataFrame([(7, " ".join(words))], "item_id long, text string")
    found = {r["item_start"]: (r["longest"], r["doc_id"], r["doc_start"], r["n_places"]) for r in suffixes.longest_matches(docs, items).collect()}
    assert found[0] == (20, 1, 1, 1) and found[6] == (29, 2, 1, 2) and found[22] == (13, 2, 17, 1) and 23 not in found


def test_suffix_array_is_sorted():
    codes = np.array(random.Random(1).choices(range(3), k=300), np.int64)
    order = suffixes.suffix_array(codes, len(codes))
    assert sorted(range(300), key=lambda i: codes[i:].tolist()) == order.tolist()


# Repeated passages


def test_passages_query(spark):
    got = QUERIES["op7_substring_dedup"](spark, FOLDER).collect()
    assert ordered(got) == ordered(brute.substring_dedup(given(spark)))
    assert sum(r["n_removed"] for r in got) > 0


@pytest.mark.parametrize("length", [3, 50, 71])
def test_passages_edges(spark, length):
    docs = documents(spark)
    found = substrings.repeated_passages(docs, length)
    digest = F.when(F.col("kept").isNull(), F.col("words_sha256")).otherwise(F.sha2("kept", 256))
    got = found.select("doc_id", "n_words", "n_removed", digest).collect()
    assert ordered(got) == ordered(brute.substring_dedup(pairs(docs), length))
    assert all(sum(s["end"] - s["start"] for s in r["spans"]) == r["n_removed"] for r in found.collect())


def test_passages_random_overlaps(spark):
    dice = random.Random(5)
    rows = [(i, " ".join(dice.choices("abc", k=dice.randint(0, 60)))) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    digest = F.when(F.col("kept").isNull(), F.col("words_sha256")).otherwise(F.sha2("kept", 256))
    got = substrings.repeated_passages(docs, 6).select("doc_id", "n_words", "n_removed", digest).collect()
    assert ordered(got) == ordered(brute.substring_dedup(rows, 6))


def test_passages_of_nothing(spark):
    assert substrings.repeated_passages(documents(spark, [])).collect() == []


# Near duplicates


def _near_rows():
    dice = random.Random(3)
    words = [f"v{i}" for i in range(2_000)]
    rows, edits = [], 0
    for group in range(40):
        text = dice.choices(words, k=dice.randint(60, 400))
        for copy in range(dice.randint(1, 5)):
            own = list(text)
            for _ in range(dice.randint(0, max(1, len(own) // 80))):
                own[dice.randrange(len(own))] = "edited"
                edits += 1
            rows.append((group * 10 + copy, " ".join(own)))
    return rows + [(401, "a b c"), (402, "a  b\nc"), (403, "a b"), (404, "a b c d e f"), (405, None), (406, "")]


def test_near_classes_against_all_pairs(spark):
    rows = _near_rows()
    found = near.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["id"]: r["class_id"] for r in found} == dict(zip([d for d, _ in rows], brute.near_classes(rows), strict=True))
    assert sum(r["kept"] for r in found) == len({r["class_id"] for r in found})


def test_near_query_recall(spark):
    docs = given(spark)
    want = dict(zip([d for d, _ in docs], brute.near_classes(docs), strict=True))
    got = {r["doc_id"]: r["class_id"] for r in QUERIES["op8_near_duplicates"](spark, FOLDER).collect()}
    assert got == want and len(set(got.values())) < len(got)


def test_near_copies_of_a_hot_group(spark):
    """Copies of one text, each edited at another place: one class, whoever leads the buckets."""
    base = [f"w{i}" for i in range(300)]
    rows = [(i, " ".join([*base[:i], "edited", *base[i + 1 :]])) for i in range(200)] + [(900, "not like any of the others at all here")]
    found = near.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["class_id"] for r in found} == {0, 900}


def _linked(spark, members, texts):
    """Label of each node after all rounds. ``members``: nodes of each bucket, the smallest ones the heaviest."""
    buckets = members
    size = {n: max(1, len(t.split()) - 4) for n, t in texts.items()}
    rows = [(key, n, 1_000 - n, size[n], size[n]) for key, nodes in members.items() for n in nodes]
    members = spark.createDataFrame(rows, "key long, node long, weight long, size long, news long")
    told = [(n, t, [key for key, nodes in buckets.items() if n in nodes]) for n, t in texts.items()]
    found = near._labels(members, spark.createDataFrame(told, "node long, text string, sketch array<long>"))
    return {n: n for n in texts} | {r["node"]: r["label"] for r in found.collect()}


def _text(name, edited=None):
    return " ".join("edited" if i == edited else f"{name}{i}" for i in range(100))


def test_near_third_class_of_a_bucket_leads(spark):
    """Two heavy members like nothing else, and near copies behind them; another bucket gains its link first."""
    texts = {1: _text("p"), 2: _text("q"), 3: _text("b"), 4: _text("b", 50), 5: _text("x"), 6: _text("x", 50)}
    assert _linked(spark, {70: [1, 2, 3, 4], 71: [5, 6]}, texts) == {1: 1, 2: 2, 3: 3, 4: 3, 5: 5, 6: 5}


def test_near_buckets_end_on_their_own(spark):
    """Near copies behind members like nothing else, when no other bucket gains a link and after many rounds."""
    texts = {n: _text(f"p{n}_") for n in range(1, 40)} | {50: _text("b"), 51: _text("b", 50), 52: _text("c"), 53: _text("c", 50)}
    want = {n: n for n in texts} | {51: 50, 53: 52}
    assert _linked(spark, {70: [1, 50, 51]}, texts) == want | {52: 52, 53: 53}
    assert _linked(spark, {70: list(texts)}, texts) == want


@pytest.mark.parametrize("block", [near.BLOCK, 500])
def test_near_hot_buckets_against_all_pairs(spark, monkeypatch, block):
    """Half-similar families, near copies among them, and unlike texts with one long line in common, also in small blocks."""
    monkeypatch.setattr(near, "BLOCK", block)
    dice = random.Random(11)
    base, line = [f"h{i}" for i in range(150)], [f"l{i}" for i in range(40)]
    rows = []
    for i in range(120):
        own = list(base)
        for at in dice.sample(range(150), dice.choice([0, 1, 2, 3, 4, 6, 8])):
            own[at] = f"e{i}_{at}"
        rows.append((i, " ".join(own)))
    rows += [(200 + i, " ".join([*line, *(f"u{i}_{k}" for k in range(60))])) for i in range(120)]
    rows += [(400 + i, " ".join(["same"] * 30 + [*line, *(f"x{k}" for k in range(60 - i))])) for i in range(8)]
    found = near.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = dict(zip([d for d, _ in rows], brute.near_classes(rows), strict=True))
    got = {r["id"]: r["class_id"] for r in found}
    # No two of a class are in another; of those that belong together at most a few go unseen by all sketches.
    assert all(want[r["id"]] == want[r["class_id"]] for r in found)
    assert sum(got[d] == want[d] for d in want) >= len(want) - 2


def test_near_pairs_aligned_grow_with_the_texts(spark):
    """Texts that share a line: the leader's pairs grow as the texts do, and no other pair becomes a row."""
    line = [f"l{i}" for i in range(40)]
    counts = []
    for n in (200, 400):
        texts = {i: " ".join([*line, *(f"u{i}_{k}" for k in range(60))]) for i in range(n)}
        members = spark.createDataFrame([(7, i, n - i, 96, 96) for i in texts], "key long, node long, weight long, size long, news long")
        leaders = spark.createDataFrame([(7, 0, 96, 96)], "key long, leader long, leader_size long, leader_news long")
        counts.append(members.join(leaders, "key").where("node != leader").count())
        told = spark.createDataFrame([(i, t, [7]) for i, t in texts.items()], "node long, text string, sketch array<long>")
        assert near._labels(members, told).count() == 0
    assert counts == [199, 399]


def test_near_copies_of_few_words(spark):
    """Four of five shingles are alike: 0.8 exactly."""
    rows = [(2 * i + more, " ".join(f"w{i}_{k}" for k in range(8 + more))) for i in range(400) for more in (0, 1)]
    found = near.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["class_id"] for r in found} == {2 * i for i in range(400)}


def test_near_copies_with_a_repeated_line(spark):
    """Alike by first occurrences alone: one of two has a further line many times."""
    lines = [" ".join(f"t{i}_{k}" for k in range(204)) for i in range(20)]
    extra = [" ".join(" ".join(f"l{i}_{k}" for k in range(10)) for _ in range(50)) for i in range(20)]
    rows = [(i, t) for i, t in enumerate(lines)] + [(100 + i, f"{t}\n{x}") for i, (t, x) in enumerate(zip(lines, extra, strict=True))]
    found = near.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["id"]: r["class_id"] for r in found} == {i: i for i in range(20)} | {100 + i: i for i in range(20)}


def test_near_edges(spark):
    docs = documents(spark)
    kept = near.without_copies(docs)
    assert kept.columns == docs.columns
    got = pairs(kept)
    # Texts without words all stay, repeated ones too; of others one for each class.
    assert sum(not (t or "").split() for _, t in got) == sum(not (t or "").split() for _, t in pairs(docs))
    assert sorted(d for d, t in got if (t or "").strip() and d is not None and d in (6, 7, 8, 9)) == [6, 8]
    assert [d for d, t in got if t and "passage1 " in t] == [1]
    assert near.without_copies(documents(spark, [])).count() == 0


def test_alignment_respects_order():
    left = np.arange(1, 101, dtype=np.uint64)
    turned = np.concatenate((left[50:], left[:50]))
    assert near.similarity(left, left) == 1.0
    assert near.similarity(left, turned) == 0.0
    assert near.similarity(left, np.delete(left, 50)) == 0.99
    assert near.similarity(left, np.concatenate((left[:30], left[60:]))) == 0.0


def test_components_of_a_path(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101)], "a long, b long")
    got = {r["node"]: r["label"] for r in near.components(links, "a", "b").collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}


# Token counts


def test_token_counts(spark):
    from tokenizers import Tokenizer

    definition = _definition("byte_bpe_50k.json")
    library = Tokenizer.from_str(definition)
    edge = documents(spark).select("doc_id", "text")
    want = [(d, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for d, t in pairs(edge)]
    for commonest in (0, 50):
        assert ordered(tokens.token_counts(edge, definition, commonest).collect()) == ordered(want)
    got = QUERIES["op10_token_counts"](spark, FOLDER).collect()
    texts = given(spark)
    assert ordered((r[0], r[1], r[2]) for r in got) == ordered(
        (d, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for d, t in texts
    )
    assert all(r["over_limit"] == (r["n_tokens"] > 1024) for r in got)
    assert tokens.token_counts(documents(spark, []), definition).collect() == []


def test_split_is_the_library_split_for_every_character():
    definition = _definition("byte_bpe_50k.json")
    cut, library = tokens.Splitter(definition), tokens._library(definition).pre_tokenizer.pre_tokenize_str
    for low in range(0, 0x110000, 37):
        if not 0xD800 <= low < 0xE000:
            text = f"a{chr(low)}a 1{chr(low)}1 .{chr(low)}. {chr(low)}{chr(low)} \n{chr(low)}'s"
            assert cut(text)[0] == [text[a:b] for _, (a, b) in library(text)], hex(low)


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError):
        tokens.Splitter(_definition("word_bpe_49k.json"))


# Toxicity


def _auc(scores, marks):
    order = np.argsort(np.argsort(scores))
    positive = order[marks]
    return (positive.sum() - len(positive) * (len(positive) - 1) / 2) / (len(positive) * (~marks).sum())


def test_toxicity_on_held_out_rows(spark):
    folder = FOLDER.replace("0.001", "0.1")
    got = QUERIES["op5_toxicity"](spark, folder).toPandas()
    labels = table(spark, folder, "labels").toPandas()
    assert len(got) == table(spark, folder, "documents").count()
    assert all(got["held_out"] == got["doc_id"].map(lambda d: zlib.crc32(str(d).encode()) % 3 == 1))
    assert got["score"].between(0, 1).all() and ((got["score"] >= 0.7) == (got["predicted"] == 1)).all()
    known = got.merge(labels, on="doc_id")
    known = known[known["held_out"]]
    toxic = (known["toxic"] == 1).to_numpy()
    assert _auc(known["score"].to_numpy(), toxic) > 0.95
    called = known["predicted"].to_numpy() == 1
    assert toxic[called].mean() > 0.95 and called[toxic].mean() > 0.6


def test_held_out_labels_are_not_read(spark):
    docs, labels = table(spark, FOLDER, "documents").select("doc_id", "text"), table(spark, FOLDER, "labels")
    turned = labels.withColumn("toxic", F.when(toxicity.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert (toxicity.learnt(docs, labels) == toxicity.learnt(docs, turned)).all()


def test_toxicity_edges(spark):
    docs = documents(spark)
    labels = spark.createDataFrame([(1, 1), (3, None), (None, 1), (6, 0)], "doc_id long, toxic int")
    for known in (labels, labels.limit(0)):
        found = toxicity.scored(docs, toxicity.learnt(docs.select("doc_id", "text"), known)).collect()
        assert len(found) == docs.count() and all(0 <= r["score"] <= 1 for r in found)
        assert len({r["score"] for r in found if not (r["row"]["text"] or "").strip()}) == 1
    empty = documents(spark, [])
    assert toxicity.scored(empty, toxicity.learnt(empty, labels)).collect() == []


def test_negative_part_is_corrected():
    """Half of the unlabelled texts are positives; the risk takes them out again, so they score as positives."""
    bucket, first = [], [0]
    for kind in [0] * 100 + [0] * 100 + [1] * 100:
        bucket += [kind, 2]
        first.append(len(bucket))
    positive = np.array([True] * 100 + [False] * 200)
    model = toxicity.fitted(np.array(bucket), np.ones(len(bucket)), np.array(first), positive, 0.5)
    score = 1 / (1 + np.exp(-(model[[0, 1]] + model[2] + model[-1])))
    assert score[0] > 0.9 and score[1] < 0.1


def test_features_do_not_depend_on_neighbours():
    alone = toxicity.word_counts(pa.array(["Some words here"], pa.large_string()))
    third = toxicity.word_counts(pa.array(["x y z", "", "Some words here"], pa.large_string()))
    a = third[2][2]
    assert (third[0][a:] == alone[0]).all() and (third[1][a:] == alone[1]).all()
