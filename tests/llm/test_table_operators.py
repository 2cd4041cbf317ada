"""Quality rules, mixing, archive, chat formats, sharding and the pipeline."""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import zlib
from collections import Counter, defaultdict

import brute
import numpy as np
import pytest
from conftest import plan_of
from pyspark.sql import functions as F
from tables import FOLDER, documents, ordered, pairs

import __spark_entry__ as driver
import corpus_pipeline
from check_queries import compare, database
from parcelflow.llm import archive, chat, mixing, near, quality, sharding, suffixes, toxicity
from parcelflow.llm.queries import n_words, source_weights
from parcelflow.llm.shared import new_folder, running, table

QUERIES = driver.queries()


def test_every_operator_has_a_query():
    numbers = sorted(int(m[1]) for n in QUERIES if (m := re.match(r"op(\d+)_", n)))
    assert numbers == list(range(1, 14)) and "pipeline" in QUERIES


@pytest.mark.parametrize("name", ["op4_web_archive", "op6_chat_formatting"])
def test_same_rows_as_sql(spark, name):
    assert compare(spark, FOLDER, name, database(FOLDER)) == ""


def _python_nodes(df):
    plan = plan_of(df).split("Physical Plan")[1]
    return [w for w in ("EvalPython", "InPandas", "InArrow", "PythonUDF", "ArrowEval", "CartesianProduct") if w in plan]


@pytest.mark.parametrize("name", ["op2_quality_rules", "op6_chat_formatting"])
def test_native_queries_run_no_python(spark, name):
    assert _python_nodes(QUERIES[name](spark, FOLDER)) == []


# Quality rules


def test_quality_counts_and_verdicts(spark):
    texts = dict(pairs(table(spark, FOLDER, "documents")))
    got = QUERIES["op2_quality_rules"](spark, FOLDER).collect()
    assert {r["doc_id"]: tuple(r)[1:6] for r in got} == {d: brute.text_counts(t) for d, t in texts.items()}
    for r in got:
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
        assert r["kept"] == (not r["base_failed"] and r["good"] >= quality.LEAST)


def test_quality_agrees_with_labels(spark):
    folder = FOLDER.replace("0.001", "0.01")
    got = QUERIES["op2_quality_rules"](spark, folder).join(table(spark, folder, "labels"), "doc_id").where("not base_failed")
    right = got.where(F.col("kept") == (F.col("quality") == 1)).count()
    assert right / got.count() > 0.98


def test_quality_edges(spark):
    docs = documents(spark)
    got = quality.judged(docs, ["doc_id", "n_words", "row"])
    assert ordered((r[0],) for r in got.select("doc_id").collect()) == ordered((d,) for d, _ in pairs(docs))
    counts = quality.features(docs, ["doc_id"]).collect()
    want = [(d, *brute.text_counts(t)) for d, t in pairs(docs)]
    assert ordered((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) for r in counts) == ordered(want)
    assert quality.judged(documents(spark, []), ["doc_id"]).collect() == []


def test_estimates_are_those_of_plain_expectation_maximisation(spark):
    dice = np.random.default_rng(1)
    rules = len(quality.RULES)
    votes = np.where(dice.random((300, rules)) < 0.3, 0, np.where(dice.random((300, rules)) < 0.8, 1, -1))
    counted = Counter(map(tuple, votes.tolist()))
    patterns = np.array(list(counted)), np.array(list(counted.values()), float)
    v, n = patterns
    good = (1 + (v == 1).sum(1)) / (2 + (v == 1).sum(1) + 3 * (v == -1).sum(1))

    def rates(share):
        return np.array([[((n * share)[v[:, r] == c].sum() + 1) / ((n * share).sum() + 3) for c in (-1, 0, 1)] for r in range(rules)])

    for _ in range(7):
        up, down = rates(good), rates(1 - good)
        prior = ((n * good).sum() + 1) / (n.sum() + 2)
        logs = np.log(prior / (1 - prior)) + sum(np.log(up[r, v[:, r] + 1] / down[r, v[:, r] + 1]) for r in range(rules))
        good = 1 / (1 + np.exp(-logs))
    table_ = spark.createDataFrame([(list(map(int, p)), int(k)) for p, k in counted.items()], "votes array<int>, n long")
    got = {tuple(r["votes"]): r["good"] for r in quality.posteriors(table_, 7).collect()}
    assert all(abs(got[tuple(p)] - g) < 1e-9 for p, g in zip(v.tolist(), good.tolist(), strict=True))


# Mixing


def _mix_check(docs, rows, weights):
    sizes = defaultdict(int)
    for _, source, size in docs:
        sizes[source] += size
    want = brute.targets(sizes, weights, 1.5, 2)
    taken, most = defaultdict(int), defaultdict(int)
    for r in rows:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
        assert r["taken"] <= 2 * r["size"] and (r["size"] == 0 or r["taken"] % r["size"] == 0)
        taken[r["source"]] += r["taken"]
        most[r["source"]] = max(most[r["source"]], r["size"])
    longest = max(most.values(), default=0)
    assert all(abs(taken[s] - want[s]) <= 2 * most[s] + longest for s in sizes)
    assert sum(taken.values()) <= 1.5 * sum(sizes.values()) < sum(taken.values()) + longest + 2


def _weights(sources):
    return {s: (5, 2, 1)[i % 3] for i, s in enumerate(sorted(sources, key=lambda s: (s is None, s or "")))}


def test_mix_query(spark):
    docs = table(spark, FOLDER, "documents").select("doc_id", "source", n_words().alias("size")).collect()
    source = {r["doc_id"]: r["source"] for r in docs}
    got = QUERIES["op3_source_mixing"](spark, FOLDER)
    rows = [r.asDict() | {"source": source[r["doc_id"]]} for r in got.collect()]
    assert len(rows) == len(docs)
    _mix_check([tuple(r) for r in docs], rows, _weights(set(source.values())))
    assert ordered(QUERIES["op3_source_mixing"](spark, FOLDER).collect()) == ordered(got.collect())


def test_mix_is_the_merged_queue_cut_at_the_budget(spark):
    docs = documents(spark).select("doc_id", "source", n_words().alias("size"))
    queued, budget = mixing.weighed(docs, source_weights(docs), 1.5, 2, 0, [])
    copies = []
    for r in queued.collect():
        for i in range(2 if r["size"] else 0):
            finish = r["place"]["finish"] + i * r["source_size"] / r["weight"]
            copies.append(((finish, r["place"]["turn"], r["place"]["id"]), r["size"]))
    copies.sort()
    total, last = 0, None
    for place, size in copies:
        if total + size > budget:
            break
        total, last = total + size, place
    assert tuple(mixing.cut(queued, budget, 2)) == pytest.approx(last)
    mix = mixing.mixed(docs, source_weights(docs))
    assert mix.agg(F.sum("taken")).first()[0] == total
    order = [r["at"]["finish"] for r in mixing.in_order(mix).collect()]
    assert len(order) == mix.agg(F.sum("copies")).first()[0] and order == sorted(order)


def test_mix_edges(spark):
    docs = documents(spark)
    sized = docs.select("doc_id", "source", n_words().alias("size"))
    _mix_check([tuple(r) for r in sized.collect()], [r.asDict() for r in mixing.mixed(sized, source_weights(docs)).collect()], _weights({r[1] for r in sized.collect()}))
    out = mixing.repeated(docs, n_words(), source_weights(docs))
    assert out.columns == docs.columns
    assert out.agg(F.sum(n_words())).first()[0] == mixing.mixed(sized, source_weights(docs)).agg(F.sum("taken")).first()[0]
    empty = documents(spark, [])
    assert mixing.repeated(empty, n_words(), source_weights(empty)).count() == 0
    blank = docs.where("text is null or trim(text) = ''")
    assert mixing.repeated(blank, n_words(), source_weights(blank)).count() == 0


def test_running_sums(spark):
    rows = [(f"g{i % 3}", i * 7919 % 1000, i) for i in range(500)]
    df = spark.createDataFrame(rows, "g string, x long, w long").withColumn("h", F.xxhash64("x", "w"))
    got = running(df, ["g"], F.col("h"), ["h", "x", "w"], F.col("w"), "before").collect()
    for g in ("g0", "g1", "g2"):
        own = sorted((r["before"], r["w"]) for r in got if r["g"] == g)
        # Sums before each row chain up without a gap; rows of weight 0 share theirs.
        assert sum(w for _, w in own) == sum(w for x, _, w in rows if x == g)
        assert all(b + w == c for (b, w), (c, _) in zip([o for o in own if o[1]], [o for o in own if o[1]][1:], strict=False))


# Web archive


PAGES = [(1, "http://a/1", "<p>x</p>"), (2, "http://a/2", "<p>x</p>"), (3, None, None), (4, "http://b c/\n", ""), (5, "http://é", "\r\n\r\nWARC/1.1\r\n\r\né"), (6, "http://l", "y" * 300_000), (6, "http://l", "y" * 300_000), (None, "http://n", "<p>x</p>")]


def _sha1(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


@pytest.mark.parametrize("least", [0, 3])
def test_archive_round_trip(spark, least):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("digest", F.lit("clash")).repartition(3)
    folder = new_folder(spark)
    archive.stored(pages, folder, least=least)
    kept = archive.records(spark, folder).collect()
    assert len(kept) == len(PAGES)
    stored = spark.read.parquet(f"{folder}/payloads").collect()
    assert sorted(bytes(r["payload"]) for r in stored) == sorted({(h or "").encode() for _, _, h in PAGES})
    archive.exported(archive.records(spark, folder), f"{folder}/warc")
    found = archive.resolved(archive.imported(spark, f"{folder}/warc")).collect()
    last = {}
    for p, _, h in PAGES:
        last[h or ""] = max(last.get(h or "", -1), -1 if p is None else p)
    html = {(p, u): h or "" for p, u, h in PAGES}
    assert len(found) == len(PAGES)
    for r in found:
        text = html[(r["page_id"], r["url"])]
        assert (r["payload_bytes"], r["payload_digest"]) == (len(text.encode()), _sha1(text))
        if r["record_type"] == "response":
            assert bytes(r["payload"]) == text.encode() and r["refers_to"] is None
            assert len(text.encode()) < least or r["page_id"] == last[text]
        else:
            assert r["refers_to"] == last[text] and len(text.encode()) >= least
    assert sum(r["record_type"] == "revisit" for r in found) == (4 if least == 0 else 3)


def test_archive_finds_damage(spark):
    folder = new_folder(spark)
    archive.stored(spark.createDataFrame(PAGES[:2], "page_id long, url string, html string"), folder)
    payloads = spark.read.parquet(f"{folder}/payloads")
    payloads.withColumn("payload", F.lit(b"other")).write.parquet(f"{folder}/damaged/payloads")
    spark.read.parquet(f"{folder}/headers").write.parquet(f"{folder}/damaged/headers")
    with pytest.raises(Exception, match="does not match its digest"):
        archive.records(spark, f"{folder}/damaged").collect()


def test_records_are_cut_by_length_alone():
    one = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 12\r\n\r\nh\r\n\r\n\r\n\r\nabc\r\n\r\n"
    assert [p for _, p in archive.parsed(one + one)] == [b"\r\n\r\nabc"] * 2
    with pytest.raises(ValueError):
        list(archive.parsed(one[:-1] + b"x"))
    assert gzip.decompress(gzip.compress(one)) == one


def test_archive_of_nothing(spark):
    folder = archive.archived(spark.createDataFrame([], "page_id long, url string, html string"))
    assert archive.resolved(archive.imported(spark, f"{folder}/warc")).collect() == []


# Chat formats


def test_layouts_become_the_same_turns(spark):
    told = [("user", "a?"), ("assistant", "b")]
    rows = [
        {"prompt": "a?", "completion": "b"},
        {"instruction": "a?", "output": "b"},
        {"instruction": "a", "input": "?", "output": "b"},
        {"system": "s", "instruction": "a?", "output": "b"},
        {"messages": [{"role": "user", "content": "a?"}, {"role": "assistant", "content": "b"}]},
        {"conversations": [{"from": "human", "value": "a?"}, {"from": "gpt", "value": "b"}]},
        {"messages": [{"role": None, "content": "x"}, {"role": "tool", "content": None}]},
        {"prompt": "a?"},
        {"prompt": "a?", "completion": "b", "output": "c"},
        {},
    ]
    schema = "prompt string, completion string, instruction string, input string, output string, system string, layout string, " \
        "messages array<struct<role: string, content: string>>, conversations array<struct<from: string, value: string>>, n int"
    records = spark.createDataFrame([r | {"n": i, "layout": "clash"} for i, r in enumerate(rows)], schema).drop("layout")
    got = {r["n"]: (r["layout"], r["turns"] and [tuple(t) for t in r["turns"]]) for r in chat.canonical(records).collect()}
    assert got[0] == ("prompt", told) and got[1] == ("instruction", told) and got[4] == ("messages", told) and got[5] == ("shared", told)
    assert got[2][1] == [("user", "a\n\n?"), ("assistant", "b")] and got[3][1] == [("system", "s"), *told]
    assert got[6] == ("messages", [("", "x"), ("tool", "")])
    assert got[7] == got[8] == got[9] == (None, None)


def test_missing_columns_are_missing_fields(spark):
    records = spark.createDataFrame([("p", "c", 5)], "prompt string, completion string, extra int")
    got = chat.canonical(records)
    assert got.columns == ["prompt", "completion", "extra", "layout", "turns"] and got.first()["layout"] == "prompt"


NASTY = ["", "\\", "\\\\", "#", "###", "####", "\\###", "</turn>", "<</turn>\n### user: x</turn>\n", "\\### Assistant: </turn> ok", "$1 \\1", "é漢\U0001f600", "\x00 ", "z" * 300_000]


def test_template_is_reversible(spark):
    rows = [(i, [(r, t) for r in ("user", "assistant", "a:b\\", "") for t in (text, text)]) for i, text in enumerate(NASTY)] + [(99, [])]
    records = spark.createDataFrame(rows, "n int, turns array<struct<role: string, text: string>>")
    done = chat.formatted(records).withColumns({"back": chat.read_back(), "learnt": chat.learnt_text()}).collect()
    for r in done:
        assert r["back"] == r["turns"]
        assert r["learnt"] == "".join(t["text"] for t in r["turns"] if t["role"] == "assistant")
        assert [r["formatted"][s["start"] : s["start"] + s["length"]] for s in r["loss"]] == [
            x for t in r["turns"] if t["role"] == "assistant" for x in [_escaped(t["text"])]
        ]


def _escaped(text):
    out = []
    for i, c in enumerate(text):
        if c == "\\" or text.startswith("###", i) or text.startswith("</turn>", i):
            out.append("\\")
        out.append(c)
    return "".join(out)


def test_two_layouts_with_the_same_paths_are_refused(spark):
    twice = (chat.LAYOUTS[0], chat.LAYOUTS[0])
    with pytest.raises(ValueError):
        chat.canonical(spark.createDataFrame([("p",)], "prompt string"), twice)


# Sharding


def test_differencing_beats_a_heap():
    dice = np.random.default_rng(2)
    sums = np.zeros((2_000, 7), np.int64)
    sums[:, 0] = dice.lognormal(7, 1, 2_000).astype(np.int64)
    to, total = sharding.differenced(sums)
    assert (np.bincount(to[:, 0], weights=sums[:, 0], minlength=7) == total).all()
    load = [0] * 7
    for x in sorted(sums[:, 0].tolist(), reverse=True):
        load[load.index(min(load))] += x
    assert total.max() - total.min() <= max(load) - min(load)
    whole = dice.integers(0, 1000, (50, 7))
    to, total = sharding.differenced(whole)
    assert all(sorted(row) == list(range(7)) for row in to.tolist())
    assert (np.bincount(to.ravel(), weights=whole.ravel(), minlength=7) == total).all()


def _shards_check(docs, rows, shards):
    assert ordered((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == ordered(
        (d, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t in docs
    )
    slots, crc = defaultdict(list), defaultdict(set)
    for r in rows:
        assert 0 <= r["shard"] < shards and r["law"] == "bytes" and r["grown_shard"] is None
        slots[r["shard"]].append(r["slot"])
        crc[(r["text_crc32"], r["size"])].add(r["shard"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in crc.values())


def test_same_rows_same_shards_and_mix_for_every_layout(spark, monkeypatch):
    monkeypatch.setattr(sharding, "BATCH", 16)
    monkeypatch.setattr(sharding, "LEVEL", 4)
    same_id = [(7, f"{a} {b} c", None, "s", None, "r", "i", None, 1, "o", "m", "w", None) for a in "pqr" for b in "xyz"]
    docs = documents(spark).unionByName(documents(spark, same_id)).unionByName(
        table(spark, FOLDER, "documents").select("doc_id", "text", "lang", "source", *[F.lit(None).alias(c) for c in documents(spark, []).columns[4:]])
    )
    shards = [ordered(map(tuple, sharding.sharded(docs.repartition(n), 7).collect())) for n in (1, 3, 5)]
    assert shards[0] == shards[1] == shards[2]
    mixes = [ordered(map(tuple, mixing.repeated(docs.repartition(n), n_words(), source_weights(docs)).collect())) for n in (1, 3, 5)]
    assert mixes[0] == mixes[1] == mixes[2]


@pytest.mark.parametrize("batch", [sharding.BATCH, 16])
def test_sharding(spark, monkeypatch, batch):
    monkeypatch.setattr(sharding, "BATCH", batch)
    folder = FOLDER.replace("0.001", "0.01")
    docs, shards = table(spark, folder, "documents"), 40 if batch > 16 else 8
    rows = (QUERIES["op9_sharding"](spark, folder) if batch > 16 else sharding.sharded(docs, 8)).collect()
    _shards_check(pairs(docs), rows, shards)
    sizes = Counter()
    for r in rows:
        sizes[r["shard"]] += r["size"]
    if batch > 16:
        assert max(sizes.values()) - min(sizes.values()) < 0.01 * max(sizes.values())


def test_sharding_edges(spark):
    docs = documents(spark)
    _shards_check(pairs(docs), sharding.sharded(docs, 5).collect(), 5)
    assert sharding.sharded(documents(spark, [])).collect() == []


# Pipeline


def test_pipeline_stages(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "mixing", "sharding"]
    folder = FOLDER.replace("0.001", "0.01")
    docs = table(spark, folder, "documents")
    stage = dict(corpus_pipeline.STAGES)
    model = toxicity.learnt(docs.select("doc_id", "text"), table(spark, folder, "labels"))
    calm = stage["toxicity"](spark, docs, folder)
    assert calm.columns == docs.columns
    assert ordered(calm.select("doc_id").collect()) == ordered(
        toxicity.scored(docs, model).where(F.col("score") < 0.7).select("row.doc_id").collect()
    )
    single = stage["near_duplicates"](spark, calm, folder)
    classes = brute.near_classes(pairs(calm))
    assert ordered((r["doc_id"],) for r in single.collect()) == ordered((c,) for c in set(classes))
    items = [tuple(r) for r in table(spark, folder, "benchmark").select("item_id", "text").collect()]
    clean = stage["decontamination"](spark, single, folder)
    bad = {r[0] for r in brute.contamination(pairs(single), items) if r[5]}
    assert {d for d, _ in pairs(clean)} == {d for d, _ in pairs(single)} - bad and bad
    mix = stage["mixing"](spark, clean, folder)
    assert mix.columns == docs.columns
    want = mixing.mixed(clean.select("doc_id", "source", n_words().alias("size")), source_weights(clean)).where("copies > 0")
    assert Counter(d for d, _ in pairs(mix)) == {r["doc_id"]: r["copies"] for r in want.collect()}
    _shards_check(pairs(mix), stage["sharding"](spark, mix, folder).collect(), 40)


def test_pipeline_edges(spark, tmp_path):
    documents(spark).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1, 1), (None, None, None)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "passage5 passage6"), (2, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert QUERIES["pipeline"](spark, str(tmp_path)).count() > 0
    documents(spark, []).write.parquet(f"{tmp_path}/none/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/none/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/none/benchmark.parquet")
    assert QUERIES["pipeline"](spark, f"{tmp_path}/none").count() == 0
