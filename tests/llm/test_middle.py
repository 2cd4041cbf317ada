"""Fill-in-the-middle texts."""

from __future__ import annotations

import hashlib
import re

import pytest
from tables import FOLDER, documents, ordered, pairs

import __spark_entry__ as driver
from check_queries import compare, database
from parcelflow.llm import middle
from parcelflow.llm.middle import Rule

QUERIES = driver.queries()


def brute(doc_id, text, rule=Rule()):
    """(doc_id, n, form, prefix_chars, middle_chars, output)."""
    text = text or ""
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    h = hashlib.sha256(f"{rule.seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    n = len(lines)
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= rule.percent:
        return doc_id, n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = ("".join(x) for x in (lines[:a], lines[a:b], lines[b:]))
    if h4 % 100 < rule.suffix_first:
        return doc_id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def expected(rows, rule=Rule()):
    out = []
    for doc_id, text in rows:
        *facts, output = brute(doc_id, text, rule)
        out.append((*facts, hashlib.sha256(output.encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    return ordered(out)


def marked_documents(spark):
    texts = [
        "a\nb<\nS>c\nd", "x <P> y\nz", "<S>\n", "<M>", "<", "<S", "line\n" * 50 + "<S", "\n\n\n", "one line", "<\n<\n<\n<S\n", "ü\n漢\n\U0001f600\n",
        "P>\nS>\nM>\n" * 9, ("y" * 200_000 + "\n") * 3, "z\n" * 100_000, "w" * 300_000,
    ]
    rows = [(i * 7 + k, t, None, "a", None, "r", "i", None, 1, "o", "m", "w", None) for i, t in enumerate(texts) for k in range(6)]
    return documents(spark, rows)


def test_same_rows_as_sql(spark):
    assert compare(spark, FOLDER, "op11_fill_in_middle", database(FOLDER)) == ""


@pytest.mark.parametrize("rule", [Rule(), Rule("another", 50, 20), Rule("7", 0)])
def test_edges_and_rules(spark, rule):
    for docs in (documents(spark), marked_documents(spark)):
        assert ordered(map(tuple, middle.digests(docs, rule).collect())) == expected(pairs(docs), rule)


def test_empty_table(spark):
    assert middle.digests(documents(spark, [])).collect() == []
    assert middle.texts(middle.chunks(documents(spark, []))).collect() == []


def test_outputs_as_texts(spark):
    docs = marked_documents(spark).unionByName(documents(spark))
    got = middle.texts(middle.chunks(docs)).collect()
    assert ordered(map(tuple, got)) == ordered((r[0], r[2], r[5]) for r in (brute(d, t) for d, t in pairs(docs)))


def test_same_digests_for_every_layout(spark):
    docs = marked_documents(spark)
    runs = [ordered(map(tuple, middle.digests(docs.repartition(n)).collect())) for n in (1, 5)]
    assert runs[0] == runs[1]


def test_long_texts_come_in_bounded_chunks(spark):
    sizes = [len(r["data"]) for r in middle.chunks(marked_documents(spark)).collect()]
    assert max(sizes) <= middle.CHUNK + 3


@pytest.mark.parametrize("step", [1, 2, 3, 5, 1000])
@pytest.mark.parametrize("form", ["psm", "spm"])
def test_parser_finds_marks_across_chunks(form, step):
    parts = [b"pre<\n<S", b"mid\n<", b"<suffix P>"]
    output = b"".join(mark + parts[place] for mark, place in middle.FORMS[form])
    parser = middle._Parser(form)
    found = [f for i in range(0, len(output), step) for f in parser.fed(output[i : i + step])]
    parser.ended()
    assert b"".join(data for _, _, data in sorted(found)) + parser.rest == b"".join(parts)


def test_output_without_its_marks_is_refused():
    parser = middle._Parser("psm")
    list(parser.fed(b"<P>only a prefix"))
    with pytest.raises(ValueError):
        parser.ended()
