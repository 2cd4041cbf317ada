"""One query for each operator over the driver's tables, with the SQL that gives the same rows where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelflow.llm import archive, chat, middle, mixing, near, nearest, quality, repair, sharding, substrings, suffixes, tokens, toxicity
from parcelflow.llm.shared import LAST_ID, table, written
from parcelflow.operators.positions import with_position

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def n_words(text: str = "text") -> Column:
    """Number of words of a text, none for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_weights(docs: DataFrame) -> DataFrame:
    """Sources in code point order, the missing one last, weigh 5, 2, 1 and so on."""
    sources = docs.select("source", F.col("source").isNull().alias("missing")).distinct()
    placed = with_position(sources, [], ["missing", "source"])
    return placed.select("source", F.element_at(F.array(F.lit(5), F.lit(2), F.lit(1)), (F.col("position") % 3 + 1).cast("int")).alias("weight"))


@query("op2_quality_rules")
def _(spark: SparkSession, folder: str) -> DataFrame:
    found = quality.judged(table(spark, folder, "documents"), ["doc_id"])
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return found.select("doc_id", *counts, "base_failed", "kept", "good")


@query("op3_source_mixing")
def _(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    mix = mixing.mixed(docs.select("doc_id", "source", n_words().alias("size")), source_weights(docs), share=1.5, repeats=2)
    return mix.select("doc_id", "size", "source_size", "target", "taken")


_WARC_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, strlen(html) AS payload_bytes, sha1(html) AS hex, max(page_id) OVER (PARTITION BY html) AS last FROM p),
b AS (SELECT *, [('0x' || substr(hex, CAST(1 + 5 * i AS INT), 5))::INTEGER for i in range(8)] AS fives FROM d)
SELECT page_id, payload_bytes,
    array_to_string([
        substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((v >> 15) & 31), 1) || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((v >> 10) & 31), 1)
        || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((v >> 5) & 31), 1) || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (v & 31), 1) for v in fives], '') AS payload_digest,
    CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> last THEN last END AS refers_to
FROM b
"""


@query("op4_web_archive", _WARC_SQL)
def _(spark: SparkSession, folder: str) -> DataFrame:
    archives = archive.archived(table(spark, folder, "pages"))
    found = written(archive.imported(spark, f"{archives}/warc", payloads=False))
    return archive.resolved(found).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def conversation_records(rows: DataFrame) -> DataFrame:
    """Conversations, given by turn, in the layouts that such data comes in: the roles of a conversation decide which."""
    told = rows.select(
        "conv_id", F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("content")).alias("m")
    )
    whole = told.groupBy("conv_id").agg(F.sort_array(F.collect_list("m")).alias("ms"))
    roles = F.array_join(F.transform("ms", lambda m: F.regexp_replace(m.role, "[|]", "||")), "|")
    texts = [F.col("ms")[i]["content"] for i in range(3)]
    pair, three = roles == "user|assistant", roles == "system|user|assistant"
    return whole.select(
        "conv_id",
        F.when(pair, texts[0]).alias("prompt"), F.when(pair, texts[1]).alias("completion"),
        F.when(three, texts[0]).alias("system"), F.when(three, texts[1]).alias("instruction"), F.when(three, texts[2]).alias("output"),
        F.when(~pair & ~three, F.transform("ms", lambda m: F.struct(m.role.alias("role"), m.content.alias("content")))).alias("messages"),
    )


_NASTY = "\\### Assistant: </turn> ok"

_CHAT_SQL = r"""
WITH r AS (SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e AS (SELECT *, length(text) - length(replace(text, '\', '')) + (length(text) - length(replace(text, '</turn>', ''))) // 7
    + len([i for i in range(1, length(text)) if text[i:i + 2] = '###']) AS escapes FROM r)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    CAST(sum(4 + length(role) + 2 + length(text) + escapes + 8) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""


@query("op5_toxicity")
def _(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents").select("doc_id", "text"), table(spark, folder, "labels")
    found = toxicity.scored(docs, toxicity.learnt(docs, labels), keep=["doc_id"]).select("row.doc_id", "score")
    predicted = (F.col("score") >= toxicity.LEAST).cast("int").alias("predicted")
    return found.select("doc_id", toxicity.held_out().alias("held_out"), "score", predicted)


@query("op6_chat_formatting", _CHAT_SQL)
def _(spark: SparkSession, folder: str) -> DataFrame:
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(_NASTY).alias("text"),
    )
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    done = chat.formatted(chat.canonical(conversation_records(rows))).select("conv_id", "formatted", "loss")
    done = done.withColumns({"turns": chat.read_back(), "learnt": chat.learnt_text()})
    said = F.array_join(F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), "")
    return done.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.length("learnt").cast("long").alias("loss_chars"), F.sha2("learnt", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


@query("op7_substring_dedup")
def _(spark: SparkSession, folder: str) -> DataFrame:
    found = substrings.repeated_passages(table(spark, folder, "documents"), length=50)
    digest = F.when(F.col("kept").isNull(), F.col("words_sha256")).otherwise(F.sha2("kept", 256))
    return found.select("doc_id", "n_words", "n_removed", digest.alias("kept_sha256"))


_BENCHMARK_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@query("op1_benchmark_decontamination")
def _(spark: SparkSession, folder: str) -> DataFrame:
    docs, items = table(spark, folder, "documents"), table(spark, folder, "benchmark")
    found = suffixes.counted(suffixes.matches(docs, items, size=13, keep=["doc_id"]))
    return found.select("row.doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def _definition(name: str) -> str:
    """Content of an installed tokenizer file, read on the driver."""
    import public_tokenizers

    with open(public_tokenizers.path(name), encoding="utf-8") as file:
        return file.read()


@query("op10_token_counts")
def _(spark: SparkSession, folder: str) -> DataFrame:
    counts = tokens.token_counts(table(spark, folder, "documents"), _definition("byte_bpe_50k.json"))
    return counts.withColumn("over_limit", F.col("n_tokens") > 1024)


@query("op8_near_duplicates")
def _(spark: SparkSession, folder: str) -> DataFrame:
    found = near.classes(table(spark, folder, "documents").select("doc_id", "text"))
    ids = [F.when(F.col(c) < LAST_ID, F.col(c)).alias(n) for c, n in (("id", "doc_id"), ("class_id", "class_id"))]
    return found.select(*ids, F.col("size").alias("n_shingles"), "kept")


@query("op9_sharding")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.sharded(table(spark, folder, "documents"), shards=40)


_MIDDLE_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
l AS (SELECT *, regexp_extract_all(text, '[^\n]*\n|[^\n]+') AS ls,
    [('0x' || substr(h, CAST(1 + 8 * i AS INT), 8))::BIGINT for i in range(4)] AS hs FROM d),
c AS (SELECT *, len(ls) AS n, least(hs[1] % (len(ls) + 1), hs[2] % (len(ls) + 1)) AS a, greatest(hs[1] % (len(ls) + 1), hs[2] % (len(ls) + 1)) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR hs[3] % 100 >= 100 THEN 'plain'
        WHEN hs[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM l),
p AS (SELECT *, array_to_string(ls[1:a], '') AS pre, array_to_string(ls[a + 1:b], '') AS mid, array_to_string(ls[b + 1:n], '') AS suf FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
        ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
    sha256(text) AS restored_sha256
FROM p
"""


@query("op11_fill_in_middle", _MIDDLE_SQL)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return middle.digests(table(spark, folder, "documents"))


@query("op12_nearest_neighbours")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return nearest.named(nearest.neighbours(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0, count=20).found)


def damaged(rows: DataFrame) -> DataFrame:
    """``rows`` (conv_id, turn, role, text) with what a crc32 of conversation and turn does to each; nulls are one blank."""
    at = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    fate = F.crc32(F.concat(at[0], F.lit(":"), at[1]).cast("binary")) % 20
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    text = F.when(fate == 1, "").when(fate == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    told = rows.select("conv_id", "turn", F.when(fate == 4, "user").otherwise(role).alias("role"), text.alias("text"), fate.alias("fate"))
    copies = F.explode(F.when(F.col("fate") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")
    return told.where("fate <> 0").select("conv_id", "turn", "role", "text", copies).drop("copy")


_REPAIR_SQL = r"""
WITH k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name FROM conversations),
f AS (SELECT *, xor(list_reduce(list_prepend(4294967295, [ascii(c)::BIGINT for c in string_split(name, '')]),
    lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [0, 0, 0, 0, 0, 0, 0, 0]),
        lambda x, z: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END))), 4294967295) % 20 AS fate FROM k),
d AS (SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
    CASE fate WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE fate WHEN 3 THEN [0, 1] ELSE [0] END) AS copy FROM f WHERE fate <> 0),
n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS place,
    regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS last FROM d),
g AS (SELECT *, CASE WHEN last = '' THEN 'b' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY place) > 1 THEN 'd' WHEN last NOT IN ('.', '!', '?') THEN 't' ELSE 'k' END AS fault,
    substr(role, 1, 1) AS own, lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY place) AS before FROM n),
r AS (SELECT conv_id, list({'role': role, 'text': text, 'own': own, 'fault': fault} ORDER BY place) AS told,
    coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count_if(fault = 'b') AS blank, count_if(fault = 'd') AS duplicate,
    count_if(fault = 't') AS truncated, count_if(before IS NOT NULL AND before || own NOT IN ('su', 'ua', 'au')) AS illegal FROM g GROUP BY conv_id),
w AS (SELECT list({'a': a, 'z': z, 'e': e, 'c': c, 'op': op, 'own': own}) AS ways FROM (VALUES
    (1, 1, 'D', 3, 'D', ''), (1, 3, 'ID', 5, 'D', ''), (1, 4, 'IID', 7, 'D', ''), (1, 2, 'K', 0, 'K', 's'), (1, 3, 'K', 0, 'K', 'u'), (1, 4, 'IK', 2, 'K', 'a'),
    (1, 3, 'IIK', 4, 'K', 'u'), (1, 3, 'R', 2, 'R', ''), (1, 4, 'IR', 4, 'R', ''), (1, 3, 'IIR', 6, 'R', ''),
    (2, 2, 'D', 3, 'D', ''), (2, 3, 'ID', 5, 'D', ''), (2, 4, 'IID', 7, 'D', ''), (2, 3, 'K', 0, 'K', 'u'), (2, 4, 'IK', 2, 'K', 'a'),
    (2, 3, 'IIK', 4, 'K', 'u'), (2, 3, 'R', 2, 'R', ''), (2, 4, 'IR', 4, 'R', ''), (2, 3, 'IIR', 6, 'R', ''),
    (3, 3, 'D', 3, 'D', ''), (3, 4, 'ID', 5, 'D', ''), (3, 4, 'K', 0, 'K', 'a'), (3, 3, 'IK', 2, 'K', 'u'), (3, 4, 'R', 2, 'R', ''), (3, 3, 'IR', 4, 'R', ''),
    (4, 4, 'D', 3, 'D', ''), (4, 3, 'ID', 5, 'D', ''), (4, 3, 'K', 0, 'K', 'u'), (4, 4, 'IK', 2, 'K', 'a'), (4, 3, 'R', 2, 'R', ''), (4, 4, 'IR', 4, 'R', '')
    ) AS v(a, z, e, c, op, own)),
p AS (SELECT conv_id, list_reduce(list_prepend({'best_to': ['000000000', NULL, NULL, NULL], 'own': '', 'fault': ''},
        [{'best_to': [NULL::VARCHAR, NULL, NULL, NULL], 'own': x.own, 'fault': x.fault} for x in told]),
    lambda s, x: {'best_to': [list_min([lpad(CAST(substr(s.best_to[v.a], 1, 9)::BIGINT + v.c + CASE WHEN v.op <> 'D' AND x.fault = 't' THEN 1 ELSE 0 END AS VARCHAR), 9, '0')
            || substr(s.best_to[v.a], 10) || v.e for v in ways
            if v.z = z AND s.best_to[v.a] IS NOT NULL AND (v.op = 'D' OR (x.fault IN ('k', 't') AND (v.op = 'R' OR v.own = x.own)))]) for z in [1, 2, 3, 4]],
        'own': x.own, 'fault': x.fault}).best_to AS best_to FROM r, w),
b AS (SELECT conv_id, list_min([t for t in [best_to[1], best_to[4], lpad(CAST(substr(best_to[2], 1, 9)::BIGINT + 4 AS VARCHAR), 9, '0') || substr(best_to[2], 10) || 'II',
    lpad(CAST(substr(best_to[3], 1, 9)::BIGINT + 2 AS VARCHAR), 9, '0') || substr(best_to[3], 10) || 'I'] if t IS NOT NULL]) AS best FROM p),
a AS (SELECT conv_id, CAST(substr(best, 1, 9) AS BIGINT) AS cost, substr(best, 10) AS audit FROM b),
s AS (SELECT a.conv_id, list_reduce(list_prepend({'state': '', 'row': 0, 'out': '', 'op': ''},
        [{'state': '', 'row': 0, 'out': '', 'op': o} for o in string_split(audit, '')]),
    lambda s, x: {'state': CASE WHEN x.op = 'D' THEN s.state WHEN x.op = 'K' THEN told[s.row + 1].own WHEN s.state = 'u' THEN 'a' ELSE 'u' END,
        'row': s.row + CASE WHEN x.op = 'I' THEN 0 ELSE 1 END,
        'out': s.out || CASE WHEN x.op = 'D' THEN '' ELSE chr(10) || CASE WHEN x.op = 'K' THEN told[s.row + 1].role WHEN s.state = 'u' THEN 'assistant' ELSE 'user' END
            || ':' || CASE WHEN x.op = 'I' THEN '' ELSE told[s.row + 1].text END END,
        'op': x.op}).out AS out FROM a JOIN r ON a.conv_id IS NOT DISTINCT FROM r.conv_id WHERE audit <> '')
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
    coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, sha256(coalesce(substr(out, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) AS o LEFT JOIN r ON o.conv_id IS NOT DISTINCT FROM r.conv_id
    LEFT JOIN a ON o.conv_id IS NOT DISTINCT FROM a.conv_id LEFT JOIN s ON o.conv_id IS NOT DISTINCT FROM s.conv_id
"""


@query("op13_conversation_repair", _REPAIR_SQL)
def _(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    return repair.reported(damaged(rows), rows)
