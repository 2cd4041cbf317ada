"""Chat formatting: layouts found by a fingerprint of their fields, canonical turns, a reversible template.

Records of many layouts lie in one table whose columns are the union of all fields, null where a record lacks one. The
fingerprint of a record is the hash of its nested field paths, and it selects the declared layout that says how the
record becomes turns. Everything is column expressions.

The template writes each turn as ``### role: text</turn>`` and a line end. In a text, a backslash stands before each
backslash, before each ``#`` that begins ``###`` and before each ``<`` that begins ``</turn>``; in a role also before
each colon. So no text can end its turn or begin another, and dropping the backslashes gives the text back.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TURNS = "array<struct<role: string, text: string>>"
#: A turn as the template writes it; possessive, so long texts need no stack.
_TURN = r"(?s)### ((?:[^\\:]++|\\.)*+): ((?:[^\\<]++|\\.|<(?!/turn>))*+)</turn>\n"


@dataclass(frozen=True)
class Layout:
    """A way in which records hold a conversation: the field paths they have, and SQL that makes turns of them.

    Fields in ``optional`` may be missing or null.
    """

    name: str
    paths: tuple[str, ...]
    turns: str
    optional: tuple[str, ...] = ()

    def variants(self) -> list[str]:
        """All sets of paths that a record of this layout may have, as they are hashed."""
        chosen = (itertools.combinations(self.optional, n) for n in range(len(self.optional) + 1))
        return [",".join(sorted(self.paths + more)) for more in itertools.chain(*chosen)]


#: The order of the turns stands in each mapping; a missing optional text makes no turn.
LAYOUTS = (
    Layout(
        "prompt", ("prompt", "completion"),
        "array(struct('user' AS role, prompt AS text), struct('assistant' AS role, completion AS text))",
    ),
    Layout(
        "instruction", ("instruction", "output"),
        "array_compact(array(if(system IS NULL, NULL, struct('system' AS role, system AS text)), "
        "struct('user' AS role, if(input IS NULL, instruction, concat(instruction, '\\n\\n', input)) AS text), "
        "struct('assistant' AS role, output AS text)))",
        ("system", "input"),
    ),
    Layout(
        "messages", ("messages[].role", "messages[].content"),
        "transform(messages, m -> struct(coalesce(m.role, '') AS role, coalesce(m.content, '') AS text))",
    ),
    Layout(
        "shared", ("conversations[].from", "conversations[].value"),
        "transform(conversations, m -> struct(CASE m.from WHEN 'human' THEN 'user' WHEN 'gpt' THEN 'assistant' "
        "ELSE coalesce(m.from, '') END AS role, coalesce(m.value, '') AS text))",
    ),
)

#: Every field that a layout may use; ``with_fields`` adds those that a table lacks.
FIELDS = {
    "prompt": "string", "completion": "string", "instruction": "string", "input": "string", "output": "string", "system": "string",
    "messages": "array<struct<role: string, content: string>>", "conversations": "array<struct<from: string, value: string>>",
}


def with_fields(records: DataFrame) -> DataFrame:
    return records.withColumns({c: F.lit(None).cast(t) for c, t in FIELDS.items() if c not in records.columns})


def _present(kind: T.DataType, path: str, value: Callable[[Column], Column], root: Column) -> list[tuple[str, Column]]:
    """Each leaf path below a field and whether a record has it; a path through an array is there if an element has it."""
    if isinstance(kind, T.StructType):
        found = []
        for field in kind.fields:
            found += _present(field.dataType, f"{path}.{field.name}", lambda r, n=field.name: value(r)[n], root)
        return found
    if isinstance(kind, T.ArrayType):
        inner = _present(kind.elementType, f"{path}[]", lambda e: e, root)
        # The condition on an element is a function of it, so nested arrays nest ``exists``.
        return [(p, lambda r, test=test: F.coalesce(F.exists(value(r), test), F.lit(False))) for p, test in inner]
    return [(path, lambda r: value(r).isNotNull())]


def fingerprint(records: DataFrame, fields: Sequence[str] = tuple(FIELDS)) -> Column:
    """Hash of the nested paths that a record has among ``fields``, in sorted order; other columns don't count."""
    tests = []
    for name in fields:
        for path, test in _present(records.schema[name].dataType, name, lambda r: r, None):
            tests.append((path, test(F.col(name))))
    marks = [F.when(test, F.lit(path)) for path, test in sorted(tests, key=lambda x: x[0])]
    return F.xxhash64(F.concat_ws(",", *marks))


def canonical(records: DataFrame, layouts: Sequence[Layout] = LAYOUTS) -> DataFrame:
    """``records`` with ``layout`` (null if no layout has their fingerprint) and ``turns`` (role, text) beside them.

    A record without any field, or with fields that no layout declares together, has null turns. A null role or text
    inside a list counts as empty.
    """
    known = [(paths, layout) for layout in layouts for paths in layout.variants()]
    if len({p for p, _ in known}) < len(known):
        raise ValueError("two layouts declare the same paths")
    filled = with_fields(records)
    mark = filled.withColumn("_mark", fingerprint(filled))
    name, turns = F.lit(None).cast("string"), F.lit(None).cast(_TURNS)
    for layout in layouts:
        own = F.col("_mark").isin([F.xxhash64(F.lit(p)) for p in layout.variants()])
        name = F.when(own, F.lit(layout.name)).otherwise(name)
        turns = F.when(own, F.expr(layout.turns).cast(_TURNS)).otherwise(turns)
    return mark.withColumns({"layout": name, "turns": turns}).drop("_mark", *[c for c in FIELDS if c not in records.columns])


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(\\|#(?=##)|<(?=/turn>))", r"\\$1")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def formatted(records: DataFrame, turns: str = "turns", learnt: str = "assistant") -> DataFrame:
    """``records`` with ``formatted``, the conversation as text, and ``loss``, the spans of it that are learnt.

    ``loss`` has a (start, length) in characters for each turn of the role ``learnt``: its escaped text and nothing else.
    Null turns give a null text.
    """
    parts = F.transform(
        turns,
        lambda t: F.struct(
            F.concat(F.lit("### "), F.regexp_replace(escaped(t.role), r"(:)", r"\\$1"), F.lit(": ")).alias("head"),
            escaped(t.text).alias("body"), (t.role == learnt).alias("learnt"),
        ),
    )
    text = F.array_join(F.transform("_parts", lambda p: F.concat(p.head, p.body, F.lit("</turn>\n"))), "")
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start: int, length: int>>").alias("spans"))
    spans = F.aggregate(
        "_parts", start,
        lambda acc, p: F.struct(
            (acc["at"] + F.length(p.head) + F.length(p.body) + F.lit(len("</turn>\n"))).alias("at"),
            F.when(
                p.learnt,
                F.concat(acc.spans, F.array(F.struct((acc["at"] + F.length(p.head)).alias("start"), F.length(p.body).alias("length")))),
            ).otherwise(acc.spans).alias("spans"),
        ),
    )
    return records.withColumn("_parts", parts).withColumns({"formatted": text, "loss": spans.spans}).drop("_parts")


def read_back(text: str = "formatted") -> Column:
    """Turns (role, text) of a formatted conversation."""
    roles = F.regexp_extract_all(text, F.lit(_TURN), F.lit(1))
    bodies = F.regexp_extract_all(text, F.lit(_TURN), F.lit(2))
    return F.zip_with(roles, bodies, lambda r, b: F.struct(unescaped(r).alias("role"), unescaped(b).alias("text")))


def learnt_text(text: str = "formatted", loss: str = "loss") -> Column:
    """All text under the loss mask, unescaped, in order."""
    return F.array_join(F.transform(loss, lambda s: unescaped(F.substr(F.col(text), s.start + 1, s.length))), "")
