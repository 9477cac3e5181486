"""Chat formatting: records of different layouts become canonical turns, and turns become marked text.

A record is JSON text. Its fingerprint is a hash of the sorted paths of its nested fields (``messages[].role``),
whatever the values are. A registry of declarative layouts says which paths a layout has and how they become
turns; the fingerprint of a record selects its layout. A record with a fingerprint that no layout has, or that is
no JSON, keeps null turns and its fingerprint is reported, so that a layout can be added as data. A record of a known
layout that Spark cannot read into it is an error: its turns are not lost in silence. Texts have no greatest length.

The template is ``<|im_start|>role<|im_sep|>text<|im_end|>`` for each turn. Inside roles and texts a backslash is
doubled, and one is put into every control string (of this template and of other common ones), so that none can be
read as a mark; ``unescape`` takes them out again. The loss mask is a list of character spans of the formatted
text: the text of each assistant turn, without its marks.

Null texts and roles are empty. Turns are ordered by turn, role and text, so ties and repeated rows have one order.
A conversation without turns gives an empty text. One conversation is one row and so stands in one task. Ids of any type
stay as they are, null ones too (rows with a null id are one conversation). Columns that are not named here are not read;
``canonical_turns`` keeps them, and replaces those named ``fingerprint``, ``layout`` and ``turns``.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import stored

TURNS = "array<struct<role:string,text:string>>"
BEGIN, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
#: The starts of control strings of common templates.
_CONTROL = re.compile(r"(<)(?=\||/?s>|</?SYS>>|(?:start|end)_of_turn>|[be]os>)|(\[)(?=/?INST\])")
_ESCAPED = re.compile(r"\\(.)", re.S)
#: The parser's own limits on the length of a text and of a number are lifted.
_BROKEN = "_corrupt_record"
_PARSER = {"maxStringLen": str(2**31 - 1), "maxNumLen": str(2**31 - 1), "columnNameOfCorruptRecord": _BROKEN}


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: m[0] + "\\", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


@dataclass(frozen=True)
class Layout:
    """Paths that a record has (and may have), and where its turns are.

    ``fields``: (role, path) pairs, one turn for each path that is not null, in this order. Or ``items``: the path of
    a list whose elements have ``role`` and ``text`` fields, with roles renamed by ``names``.
    """

    name: str
    paths: tuple[str, ...]
    optional: tuple[str, ...] = ()
    fields: tuple[tuple[str, str], ...] = ()
    items: str = ""
    role: str = "role"
    text: str = "content"
    names: tuple[tuple[str, str], ...] = ()

    def fingerprints(self) -> list[str]:
        more = [set(c) for n in range(len(self.optional) + 1) for c in combinations(self.optional, n)]
        return sorted({fingerprint_paths({*self.paths, *m}) for m in more})

    def turns(self, record: Column) -> Column:
        if self.items:
            fields = f"`{self.items}`:array<struct<`{self.role}`:string,`{self.text}`:string>>"
            role = lambda x: _renamed(F.coalesce(x[self.role], F.lit("")), self.names)
            return F.transform(
                _parsed(record, fields, self.name)[self.items],
                lambda x: F.struct(role(x).alias("role"), F.coalesce(x[self.text], F.lit("")).alias("text")),
            )
        parsed = _parsed(record, ",".join(f"`{p}`:string" for _, p in self.fields), self.name)
        every = [
            F.when(parsed[p].isNotNull(), F.struct(F.lit(r).alias("role"), parsed[p].alias("text"))) for r, p in self.fields
        ]
        return F.filter(F.array(*every), lambda x: x.isNotNull())


def _parsed(record: Column, fields: str, name: str) -> Column:
    parsed = F.from_json(record, f"struct<{fields},`{_BROKEN}`:string>", _PARSER)
    told = F.concat(F.lit(f"a record of the layout {name} cannot be read into it: "), F.left(record, F.lit(200)))
    return F.when(parsed.isNull() | parsed[_BROKEN].isNotNull(), F.raise_error(told)).otherwise(parsed)


def _renamed(role: Column, names: tuple[tuple[str, str], ...]) -> Column:
    for old, new in names:
        role = F.when(role == old, F.lit(new)).otherwise(role)
    return role


def paths_of(value: object, at: str = "") -> set[str]:
    """The paths of all nested fields; a list's elements share the path ``name[]``."""
    if isinstance(value, dict):
        found = set()
        for k, v in value.items():
            name = f"{at}.{k}" if at else k
            found |= {name} | paths_of(v, name)
        return found
    if isinstance(value, list):
        return set().union(*(paths_of(v, f"{at}[]") for v in value))
    return set()


def fingerprint_paths(paths: set[str]) -> str:
    return hashlib.sha1("\n".join(sorted(paths)).encode()).hexdigest()[:16]


LAYOUTS = (
    Layout("messages", ("messages", "messages[].role", "messages[].content"), items="messages"),
    Layout("no_messages", ("messages",), items="messages"),
    Layout(
        "shared", ("conversations", "conversations[].from", "conversations[].value"), items="conversations", role="from",
        text="value", names=(("human", "user"), ("gpt", "assistant")),
    ),
    Layout("prompt", ("prompt", "response"), ("system",), (("system", "system"), ("user", "prompt"), ("assistant", "response"))),
    Layout(
        "instruction", ("instruction", "output"), ("system", "input"),
        (("system", "system"), ("user", "instruction"), ("user", "input"), ("assistant", "output")),
    ),
    Layout("question", ("question", "answer"), ("system",), (("system", "system"), ("user", "question"), ("assistant", "answer"))),
)


def fingerprints(records: pd.Series) -> pd.Series:
    def one(raw: str | None) -> str | None:
        try:
            return fingerprint_paths(paths_of(json.loads(raw)))
        except (TypeError, ValueError, RecursionError):
            return None

    return pd.Series([one(x) for x in records], dtype=object)


def canonical_turns(records: DataFrame, record_col: str = "record", layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """``records`` with ``fingerprint``, ``layout`` and ``turns`` (null where no layout has the fingerprint)."""
    marked = records.withColumn("fingerprint", F.pandas_udf(fingerprints, "string")(record_col))
    name, turns = F.lit(None).cast("string"), F.lit(None).cast(TURNS)
    for x in layouts:
        fits = F.col("fingerprint").isin(x.fingerprints())
        name = F.when(fits, F.lit(x.name)).otherwise(name)
        turns = F.when(fits, x.turns(F.col(record_col)).cast(TURNS)).otherwise(turns)
    return marked.withColumns({"layout": name, "turns": turns})


def known(canonical: DataFrame) -> DataFrame:
    """``canonical``, whose records must all have a layout: one without is an error, so that no turn is lost in silence."""
    told = F.concat(F.lit("a record has no layout, fingerprint "), F.coalesce(F.col("fingerprint"), F.lit("none")))
    return canonical.withColumn("turns", F.when(F.col("turns").isNull(), F.raise_error(told).cast(TURNS)).otherwise(F.col("turns")))


def format_turns(canonical: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """The formatted text of each row's turns and the character spans under the loss mask; without turns an empty text."""

    @F.pandas_udf("struct<formatted:string,loss_spans:array<array<int>>>")
    def write(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts, masks = [], []
            for turns in batch:
                parts, spans, at = [], [], 0
                for t in turns if turns is not None else ():
                    role, text = t["role"] or "", escape(t["text"] or "")
                    head = f"{BEGIN}{escape(role)}{SEP}"
                    if role == "assistant":
                        spans.append([at + len(head), at + len(head) + len(text)])
                    parts += [head, text, END]
                    at += len(head) + len(text) + len(END)
                texts.append("".join(parts))
                masks.append(spans)
            yield pd.DataFrame({"formatted": texts, "loss_spans": masks})

    return canonical.select(id_col, write.asNondeterministic()("turns").alias("__w")).select(id_col, "__w.*")


def parse_turns(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted text, unescaped."""
    turns = []
    for part in formatted.split(END)[:-1]:
        role, _, text = part.removeprefix(BEGIN).partition(SEP)
        turns.append((unescape(role), unescape(text)))
    return turns


def from_rows(rows: DataFrame) -> DataFrame:
    """Rows by turn (conv_id, turn, role, text) as one JSON record for each conversation.

    A user's turn with its answer becomes a prompt record, a system text before them an instruction record, anything
    else a list of messages: the layouts in which such data usually come.
    """
    empty = lambda c: F.coalesce(F.col(c), F.lit(""))
    row = F.struct("turn", empty("role").alias("role"), empty("text").alias("content"))
    grouped = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(row)).alias("m"))
    roles, text = lambda *names: F.col("m.role") == F.array(*map(F.lit, names)), lambda i: F.get("m", F.lit(i))["content"]
    messages = F.to_json(F.struct(F.transform("m", lambda x: x.dropFields("turn")).alias("messages")))
    record = (
        F.when(roles("user", "assistant"), F.to_json(F.struct(text(0).alias("prompt"), text(1).alias("response"))))
        .when(
            roles("system", "user", "assistant"),
            F.to_json(F.struct(text(0).alias("system"), text(1).alias("instruction"), text(2).alias("output"))),
        )
        .otherwise(messages)
    )
    return grouped.select("conv_id", record.alias("record"))


def read_back(formatted: DataFrame) -> DataFrame:
    """The figures of each conversation, from the formatted text and the loss mask alone."""

    @F.pandas_udf("struct<n_turns:long,turns_sha256:string,loss_chars:long,loss_sha256:string,formatted_chars:long>")
    def measure(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text, spans in zip(*batch):
                turns = parse_turns(text)
                loss = "".join(unescape(text[a:z]) for a, z in spans)
                told = hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
                rows.append((len(turns), told, len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(text)))
            yield pd.DataFrame(rows, columns=["n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    told = measure.asNondeterministic()("formatted", "loss_spans").alias("__m")
    return stored(formatted, "formatted").select("conv_id", told).select("conv_id", "__m.*")


#: The conversation that a formatter must survive: control strings of another template in both of its texts.
PROBE = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]

ORACLE = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
e AS (
  SELECT *, replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(text,
    '\', '\\'), '<|', '<\|'), '</s>', '<\/s>'), '<s>', '<\s>'), '<<SYS>>', '<\<SYS>>'), '<</SYS>>', '<\</SYS>>'), '[INST]', '[\INST]'),
    '[/INST]', '[\/INST]'), '<start_of_turn>', '<\start_of_turn>'), '<end_of_turn>', '<\end_of_turn>'), '<bos>', '<\bos>'),
    '<eos>', '<\eos>') AS x FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length(role) + length(x) + 32) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""
